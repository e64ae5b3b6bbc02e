"""Structured Streaming forms of the incremental operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions import scalar as S
from tidemark.operators.filters import skip_sentinels, valid_quotes
from tidemark.operators.renko import State


def ohlc(stream: DataFrame, seconds: int = 10, late: str = "30 seconds") -> DataFrame:
    """Time bars of a stream of records; a bar is out once the watermark has passed it, later rows are dropped."""
    t = skip_sentinels(valid_quotes(stream)).withColumn("at", F.timestamp_millis("ts_ms")).withWatermark("at", late)
    m, o = S.mid(), F.struct("ts_ms", "event_id")
    g = t.groupBy("ticker_id", F.window("at", f"{seconds} seconds"))
    out = g.agg(F.min_by(m, o).alias("open"), F.max(m).alias("high"), F.min(m).alias("low"), F.max_by(m, o).alias("close"), F.sum("vbid").alias("vbid"), F.sum("vask").alias("vask"), F.count("*").alias("tick_count"))
    return out.select("ticker_id", F.unix_millis("window.start").alias("open_ts_ms"), "open", "high", "low", "close", "vbid", "vask", "tick_count")


def renko(stream: DataFrame) -> DataFrame:
    """Bricks of a stream (ticker_id, ts_ms, event_id, mid, brick); the state is the last close and the guard's count."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        last, trips, seq = kept.get if kept.exists else (None, 0, 0)
        state, out = State(last, trips), []
        rows = pd.concat(list(batches)).sort_values(["ts_ms", "event_id"])
        for ts, m, b in zip(rows["ts_ms"], rows["mid"], rows["brick"]):
            first, n = state.step(m, b)
            way = 1 if n > 0 else -1
            for i in range(abs(n)):
                seq += 1
                out.append((key[0], seq, ts, first + way * i * b, first + way * (i + 1) * b))
        kept.update((state.last, state.trips, seq))
        yield pd.DataFrame(out, columns=["ticker_id", "seq", "ts_ms", "open", "close"])

    return stream.groupBy("ticker_id").applyInPandasWithState(run, "ticker_id bigint, seq bigint, ts_ms bigint, open double, close double", "last double, trips int, seq bigint", "append", GroupStateTimeout.NoTimeout)


def dedup(stream: DataFrame, late: str = "30 seconds") -> DataFrame:
    """Drops repeats of an event within the watermark."""
    return stream.withColumn("at", F.timestamp_millis("ts_ms")).withWatermark("at", late).dropDuplicatesWithinWatermark(["ticker_id", "event_id"]).drop("at")
