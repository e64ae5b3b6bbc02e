"""Legacy fixed-width tick and volatility files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import config as c

# The records' layouts, little-endian.
TICK = np.dtype([("kind", "<u2"), ("provider_id", "<u2"), ("mts", "V6"), ("rest", "V6"), ("ticker_id", "<u8"), ("bid", "<f8"), ("ask", "<f8"), ("vbid", "<u4"), ("vask", "<u4")])
VOL = np.dtype([("mts", "V6"), ("sigma_pct", "<f8")])


def _ms(raw: np.ndarray) -> np.ndarray:
    """48-bit counts of 16 microseconds since 2010 as milliseconds."""
    b = np.frombuffer(raw.tobytes(), np.uint8).reshape(-1, 6).astype(np.int64)
    return (b << (8 * np.arange(6))).sum(axis=1) * 16 // 1000 + c.MTS_EPOCH_MS


def _read(spark: SparkSession, path: str, glob: str, kind: np.dtype, schema: str, columns) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                if len(data) % kind.itemsize:
                    raise ValueError(f"{len(data)} bytes are not whole records of {kind.itemsize}")
                yield pa.RecordBatch.from_pydict(columns(np.frombuffer(data, kind)))

    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("content").mapInArrow(run, schema)


def ticks(spark: SparkSession, path: str) -> DataFrame:
    def columns(r: np.ndarray) -> dict:
        return {
            "ticker_id": r["ticker_id"].astype(np.int64), "provider_id": r["provider_id"].astype(np.int32), "ts_ms": _ms(np.ascontiguousarray(r["mts"])), "bid": r["bid"].copy(), "ask": r["ask"].copy(),
            "vbid": r["vbid"].astype(np.int64), "vask": r["vask"].astype(np.int64),
        }

    return _read(spark, path, "[!.]*.ticks", TICK, "ticker_id bigint, provider_id int, ts_ms bigint, bid double, ask double, vbid bigint, vask bigint", columns)


def vol(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, "[!.]*.vol", VOL, "bin_ts_ms bigint, sigma_pct double", lambda r: {"bin_ts_ms": _ms(np.ascontiguousarray(r["mts"])), "sigma_pct": r["sigma_pct"].copy()})


def vol_files(bins: DataFrame) -> DataFrame:
    """(ticker_id, content BINARY): each ticker's bins (ticker_id, bin_ts_ms, sigma_pct) in order, as a file of ``VOL`` records."""
    rows = bins.groupBy("ticker_id").agg(F.array_sort(F.collect_list(F.struct("bin_ts_ms", "sigma_pct"))).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for own in batch.column(1).to_pylist():
                r = np.zeros(len(own), VOL)
                mts = -(-(np.array([x["bin_ts_ms"] for x in own], np.int64) - c.MTS_EPOCH_MS) * 1000 // 16)
                r["mts"] = np.frombuffer(mts.astype("<i8").tobytes(), np.uint8).reshape(-1, 8)[:, :6].copy().view("V6").ravel()
                r["sigma_pct"] = [x["sigma_pct"] for x in own]
                out.append(r.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["ticker_id", "content"])

    return rows.mapInArrow(run, "ticker_id bigint, content binary")
