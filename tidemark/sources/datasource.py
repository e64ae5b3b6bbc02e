"""Tick sources as a Spark data source: spark.read.format("tidemark_synthetic").option("tickers", 4).option("steps", 1000).load()."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "ticker_id bigint, provider_id int, ts_ms bigint, bid double, ask double, vbid bigint, vask bigint"


class SyntheticReader(DataSourceReader):
    """A partition for each ticker; a seeded geometric random walk."""

    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self):
        return [InputPartition(i) for i in range(int(self.options.get("tickers", 1)))]

    def read(self, partition):
        import numpy as np
        import pyarrow as pa

        o = self.options
        n, sigma = int(o.get("steps", 1000)), float(o.get("sigma", 0.5))
        rng = np.random.default_rng([int(o.get("seed", 1)), partition.value])
        dt = 500 / (365 * 86_400_000)
        price = float(o.get("s0", 100)) * np.exp(np.cumsum(-sigma * sigma / 2 * dt + sigma * dt**0.5 * rng.standard_normal(n)))
        volume, buyer = rng.integers(0, 10_000, n), rng.random(n) < 0.5
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, partition.value, np.int64)), pa.array(np.zeros(n, np.int32)), pa.array(int(o.get("start_ms", 1_704_067_200_000)) + 500 * np.arange(n)),
                pa.array(price * (1 - 0.00005)), pa.array(price * (1 + 0.00005)), pa.array(np.where(buyer, 0, volume)), pa.array(np.where(buyer, volume, 0)),
            ],
            names=["ticker_id", "provider_id", "ts_ms", "bid", "ask", "vbid", "vask"],
        )


class SyntheticSource(DataSource):
    @classmethod
    def name(cls):
        return "tidemark_synthetic"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return SyntheticReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SyntheticSource)
