"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """This application's part of the folder that all executors share; a local one only in local sessions that name none."""
    own = spark.conf.get("spark.checkpoint.dir", None)
    if not own:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        own = tempfile.gettempdir()
    return f"{own}/tidemark/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Deletes what this application has staged; results that were not written elsewhere can't be read after that."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of a staged file, where their number is known beforehand.
FILE_ROWS = 1 << 16


def staged(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    It cuts lineage the way checkpoint() does (a lost executor costs no recomputation of what stands before it)
    and gives Catalyst real sizes. ``rows``: a bound of their number, if one is known; it keeps small tables in few files.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df if rows is None else df.coalesce(parts_for(rows, FILE_ROWS))).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(amount: int, most: int, least: int | None = None) -> int:
    """Tasks for ``amount`` of what one of them is to hold at most ``most`` of; up to 200, if each has ``least``."""
    return max(1, -(-amount // most), min(200, amount // least) if least else 1)


def text_keys(text: Column) -> tuple[Column, Column]:
    """A 128-bit key of a text, null as empty."""
    whole = F.coalesce(text, F.lit(""))
    return F.xxhash64(whole), F.xxhash64(F.lit(1), whole)


def free_names(df: DataFrame, n: int) -> list[str]:
    """Column names that ``df`` lacks, whatever their case."""
    used = {c.lower() for c in df.columns}
    return [x for i in range(n + len(used)) if (x := f"_key{i}") not in used][:n]


#: Rows that are Python objects at a time.
SLICE_ROWS = 512


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of ``SLICE_ROWS`` rows; a worker that waits for its next task keeps none of their memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)
    pa.default_memory_pool().release_unused()


def map_rows(df: DataFrame, columns: list[str], schema: str, row: Callable[..., Iterable[tuple]]) -> DataFrame:
    """``row(*values)`` yields output tuples for each row; only ``columns`` cross to Python, in Arrow batches."""
    out = df.sparkSession.createDataFrame([], schema).schema
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        for batch in slices(batches):
            rows = [x for values in zip(*(c.to_pylist() for c in batch.columns)) for x in row(*values)]
            if rows:
                cols = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], names=names)

    return df.select(*(F.col(f"`{c}`") for c in columns)).mapInArrow(run, out)


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def row_keys(docs: DataFrame, r1: str, r2: str) -> DataFrame:
    """``docs`` with a 128-bit key of the whole row in two more columns; only rows that are equal throughout share one."""
    every = [F.concat(F.lit("="), F.col(f"`{c}`").cast("string")) for c in docs.columns] + [F.col(f"`{c}`").isNull() for c in docs.columns]
    return docs.withColumns({r1: F.xxhash64(*every), r2: F.xxhash64(F.lit(1), *every)})


#: Bits of the bitmaps that stand for a set of keys, whatever its size.
MEMBER_BITS = 1 << 26


def maybe_members(df: DataFrame, key: str, keys: DataFrame, keep: bool = True) -> DataFrame:
    """The rows of ``df`` whose BIGINT ``key`` may be in column ``key`` of ``keys`` (``keep``), or surely is not.

    A bitmap of at most ``MEMBER_BITS`` bits (8 MB) is broadcast: no key is missed; the more keys, the more others pass.
    """
    at = F.pmod(F.xxhash64(F.col(key)), F.lit(MEMBER_BITS)).cast("bigint")
    maps = keys.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("_bits"))
    placed = df.withColumn("_at", at).withColumn("_b", F.bitmap_bucket_number("_at"))
    j = placed.join(F.broadcast(maps), F.col("_b") == F.col("_bucket"), "left")
    bit = F.bitmap_bit_position("_at")
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    found = F.coalesce(F.call_function("shiftrightunsigned", byte.cast("bigint"), F.pmod(bit, F.lit(8)).cast("int")).bitwiseAND(F.lit(1).cast("bigint")) == 1, F.lit(False))
    return j.where(found if keep else ~found).select(*(F.col(f"`{c}`") for c in df.columns))
