"""Exact top-k search by inner product with block-at-a-time pruning.

Rows are range-partitioned and sorted by their largest components, so that rows which point the same way stand together,
and a task cuts its rows into blocks of ``range_rows`` with their terms' (components') maxima and minima. The queries come in
blocks of bounded bytes, each broadcast once. For each query, a block's bound is the sum over terms of the query's weight
times the maximum (minimum, if the weight is negative); the query takes the task's blocks by falling bound and stops when
the bound is below its k-th score. The k-th scores start from a sample of rows, against which all queries are scored first;
it decides nothing. Each task returns k rows a query at most; a window puts them together.

How much is pruned is in the vectors: of rows in clusters few blocks are scored, of rows that point anywhere (random
directions in many dimensions) every block's bound is above the k-th score, and all are.

Components are floor(scale * x). Cases: vectors that are null, or hold null, NaN or infinite components, and rows with a
null id, take no part; shorter vectors count as filled up with zeros; a query's own row is left out, but not a repeated
row of the same id; equal scores go to the smaller id; fewer candidates than k give fewer rows; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import parts_for, staged

K = 20
RANGE_ROWS = 64
#: Bytes of queries (8 a component) that are a block, and blocks that one job takes.
BLOCK_BYTES, JOB_BLOCKS = 8 << 20, 8
#: Bytes of vectors that a task holds.
TASK_BYTES = 32 << 20
#: Rows from which the k-th scores start.
SAMPLE_ROWS = 2048


def _matrix(vectors: pa.Array | list, width: int) -> np.ndarray:
    if isinstance(vectors, list):
        vectors = pa.array(vectors, pa.list_(pa.float64()))
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(size), max(width, int(size.max(initial=0)))), np.float64)
    row = np.repeat(np.arange(len(size)), size)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out[row, col] = flat
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T, exact: floats hold the sums if they stay below 2**53."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < 2**53:
        return a @ b.T
    whole = np.vectorize(int, otypes=[object])
    return whole(a).dot(whole(b).T)


class _Best:
    """The k best rows of each query so far."""

    def __init__(self, n: int, k: int, floor: np.ndarray) -> None:
        self.k, self.kth = k, floor
        self.q = self.s = self.i = self.r = np.empty(0, np.int64)
        self.n = n

    def add(self, q, s, i, r) -> None:
        q, s, i, r = (np.concatenate(x) for x in zip((self.q, self.s, self.i, self.r), (q, s, i, r)))
        order = np.lexsort((r, i, -s, q))
        q = q[order]
        place = np.arange(len(q)) - np.searchsorted(q, q, "left")
        keep = order[place < self.k]
        last = place == self.k - 1
        self.kth[q[last]] = np.maximum(self.kth[q[last]], s[order[last]].astype(np.float64))
        self.q, self.s, self.i, self.r = q[place < self.k], s[keep], i[keep], r[keep]


def search(queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int, range_rows: int, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> tuple[_Best, int, int]:
    """The best of ``vectors`` for each query, blocks scored, and blocks there are, each times queries.

    ``own``: the queries' row numbers; ``floor``: a lower bound of the k-th scores.
    """
    best = _Best(len(queries), k, floor.copy())
    starts = np.arange(0, len(rows), range_rows)
    high, low = np.maximum.reduceat(vectors, starts), np.minimum.reduceat(vectors, starts)
    bound = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    bound += np.abs(bound) * 1e-9
    order = np.argsort(-bound, axis=1, kind="stable")
    scored = 0
    for step in range(len(starts)):
        block = order[:, step]
        live = bound[np.arange(len(queries)), block] >= best.kth
        if not live.any():
            break
        scored += int(live.sum())
        found = []
        for b in np.unique(block[live]):
            qs = np.flatnonzero(live & (block == b))
            at = slice(starts[b], starts[b] + range_rows)
            score = _product(queries[qs], vectors[at])
            hit_q, hit_c = np.nonzero((score >= best.kth[qs][:, None]) & (rows[at][None, :] != own[qs][:, None]))
            if len(hit_q):
                found.append((qs[hit_q], score[hit_q, hit_c].astype(np.int64), ids[at][hit_c], rows[at][hit_c]))
        if found:
            best.add(*(np.concatenate(x) for x in zip(*found)))
    return best, scored, len(starts) * len(queries)


def _searching(sent, k: int, range_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, own, floor = sent.value
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows, ids = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in (0, 1))
        vectors = np.concatenate([_matrix(b.column(2), queries.shape[1])[:, : queries.shape[1]] for b in held])
        best, _, _ = search(queries, own, floor, k, range_rows, rows, ids, vectors)
        yield pa.RecordBatch.from_arrays([pa.array(own[best.q]), pa.array(best.i), pa.array(best.r), pa.array(best.s)], names=["query_row", "vec_id", "row", "score"])

    return run


def _floors(sent, k: int, width: int):
    """Adds to each query its k-th score among the rows of a sample, other than itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sample = sent.value
        for batch in batches:
            own, matrix = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1), width)
            floor = np.full(len(own), -np.inf)
            for at in range(0, len(own) if len(rows) > k else 0, 1024):
                score = _product(matrix[at : at + 1024], sample).astype(np.float64)
                score[own[at : at + 1024][:, None] == rows[None, :]] = -np.inf
                floor[at : at + 1024] = -np.partition(-score, k - 1, axis=1)[:, k - 1]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(floor)], names=["row", "v", "floor"])

    return run


def top_k(vectors: DataFrame, is_query, k: int = K, scale: float = 64.0, range_rows: int = RANGE_ROWS, block_bytes: int = BLOCK_BYTES, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for each row of ``vectors`` where ``is_query`` (a function of the id column) holds."""
    spark = vectors.sparkSession
    v = F.col(f"`{vector_col}`")
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    clean = vectors.where(fine & F.col(f"`{id_col}`").isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("bigint").alias("id"), F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double")).alias("v")
    )
    clean = staged(clean, "vectors")
    count, width = clean.agg(F.count("*"), F.max(F.size("v"))).first()
    empty = spark.createDataFrame([], "query_row bigint, vec_id bigint, row bigint, score bigint")
    width = width or 0
    # Place, with its sign, of the largest components: what they share, rows next to each other share.
    largest = F.slice(F.sort_array(F.transform("v", lambda x, i: F.struct(F.abs(x).alias("a"), F.when(x < 0, -1 - i).otherwise(i).alias("at"))), asc=False), 1, 2)
    ordered = clean.withColumn("toward", F.transform(largest, lambda x: x["at"]))
    rows_a_task = max(range_rows, TASK_BYTES // (8 * max(width, 1)))
    ordered = ordered.repartitionByRange(parts_for(count, rows_a_task, 1024), "toward", "row").sortWithinPartitions("toward", "row")
    ordered = staged(ordered.select("row", "id", "v"), "ordered-vectors")

    sample = clean.orderBy(F.xxhash64("row")).limit(SAMPLE_ROWS).select("row", "v").collect()
    sent = spark.sparkContext.broadcast((np.array([r["row"] for r in sample], np.int64), _matrix([r["v"] for r in sample], width)))
    asked = staged(clean.where(is_query(F.col("id"))).select("row", "v").mapInArrow(_floors(sent, k, width), "row bigint, v array<double>, floor double"), "queries")
    names = clean.where(is_query(F.col("id"))).select(F.col("row").alias("query_row"), F.col("id").alias("query_id"))

    per_block = max(1, block_bytes // (8 * max(width, 1)))
    every, job, held = empty, [], []

    def block(queries: list) -> None:
        nonlocal every, job
        sent = spark.sparkContext.broadcast((_matrix([r["v"] for r in queries], width), np.array([r["row"] for r in queries], np.int64), np.array([r["floor"] for r in queries])))
        job.append(ordered.mapInArrow(_searching(sent, k, range_rows), empty.schema))
        if len(job) == JOB_BLOCKS:
            every, job = every.union(staged(reduce(DataFrame.union, job), "found")), []

    for r in asked.toLocalIterator():
        held.append(r)
        if len(held) == per_block:
            block(held)
            held = []
    if held:
        block(held)
    every = reduce(DataFrame.union, job, every)
    place = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    best = every.withColumn("rank", place).where(F.col("rank") <= k)
    return best.join(names, "query_row").select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id"), "score")
