"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Every source's documents stand in a seeded order and are cut, as one run of words, into blocks of ``block_words``.
A house of total/block_words seats goes to the sources by highest quotients target/(2k + 1); the method is
house-monotone, so the seats of the first i shards, less those of the first i - 1, are integer quotas of shard i that add
up. A source's seats, shard by shard, take its blocks one after the other from a seeded start on, in a ring, until its
quotas are filled; with more seats than blocks it goes round again.

Cases: null text has size 0; null sources are one source, ordered last; documents of size 0 take 0; a null id is kept and
comes first; equal rows get places by (hash, id, size) and are interchangeable; more shards than seats leave shards empty;
an empty table gives an empty result; other columns are ignored. A row for each source and partition is collected, so
the number of distinct sources is checked against ``max_sources``.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_names, parts_for, row_keys, staged

MAX_REPEATS = 3
BLOCK_WORDS = 16
SHARDS = 16
MAX_SOURCES = 1_000_000
#: Rows that a task puts in order.
TASK_ROWS = 1 << 22
SEED = 20240501


def words_of(text) -> "F.Column":
    """Number of runs of characters other than space, tab, LF, VT, FF and CR."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def water_fill(sizes: Sequence[int], weights: Sequence[float], cap: float = MAX_REPEATS) -> list[float]:
    """Targets by weight that add up to all sizes, none above ``cap`` times its size; excess goes to the others by weight."""
    left, open_, out = float(sum(sizes)), list(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        share = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if share * weights[i] > cap * sizes[i]]
        if not full:
            for i in open_:
                out[i] = share * weights[i]
            break
        for i in full:
            out[i] = float(cap * sizes[i])
            left -= out[i]
        shut = set(full)
        open_ = [i for i in open_ if i not in shut]
    return out


def sainte_lague(targets: Sequence[float], seats: int, most: Sequence[int]) -> list[int]:
    """Seats by highest quotients target/(2k + 1), ties to the earlier source, none above ``most``.

    A seat number k + 1 has quotient target/(2k + 1), so the seats with quotients of at least x are target/2x + 1/2,
    rounded down: bisection finds x, and a heap of quotients deals out what ties leave over.
    """
    seats = min(seats, sum(m for t, m in zip(targets, most) if t > 0))
    got = [0] * len(targets)
    if seats <= 0:
        return got

    def above(x: float) -> list[int]:
        return [min(m, int(t / (2 * x) + 0.5)) if t > 0 else 0 for t, m in zip(targets, most)]

    low, high = 0.0, 2.0 * max(targets)
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        if sum(above(mid)) > seats:
            low = mid
        else:
            high = mid
    # A little more than x, so that rounding gives no seat away; the rest goes by exact quotients.
    got = above(high * (1 + 1e-12))
    exact = [Fraction(t) for t in targets]
    heap = [(-exact[i] / (2 * k + 1), i) for i, (t, k, m) in enumerate(zip(targets, got, most)) if t > 0 and k < m]
    heapq.heapify(heap)
    for _ in range(seats - sum(got)):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < most[i]:
            heapq.heappush(heap, (-exact[i] / (2 * got[i] + 1), i))
    return got


def shard_quotas(targets: Sequence[float], seats: int, most: Sequence[int], shards: int) -> list[list[int]]:
    """Seats of each source in each shard; shards are equal up to one seat."""
    ends = [sainte_lague(targets, seats * (i + 1) // shards, most) for i in range(shards)]
    return [[b - a for a, b in zip(low, high)] for low, high in zip([[0] * len(targets), *ends], ends)]


def _running(names: list[str]):
    """Puts the words before each row, within its partition's run of the same source, in column ``before``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = object(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = dict(zip(names, batch.columns))
            sources = columns["src"].to_pylist()
            new = np.array([x != y for x, y in zip(sources, [last, *sources[:-1]])])
            size = columns["size"].to_numpy(zero_copy_only=False)
            sums = size.cumsum()
            base = np.concatenate(([-carried], (sums - size)[np.flatnonzero(new)]))[np.cumsum(new)]
            columns["before"] = pa.array(sums - size - base)
            carried, last = int(sums[-1] - base[-1]), sources[-1]
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return run


def _seeded(seed: int, *ids) -> "F.Column":
    return F.xxhash64(F.lit(seed), *(i.cast("string") for i in ids))


def _taken(sized: DataFrame, carried: list[str], weights: Sequence[float], shards: int, block_words: int, repeats: int, seed: int, max_sources: int) -> DataFrame:
    """``sized``: (carried, src, size, h). (carried, src, size, source_size, target, quotas, first_word, words ARRAY by shard)."""
    spark = sized.sparkSession
    sized = staged(sized, "sized")
    order = [F.col("src").asc_nulls_last(), "h", *carried, "size"]
    ordered = sized.repartitionByRange(parts_for(sized.count(), TASK_ROWS, TASK_ROWS >> 9), *order).sortWithinPartitions(*order)
    ordered = ordered.withColumns({"part": F.spark_partition_id(), "before": F.lit(0).cast("bigint")})
    ordered = staged(ordered.mapInArrow(_running(ordered.columns), ordered.schema), "ordered")

    # One row for each partition and source: at most partitions + sources.
    parts_of = staged(ordered.groupBy("src", "part").agg(F.sum("size").alias("words")), "source-parts")
    n_sources = parts_of.select("src").distinct().count()
    if n_sources > max_sources:
        raise ValueError(f"{n_sources} sources; max_sources is {max_sources}")
    rows = [(r["src"], r["part"], r["words"]) for r in parts_of.collect()]
    rows.sort(key=lambda r: (r[0] is None, r[0] or "", r[1]))
    totals: dict = {}
    starts = []
    for src, part, words in rows:
        starts.append((src, part, totals.get(src, 0)))
        totals[src] = totals.get(src, 0) + words
    names = list(totals)
    sizes = [totals[s] for s in names]
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(names))], repeats)
    blocks = [-(-s // block_words) for s in sizes]
    seats = int(sum(targets) / block_words + 0.5)
    quotas = [list(q) for q in zip(*shard_quotas(targets, seats, [repeats * b for b in blocks], shards))]
    plan = {s: (sizes[i], targets[i], quotas[i], (seed * 2654435761 + i * 40503) % blocks[i] if blocks[i] else 0, blocks[i]) for i, s in enumerate(names)}
    facts = [(s, p, at, *plan[s]) for s, p, at in starts]
    facts_df = spark.createDataFrame(facts, "src2 string, part2 int, part_start bigint, source_size bigint, target double, quotas array<bigint>, begin bigint, ring bigint")
    j = ordered.join(F.broadcast(facts_df), ordered["src"].eqNullSafe(facts_df["src2"]) & (ordered["part"] == facts_df["part2"]))
    low = F.col("part_start") + F.col("before")

    def words_in(i):
        """Words of the document in the seats of shard i: its interval on each round against the shard's."""
        from_ = (F.col("begin") + F.aggregate(F.slice("quotas", 1, i), F.lit(0).cast("bigint"), lambda a, q: a + q)) * block_words
        to = from_ + F.element_at("quotas", i + 1) * block_words
        rounds = [low + F.col("ring") * (k * block_words) for k in range(repeats + 1)]
        return sum((F.greatest(F.lit(0).cast("bigint"), F.least(at + F.col("size"), to) - F.greatest(at, from_)) for at in rounds), F.lit(0).cast("bigint"))

    words = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), words_in)
    return j.select(*carried, "src", "size", "source_size", "target", "quotas", low.alias("first_word"), words.alias("words"))


def _total(words) -> "F.Column":
    return F.aggregate(words, F.lit(0).cast("bigint"), lambda a, x: a + x)


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (1.0, 2.0, 3.0),
    shards: int = SHARDS,
    block_words: int = BLOCK_WORDS,
    repeats: int = MAX_REPEATS,
    seed: int = SEED,
    max_sources: int = MAX_SOURCES,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """(id, source, size, source_size, target, quotas, first_word, words, taken): a row for each row of ``docs``.

    Sources in code-point order, null last, weigh ``weights``, repeating. ``quotas``: the source's blocks in each shard of
    the mix; ``words``: the document's words in each shard, ``taken`` their sum.
    """
    i = F.col(f"`{id_col}`")
    sized = docs.select(i.alias("id"), F.col(f"`{source_col}`").cast("string").alias("src"), words_of(F.col(f"`{text_col}`")).alias("size"), _seeded(seed, i).alias("h"))
    out = _taken(sized, ["id"], weights, shards, block_words, repeats, seed, max_sources)
    return out.select(F.col("id").alias(id_col), F.col("src").alias(source_col), "size", "source_size", "target", "quotas", "first_word", "words", _total("words").alias("taken"))


def mixed(docs: DataFrame, weights: Sequence[float] = (1.0, 2.0, 3.0), seed: int = SEED, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, in whole documents: 0 to ``MAX_REPEATS`` times.

    The columns stay as they are, whatever their names. The two documents of a source at which its ring begins and ends
    are rounded; documents of size 0 go. Rows that are equal throughout are one while they are moved, and are given back
    as often as all of them are taken. An empty table stays empty.
    """
    r1, r2, copies, copy = free_names(docs, 4)
    keyed = row_keys(docs, r1, r2)
    rows = [F.col(r1), F.col(r2)]
    sized = keyed.select(rows[0].alias("r1"), rows[1].alias("r2"), F.col(f"`{source_col}`").cast("string").alias("src"), words_of(F.col(f"`{text_col}`")).alias("size"), _seeded(seed, *rows).alias("h"))
    taken = _taken(sized, ["r1", "r2"], weights, SHARDS, BLOCK_WORDS, MAX_REPEATS, seed, MAX_SOURCES)
    whole = F.when(F.col("size") > 0, F.round(_total("words") / F.col("size"))).otherwise(0).cast("int")
    times = taken.groupBy(F.col("r1").alias(r1), F.col("r2").alias(r2)).agg(F.sum(whole).cast("int").alias(copies)).where(F.col(copies) > 0)
    one = keyed.dropDuplicates([r1, r2]).join(times, [r1, r2])
    return one.select(*(F.col(f"`{c}`") for c in docs.columns), F.explode(F.array_repeat(F.lit(0), F.col(copies))).alias(copy)).drop(copy)
