"""Sharding by minimax contiguous partition; DataFrame functions only.

Texts of equal 64-bit hash (equal texts, above all) are an atomic group; groups stand in the order of their hash. The
smallest feasible capacity of a shard is found by binary search over the ordered group sizes, checked greedily. The sizes
of all groups are never brought together: leading bits of the hash make 65,536 ordered cells, and the search on cells
bounds the capacity from above (a cell is whole) and from below (a cell of several groups can be cut anywhere). Only cells
in which a cut may fall between these bounds are split by further bits, until both bounds meet: the capacity is the
smallest one of the groups themselves. Among the cuts that keep it, the one nearest to equal shares is taken.

A shard's slots number its rows by (cell, part of the cell, hash, id): a cell of n rows is dealt to about sqrt(n) parts, and
rows of equal id and text are one with a count, so that no window holds a hot group as a whole.

Cases: null text counts as no bytes (size 1, crc32 0) and shares a group with empty text; repeated rows share a shard
and take slots of their own; null ids come first; a group larger than an equal share makes its shard larger, because
it stays whole; fewer groups than shards leave shards empty; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

CELL_BITS = 16
#: Cells that one step of the search collects.
STEP_CELLS = 1 << 20
#: Rows of equal id and text that come out of one row at once.
RUN_ROWS = 1 << 16


class Cell(NamedTuple):
    """Groups whose hashes share their first ``bits`` bits, from hash ``low`` to ``high``."""

    low: int
    high: int
    size: int
    bits: int


def smallest_capacity(sizes: Sequence[int], shards: int) -> int:
    """The least capacity with which ``sizes``, in order, fill at most ``shards`` shards."""
    ends = list(accumulate(sizes))
    if not ends:
        return 0
    low, high = max(max(sizes), -(-ends[-1] // shards)), ends[-1]
    while low < high:
        mid = (low + high) // 2
        at, used = 0, 0
        while at < len(ends) and used < shards:
            at = bisect_right(ends, (ends[at - 1] if at else 0) + mid)
            used += 1
        low, high = (low, mid) if at == len(ends) else (mid + 1, high)
    return low


def contiguous_cuts(sizes: Sequence[int], shards: int) -> list[int]:
    """First index of every shard after the first; no shard exceeds ``smallest_capacity``."""
    capacity, ends = smallest_capacity(sizes, shards), [0, *accumulate(sizes)]
    n, total = len(sizes), ends[-1]
    # least[k]: the first index from which k shards hold all the rest
    least = [n]
    for _ in range(shards):
        least.append(bisect_left(ends, ends[least[-1]] - capacity))
    cuts, at = [], 0
    for left in range(shards - 1, 0, -1):
        want = ends[at] + (total - ends[at]) / (left + 1)
        high = bisect_right(ends, ends[at] + capacity) - 1
        low = max(at, least[left])
        near = bisect_left(ends, want)
        options = {min(max(x, low), high) for x in (near - 1, near)}
        at = min(options, key=lambda x: (abs(ends[x] - want), x))
        cuts.append(at)
    return cuts


def open_cells(cells: Sequence[Cell], shards: int) -> list[int]:
    """Cells of several groups in which a cut may fall, going by what is known of the smallest capacity; none, if it is known."""
    ends = list(accumulate(c.size for c in cells))
    whole = [c.low == c.high for c in cells]

    def cuts(capacity: int, loose: bool) -> list[int]:
        """Bytes before each cut of the greedy partition; ``loose``: a cell of several groups can be cut anywhere."""
        at, out = 0, []
        for _ in range(shards):
            to = at + capacity
            i = bisect_right(ends, to)
            if i < len(ends) and (whole[i] or not loose):
                to = ends[i - 1] if i else 0
            at = min(max(at, to), ends[-1])
            out.append(at)
        return out

    if not cells:
        return []
    high = smallest_capacity([c.size for c in cells], shards)
    low, top = max([-(-ends[-1] // shards), *(c.size for c, w in zip(cells, whole) if w)]), high
    while low < top:
        mid = (low + top) // 2
        low, top = (low, mid) if cuts(mid, True)[-1] == ends[-1] else (mid + 1, top)
    if low >= high:
        return []
    found: set[int] = set()
    for a, b in zip(cuts(low, False), cuts(high, True)):
        found.update(range(bisect_right(ends, a), min(bisect_left(ends, b) + 1, len(ends))))
    return [i for i in sorted(found) if not whole[i]]


def _cells(groups: DataFrame, bits: int) -> list[Cell]:
    """``groups``: (h, size, n). In order."""
    rows = groups.groupBy(F.shiftright("h", 64 - bits).alias("cell")).agg(F.min("h").alias("low"), F.max("h").alias("high"), F.sum(F.col("size") * F.col("n")).alias("size")).collect()
    return sorted(Cell(r["low"], r["high"], r["size"], bits) for r in rows)


def cells_of(groups: DataFrame, shards: int, cell_bits: int = CELL_BITS) -> list[Cell]:
    """Cells with which the smallest capacity is that of the groups themselves; at most ``STEP_CELLS`` more at each step."""
    cells = _cells(groups, cell_bits)
    while split := open_cells(cells, shards):
        more = max(1, (STEP_CELLS // len(split)).bit_length() - 1)
        finer: dict[int, list[Cell]] = {}
        for bits in {cells[i].bits for i in split}:
            own = [(cells[i].low >> (64 - bits),) for i in split if cells[i].bits == bits]
            wanted = F.broadcast(groups.sparkSession.createDataFrame(own, "cell bigint"))
            parts = groups.withColumn("cell", F.shiftright("h", 64 - bits)).join(wanted, "cell", "left_semi").select("h", "size", "n")
            for c in _cells(parts, min(64, bits + more)):
                finer.setdefault(c.low >> (64 - bits), []).append(c)
        chosen = set(split)
        cells = [x for i, c in enumerate(cells) for x in (finer[c.low >> (64 - c.bits)] if i in chosen else [c])]
    return cells


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, cell, shard, slot): a row for each row of ``docs``; slots count from 0 in each shard."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    light = docs.select(
        F.col(f"`{id_col}`").alias("id"), (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h")
    )
    light = staged(light.groupBy("id", "size", "text_crc32", "h").agg(F.count("*").alias("n")), "sizes")
    cells = cells_of(light.select("h", "size", "n"), shards)
    firsts = [cells[i].low if i < len(cells) else None for i in contiguous_cuts([c.size for c in cells], shards)]
    own = sum((F.when(F.col("h") >= F.lit(b).cast("bigint"), 1).otherwise(0) for b in firsts if b is not None), F.lit(0))
    placed = light.withColumns({"shard": own, "cell": F.shiftright("h", 64 - CELL_BITS).cast("int")})
    # At most 2**CELL_BITS rows and one more for each cut, whatever the input.
    counts = sorted(tuple(r) for r in placed.groupBy("shard", "cell").agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect())
    facts, slot = [], [0] * shards
    for k, cell, rows, n in counts:
        facts.append((cell, k, slot[k], max(1, round(rows**0.5))))
        slot[k] += n
    facts_df = spark.createDataFrame(facts, "cell int, shard int, first_slot bigint, deals int")
    placed = placed.join(F.broadcast(facts_df), ["cell", "shard"]).withColumn("deal", F.pmod(F.xxhash64("h", F.col("id").cast("string")), F.col("deals")).cast("int"))
    part = ["cell", "shard", "deal"]
    dealt = placed.groupBy(*part).agg(F.sum("n").alias("n"))
    before = Window.partitionBy("cell", "shard").orderBy("deal").rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.select(*part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy(*part).orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = placed.withColumn("inside", inside).join(dealt, part)
    numbered = numbered.withColumn("start", F.col("first_slot") + F.col("ahead") + F.col("inside"))
    zero = F.lit(0).cast("bigint")
    runs = numbered.select("id", "size", "text_crc32", "cell", "shard", "start", "n", F.explode(F.sequence(zero, F.expr(f"(n - 1) div {RUN_ROWS}"))).alias("run"))
    slots = F.sequence(F.col("run") * RUN_ROWS, F.least("n", (F.col("run") + 1) * RUN_ROWS) - 1)
    return runs.select("id", "size", "text_crc32", "cell", "shard", "start", F.explode(slots).alias("nth")).select(
        F.col("id").alias(id_col), "size", "text_crc32", "cell", "shard", (F.col("start") + F.col("nth")).cast("bigint").alias("slot")
    )
