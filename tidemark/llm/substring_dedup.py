"""Removal of repeated byte strings by sorting sampled suffixes.

A byte goes if a string of ``least`` bytes that covers it also starts anywhere else, in another document or the same.
Passages of ``words`` whole words that occur again, as bytes, are reported beside it, for short words make them shorter
than ``least``. A sorted array of all suffixes would take 16 bytes and more for each byte of text, so only sampled
suffixes are sorted:

1. The window at a position ends after ``least`` bytes or ``words`` words (a part of a word at its start is one),
   whichever comes first. Every window picks the suffix at its smallest ``GRAM``-byte hash, the leftmost if several are
   equal. Equal windows pick the same one, so what is repeated shows as two sampled suffixes with equal leading tokens
   (the ``GRAM`` bytes). About one suffix in 120 bytes is picked; its region is what the windows that picked it cover.
2. Regions whose leading tokens occur once are done. Equal regions are counted by 128-bit hash; one that occurs twice is
   repeated as a whole, however often it occurs, and goes on as one representative.
3. Regions that occur once but share their leading tokens with others are compared: sampled splitters range-partition
   their suffixes by leading tokens, so that no string that counts crosses the boundary of two buckets, and a bucket
   sorts its suffixes by multikey quicksort. Within equal leading tokens, blocks of suffixes are merged by falling common
   prefix, and each keeps its regions in the order of the bytes before the suffix: only those that become neighbours
   there are compared, n log n pairs for n regions, and no longer common part is missed.
4. Leading tokens of more than ``group_rows`` different regions would be too much for a task. Their windows are matched
   by 128-bit hash instead, dealt over all tasks.

Cases: null text is empty bytes; texts shorter than ``least`` keep all; repeated rows are repeats of each other and
return once each; a null id is kept; an empty table gives an empty result; other columns are ignored. A text of any
length is read in one task; its regions are compared in the tasks of their leading tokens.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import maybe_members, parts_for, staged, text_keys, type_of

LEAST = 400
WORDS = 51
GRAM = 64
#: Regions (of some 600 bytes) that a task sorts, and regions of equal leading tokens that one task compares.
TASK_REGIONS, GROUP_ROWS = 20_000, 20_000
_B = 0x9E3779B97F4A7C15 | 1
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_GAPS = frozenset((32, *range(9, 14)))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Windows of a text that are looked at at once; bits of a place among them.
SEGMENT, _PLACE = 1 << 15, 20


def _gram_hashes(data: bytes) -> np.ndarray:
    """A hash of the GRAM bytes from each position."""
    n = len(data) - 7
    x = np.ndarray((n,), "<u8", data, 0, (1,)).astype(np.uint64)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    size, power = 8, _B
    while size < GRAM:
        x = x[:-size] + x[size:] * _U(power)
        size, power = 2 * size, power * power % 2**64
    x ^= x >> _U(29)
    x *= _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def _leftmost_minima(x: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Position of the leftmost least value of x[i : last[i] + 1] for each i, from minima of runs of 1, 2, 4, ... values.

    Values lose their last bits to the position, which then is part of the minimum.
    """
    low = (x & _U(-1 << _PLACE & 2**64 - 1)) | np.arange(len(x), dtype=np.uint64)
    at = np.arange(len(last))
    size = last - at + 1
    level = np.frexp(size)[1] - 1
    out, run = np.empty(len(last), np.uint64), 1
    top = int(level.max(initial=0))
    for k in range(top + 1):
        own = np.flatnonzero(level == k) if level.min() < top else at if k == top else at[:0]
        if len(own):
            out[own] = np.minimum(low[own], low[last[own] - run + 1])
        low, run = np.minimum(low[:-run], low[run:]), 2 * run
    return (out & _U((1 << _PLACE) - 1)).astype(np.int64)


def _picks(data: bytes, least: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(sampled position, end) of the window at each position that has one."""
    n = len(data)
    space = np.append(_SPACE[np.frombuffer(data, np.uint8)], True)
    end = space[1:] & ~space[:-1]
    ends = np.concatenate((np.flatnonzero(end) + 1, np.full(words, 2 * n + least)))
    before = np.cumsum(end) - end
    stop = np.minimum(np.arange(least, n + least), ends[before + words - 1])
    stop = stop[: int(np.count_nonzero(stop <= n))]
    return (_leftmost_minima(_gram_hashes(data), stop - GRAM) if len(stop) else stop), stop


def regions(data: bytes, least: int = LEAST, words: int = WORDS) -> list[tuple[int, int, int]]:
    """(position of the sampled suffix, start, end) of each region, from ``SEGMENT`` windows at a time.

    A region of fewer than ``least`` bytes, at a text's end, starts and ends with whole words.
    """
    n, runs = len(data), []
    for s in range(0, n if n >= min(least, 2 * words - 1) else 0, SEGMENT):
        pick, stop = (x[:SEGMENT] for x in _picks(data[s : s + SEGMENT + least + 1], least, words))
        cut = np.flatnonzero(np.diff(pick)) + 1 if len(pick) else np.empty(0, np.int64)
        first = np.concatenate(([0], cut))[: len(pick)]
        last = np.concatenate((cut, [len(pick)]))[: len(first)] - 1
        for a, p, q in zip((pick[first] + s).tolist(), (first + s).tolist(), (last + s).tolist()):
            if runs and runs[-1][0] == a:
                p = runs.pop()[1]
            runs.append((a, p, q, int(stop[q - s]) + s))
    out = []
    for a, p, q, e in runs:
        if p + least <= n:
            out.append((a, p, min(q + least, n)))
            continue
        gap = [i == 0 or data[i - 1] in _GAPS for i in range(p, q + 2)]
        starts = [i for i in range(p, q + 1) if gap[i - p] and data[i] not in _GAPS]
        if starts:
            out.append((a, starts[0], e))
    return out


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _sample(least: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, whole = xxhash.xxh3_64_intdigest, xxhash.xxh3_128_intdigest
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            out = []
            for t1, t2, text in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode()
                for a, p, e in regions(data, least, words):
                    r = whole(data[p:e])
                    out.append((t1, t2, a, p, e, _signed(gram(data[a : a + GRAM])), _signed(r >> 64), _signed(r & (2**64 - 1))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["t1", "t2", "a", "p", "e", "kh", "r1", "r2"])

    return run


def _common(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    return int(np.argmax(np.frombuffer(x, np.uint8, n) != np.frombuffer(y, np.uint8, n)))


def multikey_quicksort(keys: list[bytes]) -> list[int]:
    """The order of ``keys``: partitions by eight bytes into less, equal and greater; the equal ones go on eight bytes further."""
    out: list[int] = []
    todo = [(list(range(len(keys))), 0, False)]
    while todo:
        rows, at, done = todo.pop()
        if done or len(rows) <= 16:
            out += rows if done else sorted(rows, key=lambda i: keys[i][at:])
            continue
        tokens = [keys[i][at : at + 8] for i in rows]
        pivot = sorted((tokens[0], tokens[len(rows) // 2], tokens[-1]))[1]
        parts: tuple[list, list, list] = ([], [], [])
        for i, t in zip(rows, tokens):
            parts[1 if t == pivot else 0 if t < pivot else 2].append(i)
        # A pivot of fewer than eight bytes is a key's end: the keys that have it are equal.
        todo += [(parts[2], at, False), (parts[1], at + 8, len(pivot) < 8), (parts[0], at, False)]
    return out


class _Region:
    """A region's bytes, with the one before and the one after, if there are any."""

    def __init__(self, row: dict) -> None:
        self.key, self.a, self.once = (row["t1"], row["t2"]), row["a"], row["once"]
        self.data, self.base = row["bytes"], max(row["p"] - 1, 0)
        self.left = self.data[row["p"] - self.base : self.a - self.base][::-1]
        self.right = self.data[self.a - self.base : row["e"] - self.base]
        self.spans: set[tuple[int, int]] = set()

    def gap(self, at: int) -> bool:
        """Whether position ``at`` of the text is between words."""
        return at < self.base or at - self.base >= len(self.data) or self.data[at - self.base] in _GAPS


def _meet(x: _Region, y: _Region, left: int, right: int, least: int, words: int) -> None:
    """Notes what x and y have in common around their suffixes, if it is long enough."""
    if not (x.once or y.once):
        return
    low, high = -left, right
    if left + right < least:
        if left + right < 2 * words - 1:
            return
        own = [m.span() for m in _WORD.finditer(x.data, x.a - left - x.base, x.a + right - x.base)]
        if own and not (x.gap(x.a - left - 1) and y.gap(y.a - left - 1)) and own[0][0] == x.a - left - x.base:
            own = own[1:]
        if own and not (x.gap(x.a + right) and y.gap(y.a + right)) and own[-1][1] == x.a + right - x.base:
            own = own[:-1]
        if len(own) < words:
            return
        low, high = own[0][0] + x.base - x.a, own[-1][1] + x.base - x.a
    for r in (x, y):
        if r.once:
            r.spans.add((r.a + low, r.a + high))


def compare(group: list[_Region], least: int, words: int) -> None:
    """Meets the regions of a group, sorted by suffix, that have the longest parts in common.

    Blocks of suffixes are merged by falling common prefix t; a merged pair has exactly t bytes in common on the right.
    A block is in the order of the bytes on the left, so that a region has most in common there with its neighbours, and
    those that it already had were met with a longer t.
    """
    prefix = [_common(x.right, y.right) for x, y in zip(group, group[1:])]
    up = list(range(len(group)))
    blocks: list = [([r.left], [r]) for r in group]

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for k in sorted(range(len(prefix)), key=lambda k: -prefix[k]):
        small, large = sorted((top(k), top(k + 1)), key=lambda i: len(blocks[i][0]))
        up[small] = large
        keys, rows = blocks[large]
        for left, r in zip(*blocks[small]):
            at = bisect_left(keys, left)
            for near in (at - 1, at):
                if 0 <= near < len(keys):
                    _meet(r, rows[near], _common(left, keys[near]), prefix[k], least, words)
            keys.insert(at, left)
            rows.insert(at, r)
        blocks[small] = None


def _buckets(least: int, words: int):
    """Sorts a bucket's regions and compares those with equal leading tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [_Region(r) for batch in batches for r in batch.to_pylist()]
        rows = [rows[i] for i in multikey_quicksort([r.right for r in rows])]
        at = 0
        while at < len(rows):
            to = at + 1
            while to < len(rows) and rows[to].right[:GRAM] == rows[at].right[:GRAM]:
                to += 1
            compare(rows[at:to], least, words)
            at = to
        yield from _spans((r.key, sorted(r.spans)) for r in rows if r.spans)

    return run


def _spans(found) -> Iterator[pa.RecordBatch]:
    out = [(*key, s, e) for key, spans in found for s, e in spans]
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["t1", "t2", "s", "e"])


def _windows(least: int, words: int):
    """A row for each window of ``least`` bytes, and each shorter one of ``words`` whole words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = xxhash.xxh3_128_intdigest
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                x = _Region(row)
                low, high = row["p"] - x.base, row["e"] - x.base
                spans = [(i, i + least) for i in range(low, high - least + 1)]
                own = [m.span() for m in _WORD.finditer(x.data, low, high)]
                own = [w for w in own if x.gap(x.base + w[0] - 1) and x.gap(x.base + w[1])]
                spans += [(b, e) for (b, _), (_, e) in zip(own, own[words - 1 :]) if e - b < least]
                for b, e in spans:
                    h = whole(x.data[b:e])
                    out.append((*x.key, x.base + b, x.base + e, x.once, _signed(h >> 64), _signed(h & (2**64 - 1))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["t1", "t2", "s", "e", "ask", "h1", "h2"])

    return run


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def cut_out(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """What remains of ``data`` without the merged spans."""
    return b"".join(data[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(data)]))


def repeated_spans(texts: DataFrame, least: int = LEAST, words: int = WORDS, task_regions: int = TASK_REGIONS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(t1, t2, spans ARRAY of STRUCT<s, e>) of what is repeated in ``texts`` (t1, t2, text); (t1, t2) is the text's key.

    Spans shorter than ``least`` are passages of ``words`` words.
    """
    texts = texts.where(F.octet_length("text") >= min(least, 2 * words - 1))
    schema = T._parse_datatype_string("t1 bigint, t2 bigint, a int, p int, e int, kh bigint, r1 bigint, r2 bigint")
    sampled = staged(texts.select("t1", "t2", "text").mapInArrow(_sample(least, words), schema), "suffixes")
    # Leading tokens that occur twice, and what may have them: the rest is not shuffled again.
    twice = staged(sampled.groupBy("kh").agg(F.count("*").alias("n")).where("n > 1").select("kh"), "leading-tokens")
    sampled = maybe_members(sampled, "kh", twice)
    own = F.xxhash64("t1", "t2", "a")
    counted = sampled.groupBy("kh", "r1", "r2").agg(F.count("*").alias("n"), F.min(own).alias("rep"))
    # Leading tokens that several regions share, at least one of which occurs once.
    shared = counted.groupBy("kh").agg(F.count("*").alias("m"), F.min("n").alias("least_n")).where("m > 1 and least_n = 1").select("kh", "m")
    known = counted.join(shared, "kh", "left").where("n > 1 or m > 1").select("kh", "r1", "r2", "n", "rep", "m")
    edge = F.coalesce((F.col("m") > 1) & (own == F.col("rep")), F.lit(False))
    marked = sampled.join(known, ["kh", "r1", "r2"]).select(
        "t1", "t2", "a", "p", "e", (F.col("n") == 1).alias("once"), edge.alias("compare"), F.coalesce(F.col("m") > group_rows, F.lit(False)).alias("hot")
    )
    marked = staged(marked, "marked")

    def compared(which) -> DataFrame:
        """The bytes of these regions; only texts that may hold some are shuffled."""
        regions_ = marked.where(F.col("compare") & which)
        asked = regions_.groupBy("t1", "t2").agg(F.collect_set(F.struct("a", "p", "e", "once")).alias("asked"))
        needed = maybe_members(texts.select("t1", "t2", "text"), "t1", regions_.select("t1")).dropDuplicates(["t1", "t2"])
        cut = needed.join(asked, ["t1", "t2"]).select("t1", "t2", F.col("text").cast("binary").alias("data"), F.explode("asked").alias("x"))
        return cut.select("t1", "t2", "x.a", "x.p", "x.e", "x.once", F.expr("substring(data, greatest(x.p - 1, 0) + 1, x.e + 1 - greatest(x.p - 1, 0))").alias("bytes"))

    parts = parts_for(marked.where("compare and not hot").count(), task_regions, task_regions // 4 or 1)
    tokens = F.expr(f"substring(bytes, a - greatest(p - 1, 0) + 1, {GRAM})")
    found = compared(~F.col("hot")).repartitionByRange(parts, tokens).mapInArrow(_buckets(least, words), "t1 bigint, t2 bigint, s bigint, e bigint")
    long_ = lambda c: F.col(c).cast("bigint").alias(c)
    every = found.union(marked.where(~F.col("once")).select("t1", "t2", long_("p"), long_("e")))
    if marked.where("hot").limit(1).count():
        w_schema = T._parse_datatype_string("t1 bigint, t2 bigint, s bigint, e bigint, ask boolean, h1 bigint, h2 bigint")
        windows = staged(compared(F.col("hot")).mapInArrow(_windows(least, words), w_schema), "windows")
        again = windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
        every = every.union(windows.where("ask").join(again, ["h1", "h2"]).select("t1", "t2", "s", "e"))
    return every.groupBy("t1", "t2").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


def deduplicate(docs: DataFrame, least: int = LEAST, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, task_regions: int = TASK_REGIONS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(id, n_bytes, n_removed, spans ARRAY of STRUCT<s, e>, n_passage, kept_sha256[, kept BINARY]): a row for each row of ``docs``.

    ``n_passage``: bytes in removed spans or in repeated passages of ``words`` words, which stay. Only texts that may have
    spans are shuffled to them; the others are passed on where they are read.
    """
    t1, t2 = text_keys(F.col(f"`{text_col}`"))
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), t1.alias("t1"), t2.alias("t2"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    spans = staged(repeated_spans(keyed, least, words, task_regions, group_rows), "spans")
    schema = T._parse_datatype_string(f"id {type_of(keyed, 'id')}, n_bytes bigint, n_removed bigint, spans array<struct<s:bigint,e:bigint>>, n_passage bigint, kept_sha256 string" + ", kept binary" * with_text)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data, every = text.encode(), [(x["s"], x["e"]) for x in found or ()]
                gone = merged([x for x in every if x[1] - x[0] >= least])
                kept = cut_out(data, gone)
                passage = sum(e - s for s, e in merged(every))
                out.append((len(data), len(data) - len(kept), gone, passage, hashlib.sha256(kept).hexdigest(), kept)[: 6 if with_text else 5])
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*out), list(arrow)[1:]))], names=schema.names)

    touched = maybe_members(keyed, "t1", spans.select("t1")).join(spans, ["t1", "t2"], "left").select("id", "text", "spans").mapInArrow(run, schema)
    data, zero = F.col("text").cast("binary"), F.lit(0).cast("bigint")
    whole = maybe_members(keyed, "t1", spans.select("t1"), keep=False).select(
        "id",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        zero.alias("n_removed"),
        F.array().cast(schema["spans"].dataType).alias("spans"),
        zero.alias("n_passage"),
        F.sha2(data, 256).alias("kept_sha256"),
        *[data.alias("kept")] * with_text,
    )
    return touched.union(whole).withColumnRenamed("id", id_col)
