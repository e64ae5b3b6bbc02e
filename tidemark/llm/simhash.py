"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified links, connected components.

Fingerprints within ``distance`` bits are cut into ``distance + 2`` blocks. At most ``distance`` blocks differ, so at
least two are equal: every pair of blocks makes a join key (15 keys of 21 or 22 bits for distance 4). With more
fingerprints, three or four equal blocks make longer keys (35 of 27 bits, 70 of 32 bits). Each key's rows are compared by Hamming distance, and only a spanning forest of the verified links leaves the task.

Cases: null or word-free text has fingerprint 0 and links like any other; equal fingerprints are one node, however
many rows carry them; repeated rows return once each; a null doc_id keeps its row and never is a component's
smallest id unless all ids there are null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import free_names, map_rows, maybe_members, parts_for, row_keys, staged, text_keys, type_of

#: Rows of one key that a task compares; a key with more is cut into chunks and each pair of chunks is a unit.
UNIT_ROWS = 4096
#: Rows that a task of units holds, apart from hot keys.
TASK_ROWS = 1 << 18
#: Fingerprints that are to share a key by chance; with more, keys are made of more blocks.
KEY_ROWS = 64
_PART = 1 << 16


def simhash(text: str | None, shingle: int) -> int:
    """Signed 64-bit fingerprint of the word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    if n < 1:
        hashes = np.array([digest(joined, 42)], np.uint64)
    else:
        length = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(length) + np.arange(len(words))
        spans = zip((end - length)[:n].tolist(), end[shingle - 1 :].tolist())
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in spans), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _PART):
        part = hashes[at : at + _PART].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp BIGINT), a row for each row."""
    return map_rows(docs, [id_col, text_col], f"`{id_col}` {type_of(docs, id_col)}, fp bigint", lambda i, t: [(i, simhash(t, shingle))])


def blocks_of_key(n: int, distance: int) -> int:
    """The least number of equal blocks, 2 and more, whose bits leave about ``KEY_ROWS`` of n fingerprints to a key."""
    equal = 2
    while n > KEY_ROWS * 2 ** (64 * equal / (distance + equal)) and equal < 4:
        equal += 1
    return equal


def _block_keys(distance: int, equal: int):
    """The join keys as expressions over fp: every choice of ``equal`` of ``distance + equal`` blocks."""
    n = distance + equal
    widths = [64 // n + (i < 64 % n) for i in range(n)]
    starts = [sum(widths[:i]) for i in range(n)]
    blocks = [F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1).cast("bigint")) for s, w in zip(starts, widths)]
    keys = []
    for c, own in enumerate(combinations(range(n), equal)):
        if sum(widths[i] for i in own) < 50:
            key = F.lit(c).cast("bigint")
            for i in own:
                key = F.shiftleft(key, widths[i]) + blocks[i]
            keys.append(key)
        else:
            keys.append(F.xxhash64(F.lit(c), *(blocks[i] for i in own)))
    return keys


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of each run of equal keys."""
    start = np.concatenate(([0], np.flatnonzero(np.diff(key)) + 1))
    return start, np.diff(np.concatenate((start, [len(key)])))


def _forest(key: np.ndarray, node: np.ndarray, fits: Callable) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(a, b): pairs of a key's rows for which ``fits`` (row or rows, rows) holds, that span each key's components. Rows come sorted by key."""
    start, size = _runs(key)
    few = np.repeat(size <= 8, size)
    for d in range(1, min(8, len(key))):
        at = np.flatnonzero(few[d:] & (key[d:] == key[:-d]))
        hit = at[fits(at, at + d)]
        if len(hit):
            yield node[hit], node[hit + d]
    for s, n in zip(start[size > 8].tolist(), size[size > 8].tolist()):
        rest, front = np.arange(s, s + n), []
        while len(rest):
            if not front:
                front, rest = [rest[0]], rest[1:]
                continue
            x = front.pop()
            hit = fits(x, rest)
            if hit.any():
                found, rest = rest[hit], rest[~hit]
                yield np.full(len(found), node[x]), node[found]
                front.extend(found.tolist())


def _near(fp: np.ndarray, distance: int) -> Callable:
    """fp: a row of 64-bit words for each node."""
    return lambda i, j: _apart(fp[j], fp[i]) <= distance


def _links_of_units(pairs: Callable, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 4 + words), np.int64)  # key, c1, c2, node, words

        def done(x: np.ndarray) -> Iterator[pa.RecordBatch]:
            unit = np.concatenate(([0], np.cumsum((x[1:, :3] != x[:-1, :3]).any(axis=1))))
            found = [np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1) for a, b in pairs(unit, x[:, 3], x[:, 4:])]
            if found:
                found = np.unique(np.concatenate(found), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in found.T], names=["a", "b"])

        for batch in batches:
            got = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            held = np.concatenate((held, got))
            if not len(held):
                continue
            other = np.flatnonzero((held[:, :3] != held[-1, :3]).any(axis=1))
            if len(other):
                whole = int(other[-1]) + 1
                yield from done(np.ascontiguousarray(held[:whole]))
                held = held[whole:].copy()
        if len(held):
            yield from done(np.ascontiguousarray(held))

    return run


def _chunks(keyed: DataFrame, amount: Column, most: int, total: int) -> DataFrame:
    """(key, chunks) of the keys whose ``amount``, of ``total``, is above ``most``."""
    return staged(keyed.groupBy("key").agg(F.ceil(amount / F.lit(most)).alias("chunks")).where("chunks > 1"), "hot-keys", total // most)


def _paired(keyed: DataFrame, columns: list[str]) -> DataFrame:
    """(key, c1, c2, node, columns): rows of a key with ``chunks`` (null: one) go to every pair of chunks that has their own."""
    zero, chunks = F.lit(0).cast("bigint"), F.coalesce("chunks", F.lit(1).cast("bigint"))
    own = F.pmod(F.xxhash64("node", "key"), chunks)
    rows = keyed.select("key", "node", *columns, own.alias("own"), F.explode(F.sequence(zero, chunks - 1)).alias("other"))
    return rows.select("key", F.least("own", "other").alias("c1"), F.greatest("own", "other").alias("c2"), "node", *columns)


def _links(keyed: DataFrame, words: list[str], pairs: Callable, unit_rows: int) -> DataFrame:
    """``keyed``: (key, node, words), written. (a, b): what ``pairs`` (units, nodes, words) yields for units of rows with equal keys."""
    rows = keyed.count()
    hot = _chunks(keyed, F.count("*"), unit_rows, rows)
    zero = F.lit(0).cast("bigint")
    if hot.limit(1).count() == 0:
        units = keyed.select("key", zero.alias("c1"), zero.alias("c2"), "node", *words)
    else:
        units = _paired(keyed.join(hot, "key", "left"), words)
    dealt = units.repartition(parts_for(rows, TASK_ROWS, TASK_ROWS >> 5), "key", "c1", "c2").sortWithinPartitions("key", "c1", "c2", "node")
    found = dealt.mapInArrow(_links_of_units(pairs, len(words)), "a bigint, b bigint")
    return found.where("a <> b").distinct()


def links(fps: DataFrame, distance: int = 4, unit_rows: int = UNIT_ROWS, equal: int | None = None) -> DataFrame:
    """(a, b): verified links between distinct fingerprints that span every component.

    ``equal``: blocks that make a key; by default as many as the number of fingerprints asks for.
    """
    equal = equal or blocks_of_key(fps.count(), distance)
    keyed = fps.select(F.col("fp").alias("node"), "fp", F.explode(F.array(*_block_keys(distance, equal))).alias("key"))
    return _links(keyed, ["fp"], lambda unit, node, x: _forest(unit, node, _near(x.view(np.uint64), distance)), unit_rows)


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), root the smallest node of its component.

    Alternates large-star and small-star until the edge set stays the same; each round is a few shuffles over
    the edges, and the number of rounds grows with the logarithm of the longest chain.
    """
    state = staged(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("v <> u").distinct(), "edges")
    sign = None
    rows = state.count()
    while True:
        both = state.union(state.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("m"))
        large = both.join(low, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v <> u").distinct()
        low2 = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low2, "v").select(F.greatest("u", "v").alias("x"), "v", "u", "m")
        small = small.select(F.explode(F.array(F.struct(F.col("u").alias("v"), F.col("m").alias("u")), F.struct("v", F.col("m").alias("u")))).alias("e")).select("e.v", "e.u")
        # A round leaves as many edges as it finds, at most.
        state = staged(small.where("v <> u").distinct(), "edges", rows)
        now = state.agg(F.count("*"), F.expr("bit_xor(xxhash64(v, u))"), F.expr("sum(cast(hash(v, u) as bigint))")).first()
        if now == sign:
            break
        sign = now
    root = state.groupBy("v").agg(F.min("u").alias("root")).withColumnRenamed("v", "node")
    return root.union(state.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text", unit_rows: int = UNIT_ROWS) -> DataFrame:
    """(id, fp, group, component_id): ``group`` is the smallest fingerprint of the component, ``component_id`` its smallest id."""
    marked = staged(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = staged(marked.groupBy("fp").agg(F.min(f"`{id_col}`").alias("least_id")), "nodes", marked.count())
    roots = connected(links(nodes.select("fp"), distance, unit_rows))
    grouped = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least_id", F.coalesce("root", "fp").alias("group"))
    ids = grouped.groupBy("group").agg(F.min("least_id").alias("component_id"))
    classes = staged(grouped.join(ids, "group").select("fp", "group", "component_id"), "classes", nodes.count())
    return marked.join(classes, "fp").select(id_col, "fp", "group", "component_id")


#: 64-bit words of the wide fingerprints of shingles.
WIDE = 4
#: Standard deviations above the distance that the threshold stands for at which a pair is taken to be below it.
BEYOND = 8.0
#: Texts that are looked at for shingles that many share, and how many of those shingles are kept.
SAMPLE_TEXTS, COMMON = 8192, 50_000
#: Shingles of a cluster that one task holds (twice); a cluster with more is cut into chunks and each pair of chunks is a unit.
UNIT_SHINGLES = 1 << 20
_U = np.uint64


def _mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = (x ^ _U(salt)) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles (of the whole sequence, if it is shorter), signed."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.int64)
    digest, n = xxhash.xxh3_64_intdigest, min(shingle, len(words))
    w = np.fromiter(map(digest, words), np.uint64, len(words))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        h = _mixed(h ^ w[i : i + len(h)], i + 1)
    return np.unique(h.view(np.int64))


def _wide(hashes: np.ndarray) -> np.ndarray:
    """Majority bits of the hashes, mixed anew for each of the ``WIDE`` words; signed."""
    ones = np.zeros(64 * WIDE, np.int64)
    for at in range(0, len(hashes), _PART):
        part = hashes[at : at + _PART].view(np.uint64)
        bits = np.stack([_mixed(part, 1000 + i) for i in range(WIDE)], axis=1).view(np.uint8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")


def common_shingles(docs: DataFrame, shingle: int, text_col: str = "text", sample: int = SAMPLE_TEXTS, most: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of shingles that several of about ``sample`` texts hold, by hash. It orders prefixes and decides nothing."""
    share = min(1.0, sample / max(1, docs.count()))
    texts = docs.select(F.col(f"`{text_col}`").alias("t")).where(F.pmod(F.xxhash64("t"), F.lit(1 << 30)) < share * float(1 << 30)).distinct()

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, n = np.unique(np.concatenate([*(shingle_set(t, shingle) for t in batch.column(0).to_pylist()), np.empty(0, np.int64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int64))], names=["h", "n"])

    sums = texts.mapInArrow(tally, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    rows = sorted((r["h"], r["n"]) for r in sums.orderBy(F.desc("n"), "h").limit(most).collect())
    return np.array([h for h, _ in rows], np.int64), np.array([n for _, n in rows], np.int64)


def rare_prefix(hashes: np.ndarray, similarity: float, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first shingles of a set, shared ones last, of which sets with ``similarity`` or more have one in common.

    Such sets share ceil(similarity * n) of either's n shingles; so they can't miss each other in the first
    n - ceil(similarity * n) + 1 of an order that is the same for all sets.
    """
    n = len(hashes)
    if not n:
        return hashes
    keep = n - math.ceil(similarity * n - 1e-9) + 1
    codes, counts = common
    if not len(codes):
        return hashes[:keep]
    at = np.minimum(np.searchsorted(codes, hashes), len(codes) - 1)
    return hashes[np.argsort(np.where(codes[at] == hashes, counts[at], 0), kind="stable")[:keep]]


def most_apart(similarity: float) -> int:
    """Bits of the wide fingerprints beyond which a pair lacks this Jaccard similarity of its shingles.

    Fingerprints of equally large sets differ in a binomial number of bits; the bound lies ``BEYOND`` deviations above its mean.
    """
    bits, p = 64 * WIDE, math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.ceil(bits * p + BEYOND * math.sqrt(bits * p * (1 - p)))


def _maybe_alike(size: np.ndarray, fp: np.ndarray, similarity: float) -> Callable:
    """Whether sizes and fingerprints allow ``similarity``."""
    far = most_apart(similarity)

    def fits(i, j: np.ndarray) -> np.ndarray:
        ok = (size[j] >= similarity * size[i] - 1e-9) & (size[j] * similarity <= size[i] + 1e-9)
        return ok & (_apart(fp[j], fp[i]) <= far)

    return fits


def alike(sets: list[np.ndarray], similarity: float) -> Iterator[tuple[int, int]]:
    """(i, j): pairs with a Jaccard similarity of ``similarity`` or more that span the components of all such pairs. No set is empty."""
    size = np.array([len(x) for x in sets], np.int64)
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    start = np.cumsum(size) - size
    held = np.zeros(int(ids.max(initial=-1)) + 1, np.int8)
    rest, flat, live = np.arange(len(sets)), ids, np.ones(len(sets), bool)
    front: list[int] = []
    while live.any():
        if 2 * live.sum() < len(rest):
            flat, rest = flat[np.repeat(live, size[rest])], rest[live]
            live = np.ones(len(rest), bool)
        if not front:
            first = int(np.argmax(live))
            front, live[first] = [int(rest[first])], False
            continue
        x = front.pop()
        fits = live & (size[rest] >= similarity * size[x] - 1e-9) & (size[rest] * similarity <= size[x] + 1e-9)
        if not fits.any():
            continue
        own = ids[start[x] : start[x] + size[x]]
        held[own] = 1
        both = np.add.reduceat(held[flat], np.cumsum(size[rest]) - size[rest], dtype=np.int64)
        held[own] = 0
        fits &= both * (1 + similarity) >= (size[rest] + size[x]) * similarity - 1e-9
        live &= ~fits
        for y in rest[fits].tolist():
            yield x, y
            front.append(y)


def _verified(shingle: int, similarity: float):
    """Rows (key, c1, c2, node, text) come sorted by the first three; links of each unit that span its components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, sets = None, [], []

        def done() -> Iterator[pa.RecordBatch]:
            if len(sets) > 1 and (pairs := list(alike(sets, similarity))):
                at = np.array(nodes, np.int64)[np.array(pairs)]
                yield pa.RecordBatch.from_arrays([pa.array(at.min(axis=1)), pa.array(at.max(axis=1))], names=["a", "b"])

        for batch in batches:
            for *unit, node, text in zip(*(c.to_pylist() for c in batch.columns)):
                if unit != now:
                    yield from done()
                    now, nodes, sets = unit, [], []
                nodes.append(node)
                sets.append(shingle_set(text, shingle))
        yield from done()

    return run


def _grouped(light: DataFrame, shingle: int, similarity: float, unit_rows: int, unit_shingles: int) -> DataFrame:
    """``light``, (..., t1, t2, text), with ``group`` in place of ``text``; (t1, t2) is the text's key."""
    common, carried = common_shingles(light, shingle), light.columns[:-1]
    own = [f"v{i}" for i in range(WIDE)]
    schema = T.StructType([*light.schema.fields[:-1], *T._parse_datatype_string("n1 bigint, n2 bigint, size bigint, " + ", ".join(f"{n} bigint" for n in own) + ", prefix array<bigint>").fields])

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sets = [shingle_set(t, shingle) for t in batch.column(batch.num_columns - 1).to_pylist()]
            node = np.array([np.frombuffer(xxhash.xxh3_128_digest(x.tobytes()), "<i8") for x in sets])
            wide = np.array([_wide(x) for x in sets])
            prefix = [rare_prefix(x, similarity, common) for x in sets]
            ends = np.cumsum([0, *map(len, prefix)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(prefix)))
            numbers = [node[:, 0], node[:, 1], np.array([len(x) for x in sets], np.int64), *wide.T]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(np.ascontiguousarray(x)) for x in numbers), lists], names=schema.names)

    marked = staged(light.mapInArrow(described, schema), "wide-fingerprints")
    facts = [F.first(c).alias(c) for c in ("size", *own, "prefix")]
    # Numbers of the distinct sets are written once, so that no two share one.
    nodes = staged(marked.groupBy("n1", "n2").agg(F.min(F.struct("t1", "t2")).alias("t"), *facts).withColumn("node", F.monotonically_increasing_id()), "shingle-sets", marked.count())
    shared = nodes.select("node", F.explode("prefix").alias("key")).withColumn("n", F.count("*").over(Window.partitionBy("key")))
    shared = staged(shared.where("n > 1").select("node", "key"), "shared-shingles")
    keyed = staged(shared.join(nodes.select("node", "size", *own), "node"), "wide-nodes")

    def maybe(unit: np.ndarray, node: np.ndarray, x: np.ndarray) -> Iterator[tuple]:
        return _forest(unit, node, _maybe_alike(x[:, 0], np.ascontiguousarray(x[:, 1:]).view(np.uint64), similarity))

    clusters = connected(_links(keyed, ["size", *own], maybe, unit_rows)).withColumnRenamed("root", "key")
    asked = staged(nodes.select("node", "size", "t.t1", "t.t2").join(clusters, "node"), "clusters", nodes.count())
    shingles = asked.agg(F.sum("size")).first()[0] or 0
    # Of the texts only those of clusters are shuffled, one of each kind.
    texts = maybe_members(light.select("t1", "t2", "text"), "t1", asked.select("t1")).dropDuplicates(["t1", "t2"])
    asked = asked.join(_chunks(asked, F.sum("size"), unit_shingles, shingles), "key", "left")
    units = _paired(asked, ["t1", "t2"]).join(texts, ["t1", "t2"])
    parts = parts_for(shingles, unit_shingles, unit_shingles >> 4)
    dealt = units.select("key", "c1", "c2", "node", "text").repartition(parts, "key", "c1", "c2").sortWithinPartitions("key", "c1", "c2")
    found = staged(dealt.mapInArrow(_verified(shingle, similarity), "a bigint, b bigint"), "near-links", asked.count())
    roots = nodes.select("n1", "n2", "node").join(connected(found), "node", "left").select("n1", "n2", F.coalesce("root", "node").alias("group"))
    return marked.select(*carried, "n1", "n2").join(roots, ["n1", "n2"]).select(*carried, "group")


def similar_groups(
    docs: DataFrame, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", unit_rows: int = UNIT_ROWS, unit_shingles: int = UNIT_SHINGLES
) -> DataFrame:
    """(id, group), a row for each row: documents whose shingle sets have a Jaccard similarity of ``similarity`` or more are linked.

    A 64-bit fingerprint within 4 bits only holds near-identical shingle sets. Here pairs meet that share a shingle of
    their rare prefixes, which no pair of ``similarity`` or more lacks. Sizes and wide fingerprints of the shingles (256
    bits) tell which of them can be alike; a task passes on links that span these, at most a link a row. The clusters
    that come of it are compared by their shingle sets, again within tasks that pass on spanning links, so that no pair
    leaves the task that finds it. Texts without words are one group; ids may be null or repeated.
    """
    t1, t2 = text_keys(F.col(f"`{text_col}`"))
    light = docs.select(F.col(f"`{id_col}`").alias("id"), t1.alias("t1"), t2.alias("t2"), F.col(f"`{text_col}`").alias("text"))
    return _grouped(light, shingle, similarity, unit_rows, unit_shingles).select(F.col("id").alias(id_col), "group")


def keep_one(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` of which one stays for each group of ``similar_groups``: the smallest id, null last.

    The columns stay as they are, whatever their names. Of rows that are equal throughout one stays. Only rows of groups
    with several are shuffled.
    """
    r1, r2 = free_names(docs, 2)
    keyed = row_keys(docs, r1, r2)
    t1, t2 = text_keys(F.col(f"`{text_col}`"))
    light = keyed.select(F.col(f"`{id_col}`").alias("id"), F.col(r1).alias("r1"), F.col(r2).alias("r2"), t1.alias("t1"), t2.alias("t2"), F.col(f"`{text_col}`").alias("text"))
    grouped = staged(_grouped(light, shingle, similarity, UNIT_ROWS, UNIT_SHINGLES).select("id", "r1", "r2", "group"), "near-groups")
    rows = grouped.count()
    place = F.struct(F.col("id").isNull().alias("none"), "id", "r1", "r2")
    best = grouped.groupBy("group").agg(F.min(place).alias("x"), F.count("*").alias("n")).where("n > 1")
    best = staged(best.select("group", F.col("x.r1").alias(r1), F.col("x.r2").alias(r2)), "near-winners", rows)
    several = staged(grouped.join(best.select("group"), "group", "left_semi").select(F.col("r1").alias(r1), F.col("r2").alias(r2)).distinct(), "near-rows", rows)
    lone = maybe_members(keyed, r1, several, keep=False)
    maybe = maybe_members(keyed, r1, several)
    winners = maybe.join(best.select(r1, r2), [r1, r2], "left_semi").dropDuplicates([r1, r2])
    others = maybe.join(several, [r1, r2], "left_anti")
    return lone.unionByName(winners).unionByName(others).select(*(F.col(f"`{c}`") for c in docs.columns))
