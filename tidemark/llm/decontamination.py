"""Benchmark decontamination by a positional inverted index that is distributed by document.

``build_index`` stores the index in the shared folder: a row for each segment of documents (about ``SEGMENT_BYTES`` of
text), with its terms, their numbers of postings and the postings themselves, positions in the segment. One more position
separates documents. Test windows come in blocks of bounded size, each broadcast once: the postings of a window's rarest
term (by its count in the whole index), less its offset in the window, are intersected with those of the others, rarest
first, until exact phrase matches remain. Proximity matches are items whose ``NEAR_TERMS`` rarest different words all stand
within ``NEAR_SPAN`` consecutive words of a document, in any order; they come from the same postings.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z became a-z. A window is ``window`` consecutive words of an
item; an item of fewer, but not none, is one window.

Cases: null or word-free text has no words and no hits; null or word-free items have no windows; a null item_id counts
as an item and is left out of the id list; repeated items count once if their ids are equal; repeated documents return
once each, a null doc_id is kept; a text of any length is in one segment; an empty document table gives an empty result,
an empty benchmark no hits; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import staged, type_of

#: Bytes of text in a segment of the index.
SEGMENT_BYTES = 1 << 20
#: Windows of test items that are sent to the tasks at once (a number for each word, and the different words).
BLOCK_WINDOWS = 1 << 18
NEAR_TERMS, NEAR_SPAN = 5, 30
_CANDIDATES = 1 << 21
#: Word characters as they are after lower-casing, everything else a space.
_FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Segment:
    """The postings of some documents: positions by term, in the order of ``terms``."""

    def __init__(self, terms: pa.Array, counts: np.ndarray, positions: np.ndarray, lengths: np.ndarray) -> None:
        self.terms, self.counts, self.positions, self.lengths = terms, counts.astype(np.int64), positions.astype(np.int64), lengths.astype(np.int64)
        self.begin = np.cumsum(self.lengths + 1) - self.lengths - 1
        self.size = int((self.lengths + 1).sum())
        self.first = np.cumsum(self.counts) - self.counts
        self.keys = np.repeat(np.arange(len(self.counts)), self.counts) * self.size + self.positions

    @classmethod
    def of(cls, texts: list[str | None]) -> Segment:
        number: dict[bytes, int] = {}
        parts, lengths = [], []
        for text in texts:
            words = words_of(text)
            lengths.append(len(words))
            parts.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)))
        lengths = np.array(lengths, np.int32)
        ids = np.concatenate([*parts, np.empty(0, np.int32)])
        at = np.arange(len(ids)) + np.repeat(np.arange(len(lengths)), lengths)
        order = np.argsort(ids, kind="stable")
        return cls(pa.array(list(number), pa.binary()), np.bincount(ids, minlength=len(number)), at[order], lengths)

    def local(self, terms: pa.Array) -> np.ndarray:
        """Numbers here of ``terms``, -1 for those that do not occur."""
        return pc.index_in(terms, value_set=self.terms).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)

    def postings(self, term: int) -> np.ndarray:
        return self.positions[self.first[term] : self.first[term] + self.counts[term]]

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, positions, "right") - 1


class Phrases:
    """Windows of test items as rows of term numbers, grouped by length, and each item's different words."""

    def __init__(self, items: list[tuple[object, str | None]], window: int) -> None:
        number: dict[bytes, int] = {}
        key_number: dict = {}
        rows: dict[int, list[np.ndarray]] = {}
        owners: dict[int, list[np.ndarray]] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        for key, text in items:
            words = words_of(text)
            if not words:
                continue
            ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words))
            k = key_number.setdefault(key, len(key_number))
            size = min(window, len(ids))
            own = np.lib.stride_tricks.sliding_window_view(ids, size)
            rows.setdefault(size, []).append(own)
            owners.setdefault(size, []).append(np.full(len(own), k, np.int32))
            self.items.append((k, np.unique(ids)))
        self.keys, self.words = list(key_number), list(number)
        self.terms = pa.array(self.words, pa.binary())
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size, parts in rows.items():
            table, inverse = np.unique(np.concatenate(parts), axis=0, return_inverse=True)
            pairs = np.unique(np.stack((inverse.ravel(), np.concatenate(owners[size])), axis=1), axis=0)
            self.windows[size] = table, np.searchsorted(pairs[:, 0], np.arange(len(table) + 1)), pairs[:, 1]
        self.count = np.zeros(len(number), np.int64)
        self.near: list[tuple[int, np.ndarray]] = []

    def weigh(self, counts: dict[bytes, int], near_terms: int) -> None:
        """Takes the terms' counts in the whole index; items are looked for near by their rarest words, ties by code point."""
        self.count = np.fromiter((counts.get(w, 0) for w in self.words), np.int64, len(self.words))
        self.near = [(k, np.array(sorted(ids.tolist(), key=lambda t: (self.count[t], self.words[t]))[:near_terms])) for k, ids in self.items]


def _phrase_matches(segment: Segment, local: np.ndarray, table: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of table, position) of all exact phrase matches, by intersecting postings from the rarest term on."""
    size = table.shape[1]
    live = np.flatnonzero((local[table] >= 0).all(axis=1))
    if not len(live):
        return
    rows = local[table[live]]
    rank = np.argsort(count[table[live]], axis=1, kind="stable")
    every = np.arange(len(live))
    term, offset = rows[every, rank[:, 0]], rank[:, 0]
    n, at = segment.counts[term], 0
    while at < len(live):
        to = at + max(1, int(np.searchsorted(np.cumsum(n[at:]), _CANDIDATES)))
        which = np.repeat(np.arange(at, to), n[at:to])
        nth = np.arange(len(which)) - np.repeat(np.cumsum(n[at:to]) - n[at:to], n[at:to])
        start = segment.positions[segment.first[term[which]] + nth] - offset[which]
        for j in range(1, size):
            keep = (start >= 0) & (start + size <= segment.size)
            which, start = which[keep], start[keep]
            if not len(start):
                break
            other = rank[which, j]
            key = rows[which, other] * segment.size + start + other
            place = np.minimum(np.searchsorted(segment.keys, key), len(segment.keys) - 1)
            keep = segment.keys[place] == key
            which, start = which[keep], start[keep]
        if len(start):
            yield live[which], start
        at = to


def _near_matches(segment: Segment, local: np.ndarray, wanted: list[tuple[int, np.ndarray]], span: int) -> Iterator[tuple[int, np.ndarray]]:
    """(item, documents) where all of the item's terms stand within ``span`` consecutive words."""
    for item, terms in wanted:
        own = local[terms]
        if not len(own) or own.min() < 0:
            continue
        lists = [segment.postings(t) for t in own]
        at = np.concatenate(lists)
        label = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        order = np.argsort(at)
        at, label = at[order], label[order]
        last = np.full(len(at), np.iinfo(np.int64).max)
        for r in range(len(lists)):
            last = np.minimum(last, np.maximum.accumulate(np.where(label == r, at, -1)))
        found = (last >= 0) & (at - last < span)
        docs, other = segment.document(at[found]), segment.document(last[found])
        if (docs == other).any():
            yield item, np.unique(docs[docs == other])


def _search(segment: Segment, phrases: Phrases, near_span: int) -> list[pa.Array]:
    """n_words, n_hit, items, n_items, spans, near, n_near of each document."""
    n = len(segment.lengths)
    cover = np.zeros(segment.size + 1, np.int32)
    found: list[set] = [set() for _ in range(n)]
    near: list[set] = [set() for _ in range(n)]
    local = segment.local(phrases.terms)
    for size, (table, first, owners) in phrases.windows.items():
        for row, start in _phrase_matches(segment, local, table, phrases.count):
            np.add.at(cover, start, 1)
            np.add.at(cover, start + size, -1)
            for d, r in np.unique(np.stack((segment.document(start), row)), axis=1).T.tolist():
                found[d].update(owners[first[r] : first[r + 1]].tolist())
    for item, docs in _near_matches(segment, local, phrases.near, near_span):
        for d in docs.tolist():
            near[d].add(item)
    covered = np.cumsum(cover[:-1]) > 0
    hit = np.concatenate(([0], np.cumsum(covered)))
    edge = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
    spans: list[list] = [[] for _ in range(n)]
    for d, a, b in zip(segment.document(edge[::2]).tolist(), edge[::2].tolist(), edge[1::2].tolist()):
        spans[d].append([a - int(segment.begin[d]), b - int(segment.begin[d])])
    names = lambda own: [sorted({str(phrases.keys[k]) for k in x if phrases.keys[k] is not None}) for x in own]
    return [
        pa.array(segment.lengths),
        pa.array(hit[segment.begin + segment.lengths] - hit[segment.begin]),
        pa.array(names(found), pa.list_(pa.string())),
        pa.array([len(x) for x in found], pa.int64()),
        pa.array(spans, pa.list_(pa.list_(pa.int64()))),
        pa.array(names(near), pa.list_(pa.string())),
        pa.array([len(x) for x in near], pa.int64()),
    ]


_FOUND = "n_words bigint, n_hit bigint, items array<string>, n_items bigint, spans array<array<bigint>>, near array<string>, n_near bigint"


def _slices(texts: list[str | None], segment_bytes: int) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to] or "") < segment_bytes):
            size += len(texts[to] or "")
            to += 1
        yield at, to
        at = to


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """(segment, ids ARRAY, lengths ARRAY, terms ARRAY<BINARY>, counts ARRAY, positions ARRAY), stored; all words are indexed."""
    light = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = T._parse_datatype_string(f"segment bigint, ids array<{type_of(light, 'id')}>, lengths array<int>, terms array<binary>, counts array<int>, positions array<int>")

    def one(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for at, to in _slices(texts, segment_bytes):
                x = Segment.of(texts[at:to])
                lists = [batch.column(0).slice(at, to - at), pa.array(x.lengths, pa.int32()), x.terms, pa.array(x.counts, pa.int32()), pa.array(x.positions, pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *map(one, lists)], names=schema.names)
                number += 1

    return staged(light.mapInArrow(run, schema), "positional-index")


def _counts(index: DataFrame, phrases: Phrases) -> dict[bytes, int]:
    """How often the words of ``phrases`` occur in the whole index; only terms and counts are read."""
    terms = index.sparkSession.sparkContext.broadcast(phrases.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = pa.array(terms.value, pa.binary())
        total = np.zeros(len(asked), np.int64)
        for batch in batches:
            at = pc.index_in(batch.column(0).flatten(), value_set=asked).fill_null(-1).to_numpy(zero_copy_only=False)
            n = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            total += np.bincount(at[at >= 0], n[at >= 0], len(asked)).astype(np.int64)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], names=["t", "n"])

    sums = index.select("terms", "counts").mapInArrow(run, "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("n"))
    return {phrases.words[r["t"]]: r["n"] for r in sums.collect()}


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_windows: int) -> Iterator[Phrases]:
    """Whole items, until they have ``block_windows`` windows; at least one block."""
    block, size = [], 0
    for r in benchmark.select(F.col(f"`{item_col}`").alias("k"), F.col(f"`{text_col}`").alias("t")).toLocalIterator():
        block.append((r["k"], r["t"]))
        size += 1 + len(r["t"] or "") // 2
        if size >= block_windows:
            # Half a character a window is the least there can be; what counts is what there is.
            size = sum(1 + len(words_of(t)) for _, t in block)
            if size >= block_windows:
                yield Phrases(block, window)
                block, size = [], 0
    yield Phrases(block, window)


def _found(index: DataFrame, phrases: Phrases, near_span: int, id_type: str) -> DataFrame:
    """(segment, nth, id, ...) of every document of the index."""
    sent = index.sparkSession.sparkContext.broadcast(phrases)
    schema = T._parse_datatype_string(f"segment bigint, nth int, id {id_type}, {_FOUND}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                number, ids, lengths, terms, counts, positions = (batch.column(c)[i] for c in range(6))
                arrays = [x.values.to_numpy(zero_copy_only=False) for x in (counts, positions, lengths)]
                x = Segment(terms.values, *arrays)
                n = len(x.lengths)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, number.as_py())), pa.array(np.arange(n, dtype=np.int32)), ids.values, *_search(x, sent.value, near_span)], names=schema.names)

    return index.mapInArrow(run, schema)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    near_terms: int = NEAR_TERMS,
    near_span: int = NEAR_SPAN,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_windows: int = BLOCK_WINDOWS,
    segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """(id, n_words, n_hit, n_items, items ARRAY, spans ARRAY of [first word, past last word], n_near, near ARRAY), a row for each row of ``docs``."""
    index, id_type = build_index(docs, id_col, text_col, segment_bytes), type_of(docs, id_col)
    parts, last = [], None
    for phrases in _blocks(benchmark, item_col, item_text_col, window, block_windows):
        if last is not None:
            parts.append(staged(last, "hits"))
        phrases.weigh(_counts(index, phrases), near_terms)
        last = _found(index, phrases, near_span, id_type)
    names = [F.col("id").alias(id_col), "n_words", "n_hit", "n_items", "items", "spans", "n_near", "near"]
    if not parts:
        return last.select(*names)
    # More than one block: put the findings together by document. Null items are no block's alone.
    every = staged(last, "hits")
    for p in parts:
        every = every.union(p)

    def ids(column: str):
        return F.array_sort(F.array_distinct(F.flatten(F.collect_list(column)))).alias(column)

    merged = every.groupBy("segment", "nth").agg(
        F.first("id").alias("id"),
        F.max("n_words").alias("n_words"),
        ids("items"),
        F.max(F.col("n_items") - F.size("items")).alias("null_items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        ids("near"),
        F.max(F.col("n_near") - F.size("near")).alias("null_near"),
    )
    joined = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("bigint").alias("hit"), F.lit(0).cast("bigint").alias("end")),
        lambda a, s: F.struct((a["hit"] + F.greatest(F.lit(0), s[1] - F.greatest(a["end"], s[0]))).alias("hit"), F.greatest(a["end"], s[1]).alias("end")),
        lambda a: a["hit"],
    )
    return merged.withColumns({"n_hit": joined, "n_items": F.size("items") + F.col("null_items"), "n_near": F.size("near") + F.col("null_near")}).select(*names)


def proximity(docs: DataFrame, phrases: list[str], span: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, phrase BIGINT): documents where all the words of phrase number ``phrase`` occur within ``span`` consecutive words.

    ``phrases`` are held by every task; those without words are nowhere.
    """
    asked = Phrases(list(enumerate(phrases)), 1)
    asked.windows, asked.near = {}, [(k, ids) for k, ids in asked.items]
    found = _found(build_index(docs, id_col, text_col), asked, span, type_of(docs, id_col))
    return found.select(F.col("id").alias(id_col), F.explode("near").alias("phrase")).withColumn("phrase", F.col("phrase").cast("bigint"))


def uncontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of ``docs`` whose texts hold no window of the benchmark; the columns stay as they are.

    Every segment's index serves for one block and is not stored, for the rows themselves pass on; nulls, empty tables and
    repeated rows as above.
    """
    at, spark = docs.columns.index(text_col), docs.sparkSession

    def keep(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, hits = batch.column(at).to_pylist(), []
                for a, b in _slices(texts, SEGMENT_BYTES):
                    x = Segment.of(texts[a:b])
                    local, hit = x.local(sent.value.terms), np.zeros(b - a, bool)
                    for table, _, _ in sent.value.windows.values():
                        own = np.append(x.counts, 0)[local]
                        for _, start in _phrase_matches(x, local, table, own):
                            hit[x.document(start)] = True
                    hits.append(hit)
                yield batch.filter(pa.array(~np.concatenate([*hits, np.empty(0, bool)])))

        return run

    for phrases in _blocks(benchmark, item_col, item_text_col, window, block_windows):
        docs = docs.mapInArrow(keep(spark.sparkContext.broadcast(phrases)), docs.schema)
    return docs
