"""Language identification by rank-order profiles of character n-grams.

A profile is the ``PROFILE`` most frequent 1- to 3-grams of letters, other characters being one space. A document's
own most frequent n-grams are compared to every language's by out-of-place distance: the sum of rank differences,
``PROFILE`` for an n-gram that the language lacks. The nearest language wins, ties to the first by code point; the
score is one less the distance divided by its largest possible value.

Profiles are fitted on all labelled documents, and so are the scores below which a text is rejected; every text counts
as a whole.

Cases: null text, and text without a letter, give ``und`` and 0.0; with nothing to learn from, so does every text; rows
with null text or language teach nothing; repeated rows count as often as they occur and return once each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, slices, staged, type_of

PROFILE = 300
MAX_LANGUAGES = 2000
#: N-grams that a task counts before it hands them on.
TALLY = 1 << 18
UNKNOWN = "und"
#: Share of the low score of a language's own texts below which a text is not taken for that language.
REJECT = 0.6
#: Share of a language's recognised labelled texts that may score below its low score.
LOW = 0.01
#: Steps into which scores are cut before the low score is looked for in one or two of them.
BINS = 4096
_OTHER = re.compile(r"[\W\d_]+")


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the 1- to 3-grams; an n-gram's code holds its code points, 21 bits each."""
    letters = _OTHER.sub(" ", (text or "").lower())
    if not any(map(str.isalpha, letters)):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    c = np.frombuffer(f" {letters.strip()} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    two = (c[:-1] << 21) | c[1:]
    every = np.concatenate((c[c != 32], two, (two[:-1] << 21) | c[2:]))
    return np.unique(every, return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, profile: int) -> np.ndarray:
    """The most frequent codes, ties to the smaller code."""
    return codes[np.lexsort((codes, -counts))[:profile]]


def learn(labelled: DataFrame, profile: int = PROFILE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", tally: int = TALLY) -> dict[str, list[int]]:
    """Each language's n-grams in rank order, counted over all rows."""
    rows = labelled.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")).where("text is not null and lang is not null")
    count = rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()
    if count > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not count:
        return {}

    def counted(total: dict) -> Iterator[pa.RecordBatch]:
        for lang, own in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.int64()), pa.array(list(own.values()), pa.int64())], names=["lang", "code", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = defaultdict(lambda: defaultdict(int))
        held = 0
        for batch in slices(batches):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = total[lang]
                held -= len(own)
                for code, n in zip(*(x.tolist() for x in ngrams(text))):
                    own[code] += n
                held += len(own)
                if held >= tally:
                    yield from counted(total)
                    total.clear()
                    held = 0
        yield from counted(total)

    sums = rows.mapInArrow(run, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    top = sums.withColumn("place", place).where(F.col("place") <= profile)
    out: dict[str, list[int]] = {}
    for r in sorted(top.collect(), key=lambda r: (r["lang"], r["place"])):
        out.setdefault(r["lang"], []).append(r["code"])
    return out


class Profiles:
    def __init__(self, profiles: dict[str, list[int]], profile: int = PROFILE) -> None:
        self.size, self.names = profile, sorted(profiles)
        self.tables = []
        for name in self.names:
            codes = np.array(profiles[name], np.int64)
            order = np.argsort(codes)
            self.tables.append((codes[order], order))

    def nearest(self, text: str | None) -> tuple[str, float]:
        codes, counts = ngrams(text)
        if not len(codes) or not self.names:
            return UNKNOWN, 0.0
        own = ranked(codes, counts, self.size)
        rank = np.arange(len(own))
        best, least = "", None
        for name, (sorted_codes, place) in zip(self.names, self.tables):
            at = np.minimum(np.searchsorted(sorted_codes, own), len(sorted_codes) - 1)
            found = sorted_codes[at] == own
            far = int(np.where(found, np.abs(place[at] - rank), self.size).sum())
            if least is None or far < least:
                best, least = name, far
        return best, 1.0 - least / (self.size * len(own))


def predict(docs: DataFrame, profiles: dict[str, list[int]], profile: int = PROFILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score): a row for each row of ``docs``; nothing but the text is looked at."""
    table = Profiles(profiles, profile)
    return map_rows(docs, [id_col, text_col], f"`{id_col}` {type_of(docs, id_col)}, lang_pred string, score double", lambda i, t: [(i, *table.nearest(t))])


def least_scores(labelled: DataFrame, profiles: dict[str, list[int]], profile: int = PROFILE, text_col: str = "text", lang_col: str = "lang") -> dict[str, float]:
    """For each language, ``REJECT`` of the score that 99 % of its recognised labelled rows reach, over all of them.

    The low score lies between the rows at floor and ceiling of ``LOW`` (n - 1), as in percentile(). Equal scores are
    counted, then steps of scores, so that only the one or two steps that hold these rows are sorted.
    """
    rows = labelled.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")).where("text is not null and lang is not null")
    table = Profiles(profiles, profile)
    scored = map_rows(rows, ["lang", "text"], "lang string, found string, score double", lambda n, t: [(n, *table.nearest(t))])
    counts = scored.where("lang = found").groupBy("lang", "score").agg(F.count("*").alias("n"))
    counts = staged(counts.withColumn("step", F.floor(F.col("score") * BINS)), "scores")
    steps = counts.groupBy("lang", "step").agg(F.sum("n").alias("n"))
    every, before = Window.partitionBy("lang"), Window.partitionBy("lang").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.select("lang", "step", "n", (LOW * (F.sum("n").over(every) - 1)).alias("at"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    steps = steps.where((F.col("before") <= F.ceil("at")) & (F.col("before") + F.col("n") > F.floor("at"))).drop("n")
    up_to = Window.partitionBy("lang").orderBy("score")
    near = counts.join(steps, ["lang", "step"]).withColumn("end", F.min("before").over(every) + F.sum("n").over(up_to))
    first = [F.min(F.when(F.col("end") > x, F.col("score"))).alias(name) for name, x in (("a", F.floor("at")), ("b", F.ceil("at")))]
    low = near.groupBy("lang", "at").agg(*first).select("lang", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.floor("at"))).alias("low"))
    return {r["lang"]: REJECT * r["low"] for r in low.collect()}


def identified(docs: DataFrame, profiles: dict[str, list[int]], least_score: float | dict[str, float] = 0.05, profile: int = PROFILE, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is known, with a score of ``least_score`` (of the language; 0.05 for others) or more; the columns stay."""
    least = (lambda name: least_score.get(name, 0.05)) if isinstance(least_score, dict) else lambda name: least_score
    table, at = Profiles(profiles, profile), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = map(table.nearest, batch.column(at).to_pylist())
            yield batch.filter(pa.array([name != UNKNOWN and score >= least(name) for name, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
