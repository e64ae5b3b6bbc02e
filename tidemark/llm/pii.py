"""Information-theoretic sanitisation of personal data; DataFrame functions only.

Protected entities are the values of the base patterns (email, ip, card, phone). Documents that hold both an entity and
a term (a word of ``LEAST_TERM`` letters and more) give co-occurrence counts over all documents:
IC(e) = log2(N / df(e)) is what the entity's mention tells, PMI(t, e) = log2(N n(t, e) / (df(t) df(e))) how much of it the
term gives away. A term with PMI >= ``DISCLOSURE`` IC for any entity is disclosive, in however few texts they stand:
wherever it stands, in any document, it is a span of kind ``term``, and the sanitised text generalises it (or drops it).
Entities that stand in the same texts have the same counts and are one class, and so are terms: only classes are paired,
so that a text of many entities that stand nowhere else pairs its terms once.

Matching a pattern splits the text at the matches, so that lengths of pieces and matches add up to positions. Patterns
are written without backtracking and start only where a run of their characters starts. Running sums go over blocks of
about the square root of the matches' number, so that a text of k matches takes k ** 1.5 steps at most.

Spans are code points, end exclusive, by start, then kind. Cases: null text is empty and has no spans; repeated rows
return once each and count as documents; a null id is kept; overlapping spans of different base kinds all are listed, and
become one replacement; terms that overlap a base span are not; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import maybe_members, staged, text_keys

KINDS = ("email", "ip", "card", "phone", "term")
LEAST_TERM = 4
DISCLOSURE = 0.8

_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
#: Each equals the plain pattern: a match can only start where a run starts, or right after the match before.
_EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++"
_IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+"
_CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: The ranges are those that [^\x00-\x40\x5B-\x60\x7B-\x7F] leaves; a complement of ranges takes many times as long,
#: the more so the more tasks of an executor match it at once.
_TERM = rf"[A-Za-z\x{{80}}-\x{{10FFFF}}]{{{LEAST_TERM},}}+"
_SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def _let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _scan(items: Column, zero: Column, add, make, out_type: str) -> Column:
    """``make(item, sum before it)`` of the items for which it is not null, ``add(sum, item)`` being the sum after one.

    Sums of blocks come first, then sums before blocks, then those within: no list longer than a block, or than the list of
    blocks, is copied for an item. ``add`` must take a sum, too, in an item's place: it gets it as (sum, None, that sum).
    """
    none = F.array().cast(out_type)

    def cut(x: Column) -> Column:
        size = F.greatest(F.ceil(F.sqrt(F.size(x))), F.lit(1)).cast("int")
        return F.transform(F.sequence(F.lit(0), F.ceil(F.size(x) / size).cast("int") - 1), lambda i: F.slice(x, i * size + 1, size))

    def starts(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda a, x: add(a, x, None)))
        first = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(totals, first, lambda a, t: F.struct(add(a["at"], None, t).alias("at"), F.array_append(a["out"], a["at"]).alias("out")), lambda a: a["out"])

    def within(block: Column, start: Column) -> Column:
        first = F.struct(start.alias("at"), none.alias("out"))

        def step(a: Column, x: Column) -> Column:
            made = make(x, a["at"])
            return F.struct(add(a["at"], x, None).alias("at"), F.when(made.isNull(), a["out"]).otherwise(F.array_append(a["out"], made)).cast(out_type).alias("out"))

        return F.aggregate(block, first, step, lambda a: a["out"])

    parts = _let(items, lambda x: F.when(F.size(x) > 0, _let(cut(x), lambda blocks: F.flatten(F.zip_with(blocks, starts(blocks), within)))))
    return F.coalesce(parts, none)


def _located(text: Column, pattern: str, kind: str, fits) -> Column:
    """Spans of the matches for which ``fits`` holds."""
    pairs = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        F.split(text, pattern, -1),
        lambda v, g: F.struct(v.alias("v"), F.char_length(g).cast("bigint").alias("gap"), F.char_length(v).cast("bigint").alias("n")),
    )

    def span(x: Column, at: Column) -> Column:
        start = at + x["gap"]
        one = F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + x["n"]).alias("end"), x["v"].alias("value"))
        return F.when(x["v"].isNotNull() & fits(x["v"]), one)

    def add(a: Column, x: Column | None, more: Column | None) -> Column:
        return a + (more if x is None else x["gap"] + F.coalesce(x["n"], F.lit(0).cast("bigint")))

    return _scan(pairs, F.lit(0).cast("bigint"), add, span, _SPAN)


def _free(base: Column, places: Column) -> Column:
    """The ``places`` that overlap no span of ``base``.

    One after the other by start, a place must begin at or behind the largest end of the base spans before it; from the
    other side, it must end at or before the next base span's start. A place is made of letters and never holds one.
    """
    tagged = F.concat(F.transform(base, lambda s: F.struct(s["start"].alias("a"), F.lit(0).alias("k"), s.alias("s"))), F.transform(places, lambda s: F.struct(s["start"].alias("a"), F.lit(1).alias("k"), s.alias("s"))))
    kind = "array<struct<a:bigint,k:int,s:struct<kind:string,start:bigint,end:bigint,value:string>>>"
    far = F.lit(2**62).cast("bigint")

    def ends(a: Column, x: Column | None, more: Column | None) -> Column:
        return F.greatest(a, more if x is None else F.when(x["k"] == 0, x["s"]["end"]).otherwise(a))

    def starts(a: Column, x: Column | None, more: Column | None) -> Column:
        return F.least(a, more if x is None else F.when(x["k"] == 0, x["s"]["start"]).otherwise(a))

    behind = _scan(F.array_sort(tagged.cast(kind)), F.lit(0).cast("bigint"), ends, lambda x, at: F.when((x["k"] == 0) | (x["a"] >= at), x), kind)
    both = _scan(F.reverse(behind), far, starts, lambda x, at: F.when((x["k"] == 1) & (x["s"]["end"] <= at), x), kind)
    return F.transform(both, lambda x: x["s"])


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether every second digit from the right, doubled (less 9 above 9), and the others add up to a multiple of 10."""
    back = F.split(F.reverse(digits), "")
    values = F.transform(F.filter(back, lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def base_spans(text: Column) -> Column:
    """Spans of the base kinds by start, then kind."""
    none = F.array().cast(_SPAN)

    def when(maybe: Column, spans: Column) -> Column:
        return F.when(maybe, spans).otherwise(none)

    def card(v: Column) -> Column:
        n = F.length(_digits(v))
        return (n >= 12) & (n <= 19) & _luhn(_digits(v))

    def phone(v: Column) -> Column:
        n = F.length(_digits(v))
        return (n >= 9) & (n <= 15)

    found = F.concat(
        when(F.contains(text, F.lit("@")), _located(text, _EMAIL, "email", lambda v: F.lit(True))),
        when(text.rlike(r"[0-9]\.[0-9]"), _located(text, _IP, "ip", lambda v: v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))),
        when(text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), _located(text, _CARD, "card", card)),
        when(F.contains(text, F.lit("+")), _located(text, _PHONE, "phone", phone)),
    )
    return by_place(found)


def by_place(spans: Column) -> Column:
    """Sorted by start, then kind as listed in KINDS."""
    order = F.create_map(*(F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)))
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("a"), order[s["kind"]].alias("k"), s["end"].alias("b"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda x: x["s"])


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, t1, t2, base, entities, terms), written once; (t1, t2) is the text's key, terms only of texts with entities."""
    t1, t2 = text_keys(F.col("text"))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    first = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text")).select("id", t1.alias("t1"), t2.alias("t2"), "text", base_spans(F.col("text")).alias("base"))
    entities = F.array_distinct(F.transform("base", lambda s: F.concat(s["kind"], F.lit(":"), F.lower(s["value"]))))
    terms = F.when(F.size("base") > 0, _terms(F.col("text")))
    return staged(first.select("id", "t1", "t2", "base", entities.alias("entities"), terms.alias("terms")), "personal")


def _classes(held: DataFrame, word: str, facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Words that stand in the same texts and have the same ``df`` are one class (c1, c2, df).

    ``held``: (n, rows, word), ``facts``: (word, df). Returns (word, c1, c2, df), and (n, rows, c1, c2, df) of all texts.
    """
    sign = held.groupBy(word).agg(F.bit_xor(F.xxhash64("n")).alias("c1"), F.bit_xor(F.xxhash64(F.lit(1), "n")).alias("c2"))
    words = staged(sign.join(facts, word), f"{word}-classes")
    return words, held.join(words, word).select("n", "rows", "c1", "c2", "df").distinct()


def disclosive(docs: DataFrame, scanned: DataFrame, disclosure: float = DISCLOSURE, text_col: str = "text") -> DataFrame:
    """(term, pmi, ic) of the terms that give an entity away, for the entity to which they do so most; counts are over all documents."""
    total = F.lit(float(scanned.count()))
    # A row for each text, with the number of documents it is.
    held = scanned.where(F.size("base") > 0).groupBy("t1", "t2").agg(F.count("*").alias("rows"), F.first("entities").alias("entities"), F.first("terms").alias("terms"))
    held = staged(held.withColumn("n", F.monotonically_increasing_id()), "held")
    lone = held.select("n", "rows", F.explode("entities").alias("entity"))
    _, owned = _classes(lone, "entity", lone.groupBy("entity").agg(F.sum("rows").alias("df")))
    near = held.select("n", "rows", F.explode("terms").alias("term"))
    # Counted before they are compared: what is shuffled is a row for each word of a task.
    said = docs.select(F.explode(_terms(F.col(f"`{text_col}`"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    said = said.join(near.select("term").distinct(), "term", "left_semi")
    words, terms = _classes(near, "term", said)
    # n is df_e at most: PMI >= disclosure * IC needs df_t <= N^(1 - disclosure) * df_e^disclosure, which the entities of
    # a text bound before its terms and entities are paired.
    most = lambda df_e: F.pow(total, F.lit(1 - disclosure)) * F.pow(df_e, F.lit(disclosure)) * (1 + 1e-9)
    owned = staged(owned.select("n", "rows", F.struct("c1", "c2", "df").alias("e")), "entities")
    common = owned.groupBy("n").agg(F.max("e.df").alias("max_df"))
    rare = terms.join(common, "n").where(F.col("df") <= most(F.col("max_df"))).select("n", F.struct("c1", "c2", "df").alias("t"))
    pairs = rare.join(owned, "n").where(F.col("t.df") <= most(F.col("e.df")))
    j = pairs.groupBy("t", "e").agg(F.sum("rows").alias("both"))
    ic = F.log2(total / F.col("e.df"))
    pmi = F.log2(total * F.col("both") / (F.col("t.df") * F.col("e.df")))
    j = j.select("t.c1", "t.c2", "t.df", pmi.alias("pmi"), ic.alias("ic")).where((F.col("ic") > 0) & (F.col("pmi") >= disclosure * F.col("ic") - 1e-9))
    best = j.groupBy("c1", "c2", "df").agg(F.max(F.struct("pmi", "ic")).alias("x"))
    return words.join(best, ["c1", "c2", "df"]).select("term", "x.pmi", "x.ic")


def _among(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """The ``rows`` whose ``term`` is one of ``terms``; few others are shuffled."""
    key = F.xxhash64("term").alias("key")
    return maybe_members(rows.select("*", key), "key", terms.select(key)).drop("key").join(terms, "term", "left_semi")


def personal_data(docs: DataFrame, disclosure: float = DISCLOSURE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, t1, t2, spans ARRAY<STRUCT<kind, start, end, value>>): a row for each row of ``docs``; (t1, t2) is the text's key."""
    scanned = scan(docs, id_col, text_col)
    telling = staged(disclosive(docs, scanned, disclosure, text_col).select("term"), "disclosive")
    t1, t2 = text_keys(F.col(f"`{text_col}`"))
    texts = docs.select(t1.alias("t1"), t2.alias("t2"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    said = _among(texts.select("t1", "t2", F.explode(_terms(F.col("text"))).alias("term")), telling)
    said = staged(said.select("t1", "t2").distinct(), "telling-texts")
    place = texts.join(said, ["t1", "t2"], "left_semi").dropDuplicates(["t1", "t2"])
    place = place.select("t1", "t2", F.explode(_located(F.col("text"), _TERM, "term", lambda v: F.lit(True))).alias("x"))
    place = _among(place.withColumn("term", F.lower("x.value")), telling).groupBy("t1", "t2").agg(F.collect_list("x").alias("places"))
    both = scanned.join(place, ["t1", "t2"], "left")
    spans = F.when(F.col("places").isNull(), F.col("base")).otherwise(by_place(F.concat("base", _free(F.col("base"), F.col("places")).cast(_SPAN))))
    return both.select(F.col("id").alias(id_col), "t1", "t2", spans.alias("spans"))


#: Code points of the pieces in which a text is cut up.
_CHUNK = 256


def sanitised(text: Column, spans: Column, drop_terms: bool = False) -> Column:
    """``text`` with each span replaced by its kind in brackets (terms dropped, if asked); overlapping spans become one."""

    def cut(chunks: Column, a: Column, b: Column) -> Column:
        """Code points a to b, from the chunks that hold them."""
        first = F.floor(a / _CHUNK).cast("int")
        own = F.array_join(F.slice(chunks, first + 1, F.floor(b / _CHUNK).cast("int") - first + 1), "")
        return F.substring(own, (a - first * _CHUNK + 1).cast("int"), (b - a).cast("int"))

    def mark(s: Column) -> Column:
        one = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.when(s["kind"] == "term", F.lit("")).otherwise(one) if drop_terms else one

    def end(a: Column, x: Column | None, more: Column | None) -> Column:
        return F.greatest(a, more if x is None else x["end"])

    def whole(chunks: Column) -> Column:
        parts = _scan(spans, F.lit(0).cast("bigint"), end, lambda s, at: F.when(s["start"] >= at, F.concat(cut(chunks, at, s["start"]), mark(s))), "array<string>")
        last = F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, s: F.greatest(a, s["end"]))
        return F.concat(F.array_join(parts, ""), cut(chunks, last, F.char_length(text).cast("bigint")))

    return _let(F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{_CHUNK}}}"), F.lit(0)), whole)


def sanitise(docs: DataFrame, drop_terms: bool = False, disclosure: float = DISCLOSURE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text): null text stays null. Repeated rows return once each."""
    spans = personal_data(docs, disclosure, id_col, text_col).select("t1", "t2", "spans").dropDuplicates(["t1", "t2"])
    t1, t2 = text_keys(F.col(f"`{text_col}`"))
    light = docs.select(F.col(f"`{id_col}`").alias("id"), t1.alias("t1"), t2.alias("t2"), F.col(f"`{text_col}`").alias("text"))
    j = light.join(spans, ["t1", "t2"])
    return j.select(F.col("id").alias(id_col), F.when(F.col("text").isNotNull(), sanitised(F.col("text"), F.col("spans"), drop_terms)).alias(text_col))


def digest(spans: Column, kinds: tuple[str, ...]) -> Column:
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
