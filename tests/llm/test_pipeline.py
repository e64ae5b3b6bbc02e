import random
from collections import Counter, defaultdict

import brute
import corpus_pipeline as cp
import numpy as np
import pytest

from tidemark.llm import language_id, mixing, simhash
from tidemark.llm.common import staged, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in cp.STAGES:
        docs = staged(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def shingles(text, n=5):
    w = brute.lower_ascii(text).split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))}


def test_columns(spark, kept):
    names = table(spark, SF, "documents").columns
    assert all(df.columns == names for df in kept[:-1])


def test_language_stage(spark, kept):
    before, after = texts(table(spark, SF, "documents")), texts(kept[0])
    profiles = language_id.Profiles(language_id.learn(table(spark, SF, "documents")))
    for d, t in before.items():
        name, score = profiles.nearest(t)
        assert (d in after) == (name != "und" and score >= 0.05)
    assert len(after) >= 0.97 * len(before)


def test_language_stage_rejects(spark):
    """Noise and languages that were not learned go; short clean texts, and all documents there were, stay."""
    rng = random.Random(5)
    noise = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(60)) for _ in range(5)]
    noise += [rng.randbytes(300).hex() for _ in range(5)]
    noise += ["Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
              "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto."]
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    short = [(r["text"][:60], r["lang"]) for r in docs.where("length(text) > 2000").orderBy("doc_id").limit(20).collect()]
    more = [(10**6 + i, t, None) for i, t in enumerate(noise)] + [(2 * 10**6 + i, t, None) for i, (t, _) in enumerate(short)]
    got = {r["doc_id"] for r in cp.language(spark, docs.union(spark.createDataFrame(more, docs.schema)), SF).select("doc_id").collect()}
    assert not any(10**6 <= d < 2 * 10**6 for d in got) and sum(d >= 2 * 10**6 for d in got) == 20
    assert sum(d < 10**6 for d in got) == docs.count()


@pytest.mark.parametrize("tally", [language_id.TALLY, 500])
def test_language_fitted_on_all(spark, tally):
    """Profiles and least scores of languages of 7,000 texts are those of all of them, not of some."""
    rng, rows = random.Random(3), []
    for lang, letters in (("aa", "abcdefghij"), ("bb", "hijklmnopq")):
        rows += [(lang, " ".join("".join(rng.choices(letters, k=rng.randint(1, 5))) for _ in range(rng.randint(1, 6)))) for _ in range(7000)]
    docs = spark.createDataFrame([(i, t, n) for i, (n, t) in enumerate(rows)] + [(None, None, "aa"), (-1, "abc", None)], "doc_id bigint, text string, lang string")
    profiles = language_id.learn(docs, tally=tally)
    total = {"aa": Counter(), "bb": Counter()}
    for lang, text in rows:
        for code, n in zip(*language_id.ngrams(text)):
            total[lang][int(code)] += int(n)
    assert profiles == {lang: [c for c, _ in sorted(own.items(), key=lambda x: (-x[1], x[0]))[: language_id.PROFILE]] for lang, own in total.items()}
    table, scores = language_id.Profiles(profiles), defaultdict(list)
    for lang, text in rows:
        name, score = table.nearest(text)
        scores[lang] += [score] * (name == lang)
    want = {lang: language_id.REJECT * float(np.percentile(s, 1)) for lang, s in scores.items()}
    assert language_id.least_scores(docs, profiles) == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("scores", [[0.5], [0.2, 0.9], [0.3] * 150 + [0.8], [0.1] + [0.7] * 100, [0.25] + [0.5] * 200])
def test_least_scores_of_few(spark, monkeypatch, scores):
    monkeypatch.setattr(language_id, "map_rows", lambda df, *a: spark.createDataFrame([("x", "x", s) for s in scores] + [("x", "y", 0.0)], "lang string, found string, score double"))
    docs = spark.createDataFrame([], "text string, lang string")
    assert language_id.least_scores(docs, {"x": [97]}) == pytest.approx({"x": language_id.REJECT * float(np.percentile(scores, 1))}, rel=1e-12)


def test_near_dedup_stage(kept):
    before, after = texts(kept[0]), texts(kept[1])
    sets, where = {d: shingles(t) for d, t in before.items()}, defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    shared = Counter()
    for ds in where.values():
        for i, a in enumerate(ds):
            for b in ds[:i]:
                shared[min(a, b), max(a, b)] += 1
    close = {p: n / len(sets[p[0]] | sets[p[1]]) for p, n in shared.items()}
    exact = [p for p, j in close.items() if before[p[0]].lower().split() == before[p[1]].lower().split()]
    assert all(not (a in after and b in after) for a, b in exact)
    near = [p for p, j in close.items() if j >= 0.8]
    assert near and not any(a in after and b in after for a, b in near)
    alike = {d for p in near for d in p}
    assert all(d in after for d in before if d not in alike)
    assert all(any(x in after for x in (d, *(y for p in close if d in p for y in p))) for d in before)


@pytest.mark.parametrize("unit_rows, unit_shingles", [(16, 1000), (simhash.UNIT_ROWS, simhash.UNIT_SHINGLES)])
def test_similar_groups_match_brute_force(spark, unit_rows, unit_shingles):
    """Similarities on both sides of 0.8, in groups below and above a unit's rows."""
    rng, rows = random.Random(7), [(0, None), (1, ""), (2, "one two"), (3, "one two")]
    for base in range(30):
        words = [f"b{base}w{i}" for i in range(150)]
        for change in (0, 1, 2, 3, 4, 5, 6)[: 2 + base % 6]:
            new = list(words)
            for at in rng.sample(range(150), change):
                new[at] = f"x{rng.random()}"
            rows.append((len(rows), " ".join(new)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["group"] for r in simhash.similar_groups(df, unit_rows=unit_rows, unit_shingles=unit_shingles).collect()}
    sets, up = [shingles(t or "") if t else set() for _, t in rows], list(range(len(rows)))

    def top(x):
        return x if up[x] == x else top(up[x])

    close = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            same = len(a & b)
            close += 0.7 <= same / max(1, len(a | b)) <= 0.9
            if a == b or same >= 0.8 * len(a | b):
                up[top(i)] = top(j)
    assert close > 50
    want = [[top(i) == top(j) for j in range(len(rows))] for i in range(len(rows))]
    assert [[got[i] == got[j] for j in range(len(rows))] for i in range(len(rows))] == want


def test_contiguous_edits_meet(spark):
    """Cut, appended, replaced and swapped passages at a similarity of 0.8 and little more; words from a common vocabulary."""
    rng, rows, pairs = random.Random(11), [], []
    for _ in range(40):
        w = [f"w{rng.randrange(3000)}" for _ in range(250)]
        new = [f"n{rng.random()}" for _ in range(54)]
        for other in (w, w[:205], w + new, w[:228] + new[:22], w[80:160] + w[:80] + w[160:]):
            rows.append((len(rows), " ".join(other)))
            a, b = shingles(" ".join(w)), shingles(rows[-1][1])
            if other is not w and len(a & b) >= 0.8 * len(a | b):
                pairs.append((len(rows) - 1 - (len(rows) - 1) % 5, len(rows) - 1))
    group = {r["doc_id"]: r["group"] for r in simhash.similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(pairs) >= 150 and all(group[a] == group[b] for a, b in pairs)
    assert len(set(group.values())) == 40


def test_similar_groups_of_nothing(spark):
    assert simhash.similar_groups(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_decontamination_stage(spark, kept):
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    before, after = texts(kept[1]), texts(kept[2])
    hit = {r[0] for r in brute.contamination(list(before.items()), items) if r[5]}
    assert hit and set(after) == set(before) - hit


def test_mixing_stage(kept):
    size = lambda t: len(brute.WORD.findall(t))
    before = [(r["source"], size(r["text"])) for r in kept[2].collect()]
    after = Counter((r["doc_id"], r["source"], size(r["text"])) for r in kept[3].collect())
    assert after and max(after.values()) <= 3
    total, got = Counter(), Counter()
    for s, n in before:
        total[s] += n
    for (_, s, n), k in after.items():
        got[s] += n * k
    names = sorted(total)
    longest = max(n for _, n in before)
    for s, t in zip(names, mixing.water_fill([total[s] for s in names], [(1, 2, 3)[i % 3] for i in range(len(names))])):
        assert abs(got[s] - t) <= longest + 20


def test_sharding_stage(kept):
    before = Counter((r["doc_id"], len(r["text"].encode()) + 1) for r in kept[3].collect())
    rows = kept[4].collect()
    assert Counter((r["doc_id"], r["size"]) for r in rows) == before
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_cases(spark, frame, tricky):
    docs = frame(tricky, lambda i: "en")
    names = docs.columns
    for rows in (docs, docs.limit(0)):
        for _, stage in cp.STAGES[:-1]:
            out = stage(spark, rows, SF)
            assert out.columns == names
            out.collect()
        cp.shard(spark, rows, SF).collect()
    one = simhash.keep_one(docs).collect()
    assert sum(r["text"] == "one" for r in one) == 1 and sum(not (r["text"] or "").strip() for r in one) == 1


def test_run(spark, sf):
    assert cp.run(spark, sf).columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
