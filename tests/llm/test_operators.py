import hashlib
import os
import random
import time
from collections import Counter, defaultdict
from fractions import Fraction

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontamination, language_id, mixing, pii, queries, secrets, sharding, simhash, substring_dedup, topk, training_order
from tidemark.llm.common import table


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def docs_of(spark, sf):
    return [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]


def as_query(monkeypatch, df, name, spark, other=None):
    """The registered query over another table."""
    monkeypatch.setattr(queries, "table", lambda s, d, t: df if t in ("documents", "embeddings") or other is None else other)
    return queries.QUERIES[name](spark, "")


# SimHash


def test_simhash_whole_table(spark, sf):
    got = rows_of(queries.op10_simhash(spark, sf), "doc_id", "fingerprint", "component_id")
    assert got == brute.simhash(docs_of(spark, sf))


def test_simhash_cases(spark, frame, tricky, monkeypatch):
    got = rows_of(as_query(monkeypatch, frame(tricky), "op10_simhash", spark), "doc_id", "fingerprint", "component_id")
    assert got == brute.simhash(tricky)
    assert as_query(monkeypatch, frame(tricky).limit(0), "op10_simhash", spark).count() == 0


@pytest.mark.parametrize("unit", [4, 4096])
def test_simhash_chains_and_hot_keys(spark, unit):
    rng = random.Random(5)
    fps = [0, 1, 3, 7, 15, 31, 63, 2**63, 2**64 - 1] + [rng.getrandbits(64) for _ in range(50)]
    fps += [fps[20] ^ (1 << a) ^ (1 << b) for a in range(0, 40, 3) for b in range(1, 64, 5)] + [fps[30] ^ 0b11111 << 10]
    fps = sorted(set(fps))
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp bigint")
    roots = {r["node"]: r["root"] for r in simhash.connected(simhash.links(df, 4, unit)).collect()}
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    groups, wanted = defaultdict(set), defaultdict(set)
    for f in fps:
        s = f - 2**64 if f >= 2**63 else f
        groups[roots.get(s, s)].add(s)
        wanted[find(f)].add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


# Decontamination


def test_decontamination_whole_table(spark, sf):
    items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    got = rows_of(queries.op6_decontamination(spark, sf), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == brute.contamination(docs_of(spark, sf), items)
    assert any(r[2] for r in got)


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_decontamination_cases(spark, frame, tricky, block):
    items = [(1, "one"), (1, "one"), (2, None), (3, "..."), (4, "word " * 30), (None, "quick brown"), (10, "The QUICK brown"), (6, "null id text"), (7, "é" * 500), (8, "die das und ist nicht ein eine mit von der die")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    out = decontamination.contamination(frame(tricky), bench, block_windows=block)
    assert Counter((r["doc_id"], r["n_near"]) for r in out.collect()) == Counter(brute.near(tricky, items))
    out = out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items").cast("binary"), 256), F.col("n_hit") > 0)
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute.contamination(tricky, items)
    assert decontamination.contamination(frame(tricky), bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    assert decontamination.contamination(frame(tricky).limit(0), bench).count() == 0


def test_decontamination_segments(spark, frame):
    """The same findings from an index of one document a segment; stored postings give the texts back."""
    items = [(1, "b c d"), (2, "d e"), (3, "f b c")]
    rows = [(i, " ".join("abcdef"[(i * j + j) % 6] for j in range(40))) for i in range(20)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = rows_of(decontamination.contamination(frame(rows), bench), "doc_id", "n_hit", "items", "spans", "near")
    assert rows_of(decontamination.contamination(frame(rows), bench, segment_bytes=1), "doc_id", "n_hit", "items", "spans", "near") == want
    for r in decontamination.build_index(frame(rows), segment_bytes=1).collect():
        words = {}
        at = 0
        for t, n in zip(r["terms"], r["counts"]):
            words.update(dict.fromkeys(r["positions"][at : at + n], bytes(t).decode()))
            at += n
        assert " ".join(words[i] for i in range(len(words))) == dict(rows)[r["ids"][0]]


def test_proximity(spark, frame):
    df = frame([(1, "a b c d e f"), (2, "f x a"), (3, None), (4, "a a f")])
    got = rows_of(decontamination.proximity(df, ["a f", "c"], 3), "doc_id", "phrase")
    assert got == [(1, 1), (2, 0), (4, 0)]


# Suffix dedup


def test_suffix_dedup_whole_table(spark, sf):
    got = rows_of(queries.op4_suffix_dedup(spark, sf), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute.repeated(docs_of(spark, sf))
    assert any(0 < r[2] < r[1] for r in got)
    assert rows_of(queries.op4_suffix_dedup(spark, sf), "doc_id", "n_removed", "n_passage") == brute.repeated(docs_of(spark, sf), passages=True)


def test_suffix_dedup_cases(spark, frame, tricky, monkeypatch):
    got = rows_of(as_query(monkeypatch, frame(tricky), "op4_suffix_dedup", spark), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute.repeated(tricky)
    assert as_query(monkeypatch, frame(tricky).limit(0), "op4_suffix_dedup", spark).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_dedup_edges(spark, frame, seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [text(n) for n in (350, 398, 400, 401, 420, 700, 2000)]
    rows = []
    for i in range(60):
        parts = [text(rng.randint(0, 600))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, 40)
            parts += [s[a:], text(rng.randint(0, 200))]
        rows.append((i, "".join(parts)))
    rows += [(100, "ab" * 600), (101, "x" + "ab" * 300 + "y"), (102, shared[6] + shared[6])]
    out = substring_dedup.deduplicate(frame(rows), with_text=True)
    got = rows_of(out, "doc_id", "n_bytes", "n_removed", F.size("spans"), "kept_sha256")
    assert got == brute.repeated(rows)
    for r in out.collect():
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]


@pytest.mark.parametrize("task_regions, group_rows", [(7, 20_000), (20_000, 20_000), (20_000, 20)])
def test_suffix_dedup_large_groups(spark, frame, task_regions, group_rows):
    """A passage that many documents share in different surroundings, and near copies of one document."""
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, model = text(470), text(1500)
    rows = [(i, text(rng.randint(0, 300)) + passage[rng.randint(0, 60) :][: rng.randint(380, 470)] + text(rng.randint(0, 300))) for i in range(130)]
    for i in range(130):
        at = rng.randint(0, 1499)
        rows.append((1000 + i, model[:at] + rng.choice("XYZ") + model[at + 1 :]))
    rows += [(2000 + i, text(rng.randint(0, 200)) + passage) for i in range(3)] + [(3000, text(900)), (3001, model)]
    got = rows_of(substring_dedup.deduplicate(frame(rows), task_regions=task_regions, group_rows=group_rows), "doc_id", "n_bytes", "n_removed", F.size("spans"), "kept_sha256")
    assert got == brute.repeated(rows)


@pytest.mark.parametrize("group_rows", [20_000, 5])
def test_suffix_dedup_passages(spark, frame, group_rows):
    """Passages of 45 to 90 words, most of them of fewer than 400 bytes, at starts, at ends and inside."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared, rows = [text(n) for n in (45, 50, 51, 52, 60, 70, 90)], []
    for i in range(80):
        parts = [text(rng.randint(0, 60))] * rng.randint(0, 1) + [rng.choice(shared)] + [text(rng.randint(0, 60))] * rng.randint(0, 1)
        rows.append((i, rng.choice([" ", "\n", "x"]).join(parts)))
    got = rows_of(substring_dedup.deduplicate(frame(rows), group_rows=group_rows), "doc_id", "n_removed", "n_passage")
    assert got == brute.repeated(rows, passages=True) and sum(0 < r[2] != r[1] for r in got) > 20


def test_suffix_dedup_segments(monkeypatch):
    """A text's regions do not depend on the segments in which they are looked for."""
    rng = random.Random(13)
    data = "".join(rng.choice("abc def gh  ") for _ in range(9000)).encode()
    whole = substring_dedup.regions(data)
    monkeypatch.setattr(substring_dedup, "SEGMENT", 700)
    assert substring_dedup.regions(data) == whole


def test_multikey_quicksort():
    rng = random.Random(14)
    for n in (0, 1, 30, 2000):
        keys = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40))) for _ in range(n)] + [b"a" * 100] * min(n, 40)
        order = substring_dedup.multikey_quicksort(keys)
        assert [keys[i] for i in order] == sorted(keys) and sorted(order) == list(range(len(keys)))


# Top-k


def test_topk_whole_table(spark, sf):
    vectors = [(r["vec_id"], r["embedding"]) for r in table(spark, sf, "embeddings").collect()]
    got = sorted(tuple(r) for r in queries.op7_topk(spark, sf).select("query_id", "rank", "vec_id", "score").collect())
    assert got == brute.top(vectors)


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_topk_cases(spark, block):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, [0.5]), (40, None), (60, [1.0, None]), (80, [nan, 1.0]), (100, [inf]), (None, [1.0, 1.0]), (1, [-1.0, 0.01]), (2, [0.0, 0.0]), (3, []), (120, [])]
    vectors += [(1000 + i, [float(i % 3), float(i % 2)]) for i in range(60)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors], "vec_id bigint, embedding array<float>, row string, id int")
    ask = lambda i: F.pmod(i, F.lit(20)) == 0
    got = sorted(tuple(r) for r in topk.top_k(df, ask, block_bytes=block, range_rows=4).collect())
    assert got == brute.top(vectors)
    assert topk.top_k(df.limit(0), ask).count() == 0


def test_topk_large_components(spark):
    vectors = [(i, [float(2.0**24 + i), float(i)]) for i in range(45)]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    assert sorted(tuple(r) for r in topk.top_k(df, lambda i: F.pmod(i, F.lit(20)) == 0).collect()) == brute.top(vectors)


def test_topk_prunes():
    """Of rows in clusters few blocks are scored; the result is that of all rows."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 32)) * 64
    vectors = np.floor(np.repeat(centres, 64, axis=0) + rng.normal(size=(40 * 64, 32)) * 4)
    rows = np.arange(len(vectors))
    best, scored, total = topk.search(vectors[::20], rows[::20], np.full(len(rows[::20]), -np.inf), 20, 64, rows, rows, vectors)
    assert scored < 0.25 * total
    for q in range(0, 128, 7):
        score = vectors @ vectors[20 * q]
        want = sorted((-s, i) for i, s in enumerate(score.tolist()) if i != 20 * q)[:20]
        own = best.q == q
        assert sorted((-s, i) for s, i in zip(best.s[own].tolist(), best.i[own].tolist())) == want


# Secrets


def test_secrets_base_spans(spark, sf):
    got = queries.op3_secrets(spark, sf).collect()
    want = {d: brute.base_secrets(t) for d, t in docs_of(spark, sf)}
    assert len(got) == len(want) and any(want.values())
    for r in got:
        spans = want[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(brute.joined(spans).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]
        assert [s for s in r["spans"].split(",") if s and not s.startswith("lit")] == [s for s in brute.joined(spans).split(",") if s]


def test_secrets_cases(spark, frame, tricky, monkeypatch):
    got = as_query(monkeypatch, frame(tricky), "op3_secrets", spark).collect()
    want = Counter((d, hashlib.sha256(brute.joined(brute.base_secrets(t)).encode()).hexdigest()) for d, t in tricky)
    assert Counter((r["doc_id"], r["base_sha256"]) for r in got) == want
    assert as_query(monkeypatch, frame(tricky).limit(0), "op3_secrets", spark).count() == 0


def test_secrets_lexer():
    def literals(text):
        return [text[a:b] for k, a, b, *_ in secrets.spans_of(text) if k == "lit"]

    assert literals('k = "Zx9!kQ2#pL7v"\napiSecret = k') == ["Zx9!kQ2#pL7v"]
    assert literals('db_password: "s3cr3t-Value-99" + "tail-Part-77"') == ["s3cr3t-Value-99", "tail-Part-77"]
    assert literals('user = "someone-else-here"; password = "changeme123"; token = ${TOKEN_VALUE}') == []
    assert literals('{"clientSecret": "q8Zr!x72Lm,p"}') == ["q8Zr!x72Lm,p"]
    assert literals("export ACCESS_KEY=Zx9kQ2pL7vbn") == ["Zx9kQ2pL7vbn"]
    assert literals("a" * 5000 + "=" * 5000 + '"' * 333) == []
    assert literals('password: str = "Hx7-kk2-Pq9"; const apiToken: string = \'zR4_vv8_Lm1\'') == ["Hx7-kk2-Pq9", "zR4_vv8_Lm1"]
    assert literals('os.environ["DB_PASSWORD"] = "Hx7-kk2-Pq9"') == ["Hx7-kk2-Pq9"]
    assert literals('secret = """line-1-Qz\nline-2-Xw"""') == ["line-1-Qz\nline-2-Xw"]
    assert literals('a = "Zx9"\nb = "kQ2"\ntoken = a + b + "pL7"\nplain = a') == ["Zx9", "kQ2", "pL7"]
    assert literals('token = ("Zx9kQ"\n         "2pL7v")') == ["Zx9kQ", "2pL7v"]
    assert literals("<db><password>Hx7kk2Pq9z</password><user>Hx7kk2Pq9y</user></db>") == ["Hx7kk2Pq9z"]
    assert literals('client.setPassword("Hx7-kk2-Pq9")') == ["Hx7-kk2-Pq9"]
    assert literals("url: https://host/x?token=Hx7kk2Pq9z&user=someone-else") == ["Hx7kk2Pq9z"]
    assert literals('token = fetch_token(); password = settings.password; secret = "the-example-Hx7kk2"') == ["the-example-Hx7kk2"]
    assert literals("api_key = Hx7kk2Pq9z4=\nx = 1") == ["Hx7kk2Pq9z4="]
    assert secrets.redact('x password = "abcd1234efgh5678"', secrets.spans_of('x password = "abcd1234efgh5678"')) == 'x [ASSIGN]"'


PIECES = ["a:a ", "s = s + s\n", "token=", "password = " + "'" * 3, "<token>x", 'a["b"]=', "a=b?c=d&", 'token = "ab" +\n', "a=`", "key=(", "'\"a="]


@pytest.mark.parametrize("piece, size", [("a=", 5_000_000), ('s = s + "x"\n', 5_000_000), *((p, 500_000) for p in PIECES)])
def test_secrets_linear(piece, size):
    """Long texts that are dense in signs; a few seconds a 5 MB, where the square would take hours."""
    text = piece * (size // len(piece))
    began = time.time()
    secrets.spans_of(text)
    assert time.time() - began < 30 * size / 5_000_000 + 2


# PII


def test_pii_base_spans(spark, sf):
    got = queries.op8_pii(spark, sf).collect()
    want = {d: brute.base_pii(t) for d, t in docs_of(spark, sf)}
    assert len(got) == len(want) and any(want.values())
    for r in got:
        spans = want[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(brute.joined(spans).encode()).hexdigest(), (r, spans)
        assert [s for s in r["spans"].split(",") if s and not s.startswith("term")] == [s for s in brute.joined(spans).split(",") if s]


def test_pii_cases(spark, frame, tricky, monkeypatch):
    got = as_query(monkeypatch, frame(tricky), "op8_pii", spark).collect()
    want = Counter((d, hashlib.sha256(brute.joined(brute.base_pii(t)).encode()).hexdigest()) for d, t in tricky)
    assert Counter((r["doc_id"], r["base_sha256"]) for r in got) == want
    for r in got:
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [r["spans"].count(k) for k in ("email", "ip", "card", "phone")]
    assert as_query(monkeypatch, frame(tricky).limit(0), "op8_pii", spark).count() == 0


def test_pii_disclosive_terms(spark, frame):
    rows = [(i, f"note {i} about surgeon Zygmunt reached at zyg@clinic.example.org today") for i in range(5)]
    rows += [(10 + i, f"note {i} about nothing special today here {i}") for i in range(40)]
    spans = {r["doc_id"]: [s["value"] for s in r["spans"] if s["kind"] == "term"] for r in pii.personal_data(frame(rows)).collect()}
    assert spans[0] == ["surgeon", "Zygmunt", "reached"] and spans[10] == []
    text = {r["doc_id"]: r["text"] for r in pii.sanitise(frame(rows)).collect()}
    assert text[1] == "note 1 about [TERM] [TERM] [TERM] at [EMAIL] today" and text[11] == rows[6][1]


def test_pii_terms_match_brute_force(spark, sf, frame, tricky, monkeypatch):
    docs = docs_of(spark, sf)
    got = {r["doc_id"]: [x for x in r["spans"].split(",") if x.startswith("term")] for r in queries.op8_pii(spark, sf).collect()}
    assert got == {d: [f"{k}:{a}:{b}" for k, a, b in own] for d, own in brute.terms(docs)} and any(got.values())
    got = as_query(monkeypatch, frame(tricky), "op8_pii", spark).collect()
    found = Counter((r["doc_id"], ",".join(x for x in r["spans"].split(",") if x.startswith("term"))) for r in got)
    assert found == Counter((d, ",".join(f"{k}:{a}:{b}" for k, a, b in own)) for d, own in brute.terms(tricky))


def test_pii_dense_text(spark):
    """50,000 entities in one text: spans, terms and the sanitised text in time that does not grow with their square."""
    text = " ".join(f"u{i}@h{i % 97}.example.org +49 30 {1_000_000 + i} word{i}é" for i in range(50_000))
    df = spark.createDataFrame([(1, text), (2, "x y"), (3, None)], "doc_id bigint, text string")
    began = time.time()
    spans = {r["doc_id"]: r["spans"] for r in pii.personal_data(df).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in spans[1] if s["kind"] != "term"] == brute.base_pii(text) and spans[2] == spans[3] == []
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert clean[1].count("[EMAIL] [PHONE] ") == 50_000 and clean[2] == "x y" and clean[3] is None
    assert time.time() - began < 240


def test_pii_term_pattern(spark, sf):
    """The pattern of terms takes the same code points as its definition, and little longer than a plain one in tasks side by side."""
    every = [" ".join(f"{chr(c) * 4}{chr(c)}b c{chr(c)}" for c in range(at, min(at + 4096, 0x110000)) if not 0xD800 <= c < 0xE000) for at in range(0, 0x110000, 4096)]
    found = lambda p: F.regexp_extract_all("t", F.lit(p), F.lit(0))
    both = spark.createDataFrame([(t,) for t in every], "t string").select(found(pii._TERM).alias("a"), found(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]{4,}").alias("b")).collect()
    assert all(r["a"] == r["b"] for r in both) and sum(len(r["a"]) for r in both) > 10**6
    words = table(spark, sf, "documents").select(F.col("text").alias("t")).crossJoin(spark.range(10)).repartition(4).cache()

    def seconds(pattern):
        def once():
            start = time.perf_counter()
            words.select(F.sum(F.size(found(pattern)))).collect()
            return time.perf_counter() - start

        return min(once() for _ in range(3))

    words.count()
    assert seconds(pii._TERM) < 4 * seconds("[a-z]{4,}+")
    words.unpersist()


def test_pii_entity_of_one_text(spark, frame):
    rows = [(0, "note about surgeon Zygmunt reached at zyg@clinic.example.org today")]
    rows += [(10 + i, f"note {i} about nothing special reached today here {i}") for i in range(40)]
    spans = {r["doc_id"]: [s["value"] for s in r["spans"] if s["kind"] == "term"] for r in pii.personal_data(frame(rows)).collect()}
    assert spans[0] == ["surgeon", "Zygmunt"] and spans[10] == []


def test_pii_whole_texts(spark, frame):
    """A term far from the entity, said twice, and said in a document without it."""
    fill = "plain words that say little about anything " * 10
    rows = [(i, f"Zygmunt {fill} zygmunt {fill} zyg@clinic.example.org") for i in range(3)] + [(5, f"Zygmunt without address {fill}")]
    rows += [(10 + i, f"note {i} {fill} without address") for i in range(40)]
    spans = {r["doc_id"]: [s["value"] for s in r["spans"] if s["kind"] == "term"] for r in pii.personal_data(frame(rows)).collect()}
    assert spans[0] == ["Zygmunt", "zygmunt"] and spans[5] == ["Zygmunt"] and spans[10] == []


# Language ID


def test_language_id_held_out(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in table(spark, sf, "documents").select("doc_id", "lang").collect()}
    got = queries.op9_language_id(spark, sf).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(truth) and all((brute.crc(str(r["doc_id"])) % 4 == 2) == r["held_out"] and 0 <= r["score"] <= 1 for r in got)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_language_id_matches_brute_force(spark, sf):
    docs = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text", "lang").collect()]
    learnt = [(t, lang) for d, t, lang in docs if brute.crc(str(d)) % 4 != 2]
    want = {d: (lang, pytest.approx(score)) for d, lang, score in brute.language(learnt, [(d, t) for d, t, _ in docs])}
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in queries.op9_language_id(spark, sf).collect()} == want


def test_language_id_cases(spark, frame, tricky, monkeypatch):
    df = frame(tricky, lambda i: "de" if i == len(tricky) - 1 else None if i % 4 == 1 else "en")
    got = as_query(monkeypatch, df, "op9_language_id", spark).collect()
    assert len(got) == len(tricky)
    for r in got:
        assert r["lang_pred"] in ("en", "de", "und") and 0 <= r["score"] <= 1
    by_id = {r["doc_id"]: r["lang_pred"] for r in got}
    assert [by_id[i] for i in (1, 2, 3, 12)] == ["und"] * 4
    assert {r["lang_pred"] for r in as_query(monkeypatch, frame(tricky), "op9_language_id", spark).collect()} == {"und"}
    assert as_query(monkeypatch, df.limit(0), "op9_language_id", spark).count() == 0


# Mixing


def seats_by_quotients(targets, seats, most):
    got = [0] * len(targets)
    for _ in range(seats):
        live = [i for i in range(len(targets)) if targets[i] > 0 and got[i] < most[i]]
        if not live:
            break
        got[max(live, key=lambda i: (Fraction(targets[i]) / (2 * got[i] + 1), -i))] += 1
    return got


def test_sainte_lague():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 12)
        targets = [rng.choice([0, 1, 5, 5, 1000, rng.randint(1, 300)]) for _ in range(n)]
        most = [rng.choice([0, 3, 50, 10**6]) for _ in range(n)]
        seats = rng.randint(0, 300)
        assert mixing.sainte_lague(targets, seats, most) == seats_by_quotients(targets, seats, most)
    quotas = mixing.shard_quotas([53, 24, 23, 900], 1000, [600] * 4, 7)
    assert all(min(q) >= 0 for q in quotas) and [sum(q) for q in quotas] == [1000 * (i + 1) // 7 - 1000 * i // 7 for i in range(7)]


def check_mix(docs, got):
    names = sorted({s for _, _, s in docs}, key=lambda s: (s is None, s or ""))
    size = Counter()
    for _, t, s in docs:
        size[s] += len(brute.WORD.findall(t or ""))
    targets = mixing.water_fill([size[s] for s in names], [(1, 2, 3)[i % 3] for i in range(len(names))])
    assert sum(targets) == pytest.approx(sum(size.values()))
    taken = Counter()
    for r in got:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(targets[names.index(r["source"])])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in zip(names, targets):
        assert t <= 3 * size[s] + 1e-6 and abs(taken[s] - t) <= 4 * mixing.BLOCK_WORDS
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, len(brute.WORD.findall(t or ""))) for d, t, _ in docs)


def test_mixing(spark, sf, frame, tricky, monkeypatch):
    docs = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text", "source").collect()]
    got = queries.op2_mixing(spark, sf).collect()
    check_mix(docs, got)
    assert sorted(map(str, got)) == sorted(map(str, queries.op2_mixing(spark, sf).collect()))
    df = frame(tricky)
    check_mix([tuple(r) for r in df.select("doc_id", "text", "source").collect()], as_query(monkeypatch, df, "op2_mixing", spark).collect())
    assert as_query(monkeypatch, df.limit(0), "op2_mixing", spark).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(df, max_sources=1)


def test_mixing_matches_brute_force(spark, sf):
    """Targets, quotas by quotients, and every document's words in every shard; only the seeded order is taken from Spark."""
    docs = table(spark, sf, "documents")
    rows = docs.select("doc_id", "source", "text", F.xxhash64(F.lit(mixing.SEED), F.col("doc_id").cast("string")).alias("h")).collect()
    sources = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["h"], r["doc_id"])):
        sources[r["source"]].append((r["doc_id"], len(brute.WORD.findall(r["text"] or ""))))
    names = sorted(sources, key=lambda s: (s is None, s or ""))
    sizes = [sum(n for _, n in sources[s]) for s in names]
    got = queries.op2_mixing(spark, sf).collect()
    targets = [next(r["target"] for r in got if r["source"] == s) for s in names]  # to the last bit, for quotients of equal value
    assert targets == pytest.approx(brute.fill(sizes, [(1, 2, 3)[i % 3] for i in range(len(names))]))
    blocks = [-(-n // mixing.BLOCK_WORDS) for n in sizes]
    seats = int(sum(targets) / mixing.BLOCK_WORDS + 0.5)
    ends = [seats_by_quotients(targets, seats * (i + 1) // mixing.SHARDS, [3 * b for b in blocks]) for i in range(mixing.SHARDS)]
    want = {}
    for k, s in enumerate(names):
        quotas = [b - a for a, b in zip([0, *(e[k] for e in ends)], [e[k] for e in ends])]
        begin = (mixing.SEED * 2654435761 + k * 40503) % blocks[k]
        want.update({d: (n, quotas, own, sum(own)) for d, n, own in brute.mix(sources[s], quotas, begin, mixing.BLOCK_WORDS)})
    assert {r["doc_id"]: (r["size"], r["quotas"], r["words"], r["taken"]) for r in got} == want


# Sharding


def test_capacity_is_smallest():
    rng = random.Random(4)

    def shards_needed(sizes, cap):
        n, room = 1, cap
        for s in sizes:
            if s > room:
                n, room = n + 1, cap
            room -= s
        return n

    for _ in range(300):
        sizes = [rng.choice([1, 2, 7, rng.randint(1, 90)]) for _ in range(rng.randint(1, 40))]
        k = rng.randint(1, 16)
        cap = sharding.smallest_capacity(sizes, k)
        assert shards_needed(sizes, cap) <= k and (cap == max(sizes) or shards_needed(sizes, cap - 1) > k)
        cuts = [0, *sharding.contiguous_cuts(sizes, k), len(sizes)]
        assert len(cuts) == k + 1 and cuts == sorted(cuts) and max(sum(sizes[a:b]) for a, b in zip(cuts, cuts[1:])) <= cap


@pytest.mark.parametrize("bits", [1, 3, 16])
def test_capacity_of_groups(spark, bits):
    """Cells are split until the capacity is the smallest of the groups themselves, found here from all of them."""
    rng = random.Random(6)
    for shards in (3, 16):
        groups = {rng.getrandbits(64) - 2**63: rng.choice([1, 5, rng.randint(1, 400)]) for _ in range(700)}
        df = spark.createDataFrame([(h, n, 1) for h, n in groups.items()], "h bigint, size bigint, n bigint")
        cells = sharding.cells_of(df, shards, bits)
        sizes = [groups[h] for h in sorted(groups)]
        assert sum(c.size for c in cells) == sum(sizes) and all(a.high < b.low for a, b in zip(cells, cells[1:]))
        assert sharding.smallest_capacity([c.size for c in cells], shards) == sharding.smallest_capacity(sizes, shards)


def test_sharding_is_minimax(spark, sf):
    """The query's largest shard against the smallest capacity of all groups, in the order of their hash."""
    docs = table(spark, sf, "documents")
    rows = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), (F.octet_length(F.coalesce("text", F.lit(""))) + 1).alias("size")).collect()
    sizes = Counter()
    for r in rows:
        sizes[r["h"]] += r["size"]
    load = Counter()
    for r in queries.op5_sharding(spark, sf).collect():
        load[r["shard"]] += r["size"]
    assert max(load.values()) == sharding.smallest_capacity([sizes[h] for h in sorted(sizes)], 16)


def check_shards(docs, got):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((d, len((t or "").encode()) + 1, brute.crc(t)) for d, t in docs)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by = defaultdict(set)
    for r in got:
        by[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(len(s) == 1 for s in by.values())


def test_sharding(spark, frame, tricky, monkeypatch):
    sf = "/root/testdata/sf0.01"
    docs = docs_of(spark, sf)
    got = queries.op5_sharding(spark, sf).collect()
    check_shards(docs, got)
    load = Counter()
    for r in got:
        load[r["shard"]] += r["size"]
    assert len(load) == 16 and max(load.values()) <= 1.05 * sum(load.values()) / 16 and min(load.values()) >= 0.9 * sum(load.values()) / 16
    check_shards(tricky, as_query(monkeypatch, frame(tricky), "op5_sharding", spark).collect())
    assert as_query(monkeypatch, frame(tricky).limit(0), "op5_sharding", spark).count() == 0


def test_sharding_hot_group(spark, frame):
    rows = [(i, "same text") for i in range(500)] + [(1, "same text")] * 300 + [(1000 + i, f"text {i} " + "w" * (i % 50)) for i in range(1000)]
    got = sharding.shard(frame(rows)).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert len({r["shard"] for r in got if r["doc_id"] < 500}) == 1 and all(sorted(s) == list(range(len(s))) for s in slots.values())


# Training order


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(n):
    slots = training_order.permuted(np.arange(n), n)
    assert sorted(slots.tolist()) == list(range(n)) and (training_order.unpermuted(slots, n) == np.arange(n)).all()
    assert slots.tolist() == [brute.feistel(x, n, training_order.KEY) for x in range(n)]
    if n > 100:
        assert (slots != training_order.permuted(np.arange(n), n, 7)).any() and abs(np.corrcoef(slots, np.arange(n))[0, 1]) < 0.2


def test_training_order_round_trip(spark, frame, tricky, tmp_path):
    voc, length = queries.vocabulary(), 16
    out = training_order.training_order(frame(tricky), voc, queries.PATTERN, queries.END_OF_TEXT, length=length, shard_sequences=100)
    got = out.collect()
    assert sorted(r["slot"] for r in got) == list(range(len(got)))
    number = {(r["doc_id"], r["seq"]): int(training_order.unpermuted(np.array([r["slot"]]), len(got))[0]) for r in got if r["doc_id"] not in (None, 5)}
    assert all(n == number[d, 0] + k for (d, k), n in number.items())
    texts = defaultdict(list)
    encode = training_order.encoding(voc, queries.PATTERN)
    pieces = defaultdict(dict)
    for r in got:
        assert len(r["record"]) == 2 * length and r["shard"] == r["slot"] // 100 and r["byte_offset"] == r["slot"] % 100 * 2 * length
        if r["doc_id"] is not None and r["doc_id"] != 5:
            pieces[r["doc_id"]][r["seq"]] = np.frombuffer(r["record"], "<u2")[: r["n_tokens"]].tolist()
    for d, t in tricky:
        if d in pieces:
            ids = [x for k in sorted(pieces[d]) for x in pieces[d][k]]
            assert ids[-1] == queries.END_OF_TEXT and encode.decode(ids[:-1]) == (t or "")
            texts[d].append(t)
    manifest = training_order.write_shards(out, f"file://{tmp_path}").collect()
    where = {r["slot"]: r["record"] for r in got}
    for m in manifest:
        data = (tmp_path / f"shard-{m['shard']:08d}.bin").read_bytes()
        assert hashlib.sha256(data).hexdigest() == m["sha256"] and m["first_slot"] == m["shard"] * 100
        assert data == b"".join(where[m["first_slot"] + i] for i in range(m["records"]))
    assert sum(m["records"] for m in manifest) == len(got)
    empty = frame(tricky).limit(0)
    assert training_order.training_order(empty, voc, queries.PATTERN, queries.END_OF_TEXT).count() == 0


def test_clear(spark):
    from tidemark.llm import common

    kept = common.staged(spark.range(3), "some", 3)
    assert kept.count() == 3
    common.clear(spark)
    assert not os.path.exists(common.shared_dir(spark))
