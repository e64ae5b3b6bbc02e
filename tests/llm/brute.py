"""Plain versions of the operators, written from their contracts alone."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def fingerprint(text, k=4):
    words = WORD.findall(lower_ascii(text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(rows, distance=4):
    fps = [fingerprint(t) for _, t in rows]
    n = len(rows)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def contamination(docs, items, window=10):
    cls = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: cls.findall(lower_ascii(t or ""))
    wins = defaultdict(set)
    for key, t in items:
        w = words(t)
        if w:
            k = min(window, len(w))
            for i in range(len(w) - k + 1):
                wins[tuple(w[i : i + k])].add(key)
    sizes = {len(w) for w in wins}
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if (own := wins.get(tuple(w[i : i + k]))) is not None:
                    hit.update(range(i, i + k))
                    found |= own
        ids = sorted(str(x) for x in found if x is not None)
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def near(docs, items, most=5, span=30):
    """(id, items whose rarest words all stand within so many words)."""
    cls = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = [(d, cls.findall(lower_ascii(t or ""))) for d, t in docs]
    count = defaultdict(int)
    for _, w in words:
        for x in w:
            count[x] += 1
    wanted = [(k, set(sorted(set(cls.findall(lower_ascii(t or ""))), key=lambda x: (count[x], x))[:most])) for k, t in items]
    out = []
    for d, w in words:
        own = {k for k, ts in wanted if ts and any(w[p] in ts and ts <= set(w[p : p + span]) for p in range(len(w)))}
        out.append((d, len(own)))
    return out


def repeated(rows, least=400, passages=False):
    """``passages``: with the bytes that repeated strings of 51 whole words cover, too."""
    seen = defaultdict(list)
    data = [(t or "").encode() for _, t in rows]
    for i, b in enumerate(data):
        for p in range(len(b) - least + 1):
            seen[hashlib.blake2b(b[p : p + least], digest_size=16).digest()].append((i, p))
    gone = [np.zeros(len(b), bool) for b in data]
    for at in seen.values():
        if len(at) > 1:
            for i, p in at:
                gone[i][p : p + least] = True
    out = []
    if passages:
        words, again = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", b)] for b in data], defaultdict(list)
        for i, w in enumerate(words):
            for (s, _), (_, e) in zip(w, w[50:]):
                again[data[i][s:e]].append((i, s, e))
        both = [g.copy() for g in gone]
        for at in again.values():
            for i, s, e in at if len(at) > 1 else ():
                both[i][s:e] = True
        return sorted(((d, int(g.sum()), int(x.sum())) for (d, _), g, x in zip(rows, gone, both)), key=str)
    for (d, _), b, g in zip(rows, data, gone):
        edges = np.diff(np.concatenate(([0], g.astype(np.int8), [0])))
        kept = np.frombuffer(b, np.uint8)[~g].tobytes() if b else b""
        out.append((d, len(b), int(g.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def top(vectors, k=20, every=20):
    fine = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, x) in enumerate(fine):
        if q % every == 0:
            scored = sorted((-sum(p * r for p, r in zip(x, y)), c) for b, (c, y) in enumerate(fine) if b != a)[:k]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored)]
    return sorted(out)


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def base_secrets(text):
    text = text or ""
    kinds = {
        "assign": (re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 12),
        "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
        "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
    }
    return _spans(text, kinds)


def _spans(text, kinds):
    order = list(kinds)
    found = [(k, m.start(), m.end()) for k, (p, ok) in kinds.items() for m in p.finditer(text) if ok(m)]
    return sorted(found, key=lambda s: (s[1], order.index(s[0])))


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def base_pii(text):
    num = lambda s: re.sub("[^0-9]", "", s)
    kinds = {
        "email": (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
        "ip": (re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(x) <= 255 for x in m[0].split("."))),
        "card": (re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 12 <= len(num(m[0])) <= 19 and luhn(num(m[0]))),
        "phone": (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 9 <= len(num(m[0])) <= 15),
    }
    return _spans(text or "", kinds)


def crc(text):
    return zlib.crc32((text or "").encode())


def terms(rows, disclosure=0.8):
    """Spans of words that give an entity away, by counts over all documents."""
    word = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]{4,}")
    base = [base_pii(t) for _, t in rows]
    said = [set(word.findall((t or "").lower())) for _, t in rows]
    held = [{f"{k}:{(t or '')[a:b].lower()}" for k, a, b in own} for (_, t), own in zip(rows, base)]
    df_t, df_e, both = defaultdict(int), defaultdict(int), defaultdict(int)
    for ts, es in zip(said, held):
        for t in ts:
            df_t[t] += 1
        for e in es:
            df_e[e] += 1
            for t in ts:
                both[t, e] += 1
    telling = set()
    for (t, e), n in both.items():
        ic = math.log2(len(rows) / df_e[e])
        if ic > 0 and math.log2(len(rows) * n / (df_t[t] * df_e[e])) >= disclosure * ic - 1e-9:
            telling.add(t)
    out = []
    for (d, t), own in zip(rows, base):
        found = [m.span() for m in word.finditer(t or "") if m[0].lower() in telling]
        out.append((d, [("term", a, b) for a, b in found if not any(a < y and x < b for _, x, y in own)]))
    return out


def language(labelled, rows, size=300):
    """(id, language, score) by rank-order profiles."""

    def grams(text):
        t = re.sub(r"[\W\d_]+", " ", (text or "").lower()).strip()
        if not any(c.isalpha() for c in t):
            return {}
        t = f" {t} "
        count = defaultdict(int)
        for n in (1, 2, 3):
            for i in range(len(t) - n + 1):
                if t[i : i + n] != " ":
                    count[t[i : i + n]] += 1
        return count

    def ranks(count):
        code = lambda g: sum(ord(c) << 21 * i for i, c in enumerate(reversed(g)))
        return {g: i for i, g in enumerate(sorted(count, key=lambda g: (-count[g], code(g)))[:size])}

    total = defaultdict(lambda: defaultdict(int))
    for text, lang in labelled:
        if text is not None and lang is not None:
            for g, n in grams(text).items():
                total[lang][g] += n
    profiles = {k: ranks(v) for k, v in sorted(total.items())}
    out = []
    for d, text in rows:
        own = ranks(grams(text))
        if not own or not profiles:
            out.append((d, "und", 0.0))
            continue
        far = {k: sum(abs(p[g] - i) if g in p else size for g, i in own.items()) for k, p in profiles.items()}
        best = min(far, key=lambda k: (far[k], k))
        out.append((d, best, 1 - far[best] / (size * len(own))))
    return out


def feistel(x, n, key, rounds=6):
    """Slot of number x among n, in plain integers."""
    top = 2**64 - 1

    def mix(v):
        v = (v ^ v >> 30) * 0xBF58476D1CE4E5B9 & top
        v = (v ^ v >> 27) * 0x94D049BB133111EB & top
        return v ^ v >> 31

    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = x >> half, x & mask
        for r in range(1, rounds + 1):
            left, right = right, left ^ mix(right ^ mix((r * 0x9E3779B97F4A7C15 & top) ^ key)) & mask
        x = left << half | right
        if x < n:
            return x


def mix(rows, quotas, begin, block_words):
    """Words of each document in each shard: ``rows`` (id, size) of a source in order, its ``quotas``, and its first block."""
    words = [i for i, (_, size) in enumerate(rows) for _ in range(size)]
    blocks = [words[i : i + block_words] for i in range(0, len(words), block_words)]
    out, seat = [[0] * len(quotas) for _ in rows], 0
    for shard, q in enumerate(quotas):
        for _ in range(q):
            for i in blocks[(begin + seat) % len(blocks)]:
                out[i][shard] += 1
            seat += 1
    return [(d, size, own) for (d, size), own in zip(rows, out)]


def fill(sizes, weights, cap=3):
    """Targets by weight, the excess over ``cap`` times the size shared out again and again."""
    target = [0.0] * len(sizes)
    shut: set = set()
    while True:
        left = sum(sizes) - sum(cap * sizes[i] for i in shut)
        open_ = [i for i in range(len(sizes)) if i not in shut]
        for i in range(len(sizes)):
            target[i] = cap * sizes[i] if i in shut else left * weights[i] / sum(weights[j] for j in open_)
        over = {i for i in open_ if target[i] > cap * sizes[i]}
        if not over:
            return target
        shut |= over
