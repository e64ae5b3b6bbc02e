"""Secret scan: fixed base patterns, and an assignment-aware lexer.

The lexer goes from assignment sign to assignment sign (``=``, ``:``, ``:=``, ``=>``, a call's bracket before a string),
reads the name before it (a string in the last subscript, too), further targets and types up to the value, and the
expression behind: quoted literals (on several lines, if the quotes allow it), bare ones, joined by ``+`` or standing side
by side, and names of earlier constants, whose literals are then taken over. Elements ``<name>literal</`` count as
assignments. An expression's literals score together, by how sensitive the name is and by how random the joined value
looks; those that reach ``threshold`` are spans of kind ``lit``.

Spans are code points, end exclusive. Time and memory grow in proportion to a text's length, however dense it is in
signs. Cases: null text is empty and has no spans; repeated rows return once each; a null id is kept; a literal assigned
to several names is one span with its best score; an unclosed quote ends its expression; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, type_of

KINDS = ("assign", "access", "hex", "lit")
THRESHOLD = 0.4
LEAST_LITERAL = 8
MOST_NAME = 128

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so shorter ones can be passed over

_SIGN = re.compile(r"""=>|:=|[:=]|\((?=["'])""")
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_$.-")
_PATH = r"[A-Za-z_$][\w$]*+(?:[.-][\w$]++)*+"
_NAME = re.compile(_PATH, re.A)
#: The string in the last subscript before a sign.
_SUBSCRIPT = re.compile(r"""\[[ \t]*["']?([\w$.-]+)["']?[ \t]*\]\Z""", re.A)
#: A further target, or a type, between a sign and the value: ``name: type = value``, ``a = b = value``.
_TARGET = re.compile(rf"""({_PATH})(?:\[[^\]\n]{{0,64}}\])?[ \t]*+(?:=>|:=|=(?!=)|:(?=[ \t"'`]))[ \t]*+""", re.A)
_BARE = re.compile(r"[^\s\"'`,;(){}<>\[\]]++")
_REFERENCE = re.compile(r"(?:[A-Za-z_$][A-Za-z_$]*+\.)*+[A-Za-z_$][A-Za-z_$]*+", re.A)
#: Name and value in the query part of a bare literal.
_QUERY = re.compile(r"[?&]([A-Za-z_][\w.-]*+)=([^?&=]++)", re.A)
_TAG = re.compile(rf"<({_PATH})>([^<>\n]++)</", re.A)
_QUOTED = {q: re.compile(rf"{q}((?:[^{q}\\\n]|\\[\s\S])*+){q}") for q in "\"'"} | {"`": re.compile(r"`((?:[^`\\]|\\[\s\S])*+)`")}
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_GAP = re.compile(r"[ \t]*+")
_SPACE = re.compile(r"\s*+")
_LINE = r"(?:\\?\r?\n[ \t]*+)?+"
_PLUS = re.compile(rf"[ \t]*+{_LINE}\+[ \t]*+{_LINE}")
_NEXT = re.compile(r"""[ \t]*+(?:\\\r?\n[ \t]*+)?+(?=["'])""")
_NEXT_INSIDE = re.compile(r"""\s*+(?=["'])""")

#: How sensitive a word of a name is.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 0.9, "token": 0.8, "credential": 0.8, "credentials": 0.8, "apikey": 0.9, "bearer": 0.7, "auth": 0.5}
#: Words that make a "key" sensitive.
KEY_WORDS = frozenset({"api", "access", "private", "secret", "signing", "encryption", "auth", "master", "service"})
#: Whole values that stand for a value which is filled in elsewhere.
PLACEHOLDER = re.compile(r"(?:change.?me|example|placeholder|todo|fixme|none|null|undefined)[\W\d_]*|your[ _-].*|.*[_-]here|x{4,}|\*{4,}|\.{3,}|<.*>|\$\{.*\}|\{\{.*\}\}|%\w+%|\$\w+", re.A | re.I | re.S)
#: Literals of an earlier constant that are joined with those of an expression that names it, if they are no longer.
INLINE = 64


@lru_cache(1 << 16)
def name_weight(name: str) -> float:
    words = [w.lower() for w in _WORDS.findall(name)]
    best = max((SENSITIVE.get(w, 0.0) for w in words), default=0.0)
    if "key" in words and KEY_WORDS & set(words):
        best = max(best, 0.9)
    return best


def literal_weight(value: str) -> float:
    """0 to 1 by entropy; 0 for short literals and placeholders."""
    if len(value) < LEAST_LITERAL or PLACEHOLDER.fullmatch(value):
        return 0.0
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())
    return min(1.0, bits / 3.5)


def _name_before(text: str, at: int) -> str:
    while at and text[at - 1] in " \t?!":
        at -= 1
    if at and text[at - 1] == "]":
        found = _SUBSCRIPT.search(text[max(0, at - MOST_NAME) : at])
        return found[1] if found else ""
    if at and text[at - 1] in "\"'":
        at -= 1
    end = at
    while at and end - at < MOST_NAME and text[at - 1] in _NAME_CHARS:
        at -= 1
    found = _NAME.search(text, at, end)
    return found[0] if found and found.end() == end else ""


class Value:
    """What an assignment's right side holds: spans of its own literals, and earlier values that it names."""

    __slots__ = ("names", "literals", "refs", "text")

    def __init__(self, names: list[str], literals: list[tuple[int, int]], refs: list[int], text: str) -> None:
        self.names, self.literals, self.refs, self.text = names, literals, refs, text


def lex(text: str) -> list[Value]:
    """The assignments in order; ``refs`` are numbers of earlier ones, so that a constant is never copied.

    Every character is read a bounded number of times: after an expression the lexer goes on behind it.
    """
    known: dict[str, int] = {}
    out: list[Value] = []
    unclosed: set[str] = set()

    def quoted(at: int) -> tuple[int, int, int] | None:
        """Start and end of the literal whose quotes open at ``at``, and where they are closed."""
        q = text[at]
        if q != "`" and text.startswith(q * 3, at):
            end = -1 if q in unclosed else text.find(q * 3, at + 3)
            if end >= 0:
                return at + 3, end, end + 3
            unclosed.add(q)
        found = _QUOTED[q].match(text, at)
        return (*found.span(1), found.end()) if found else None

    def add(names: list[str], literals: list[tuple[int, int]], refs: list[int]) -> None:
        parts = [out[r].text for r in refs if len(out[r].text) <= INLINE] + [text[a:b] for a, b in literals]
        out.append(Value(names, literals, refs, "".join(parts)))
        known.update(dict.fromkeys(names, len(out) - 1))

    past = 0
    for sign in _SIGN.finditer(text):
        if sign.start() < past or not (name := _name_before(text, sign.start())):
            continue
        names, at, target = [name], _GAP.match(text, sign.end()).end(), None
        while target_ := _TARGET.match(text, at):
            target = target_
            names.append(target[1])
            at = target.end()
        literals, refs, more, inside = [], [], True, at < len(text) and text[at] == "("
        if inside:
            at = _SPACE.match(text, at + 1).end()
        while more and at < len(text):
            if text[at] in "\"'`":
                span = quoted(at)
                if span is None:
                    break
                literals.append(span[:2])
                at = span[2]
            elif bare := _BARE.match(text, at):
                at, value = bare.end(), bare[0]
                if value[-1] == "+" and at < len(text) and text[at] in "\"'`":
                    at, value = at - 1, value[:-1]
                if value in known:
                    refs.append(known[value])
                elif value and value[0] != "=" and not _REFERENCE.fullmatch(value) and text[at : at + 1] != "(":
                    literals.append((bare.start(), at))
                    for pair in _QUERY.finditer(text, bare.start(), at):
                        add([pair[1]], [pair.span(2)], [])
            else:
                break
            joined = _PLUS.match(text, at) or (_NEXT_INSIDE if inside else _NEXT).match(text, at)
            more, at = bool(joined), joined.end() if joined else at
        if not literals and not refs and target and text[target.end() - 1] == "=":
            # The last target was a literal that ends with a sign.
            names.pop()
            literals.append((target.start(), target.end()))
        past = at
        if literals or refs:
            add(names, literals, refs)
    for tag in _TAG.finditer(text):
        add([tag[1]], [tag.span(2)], [])
    return out


def literals_of(text: str, threshold: float = THRESHOLD) -> list[tuple[int, int, str, float]]:
    """(start, end, name, score) of the literals that reach ``threshold``, each with its best score and the name it is from.

    The weight of a name goes to the values that its value names, from the last assignment to the first, once each.
    """
    values = lex(text)
    weight = [max((name_weight(n), n) for n in v.names) for v in values]
    score: list[tuple[float, str]] = [(0.0, "")] * len(values)
    best: dict[tuple[int, int], tuple[float, str]] = {}
    for i in range(len(values) - 1, -1, -1):
        v, (w, name) = values[i], weight[i]
        own = max(score[i], (w * literal_weight(v.text), name)) if w else score[i]
        for r in v.refs:
            weight[r] = max(weight[r], weight[i], key=lambda x: x[0])
            if len(values[r].text) <= INLINE:
                score[r] = max(score[r], own)
        for span in v.literals:
            if own[0] >= threshold and own > best.get(span, (0.0, "")):
                best[span] = own
    return [(a, b, name, w) for (a, b), (w, name) in best.items()]


def spans_of(text: str | None, threshold: float = THRESHOLD) -> list[tuple[str, int, int, str, float]]:
    """(kind, start, end, name, score) by start, then kind."""
    text = text or ""
    found = []
    low = text.lower()
    signs = "=" in text or ":" in text
    if signs and any(h in low for h in _ASSIGN_HINTS):
        found += [("assign", m.start(), m.end(), m[1], 1.0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), "", 1.0) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [("hex", m.start(), m.end(), "", 1.0) for m in _HEX.finditer(text)]
    if signs or "</" in text or '("' in text or "('" in text:
        found += [("lit", *x) for x in literals_of(text, threshold)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redact(text: str | None, spans: list[tuple]) -> str | None:
    """``text`` with every span replaced by the kind in brackets; overlapping spans become one."""
    if text is None:
        return None
    out, at = [], 0
    for kind, a, b, *_ in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def secrets(docs: DataFrame, threshold: float = THRESHOLD, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans ARRAY<STRUCT<kind, start, end, name, score>>[, redacted]): a row for each row of ``docs``."""
    schema = f"`{id_col}` {type_of(docs, id_col)}, spans array<struct<kind:string,start:bigint,end:bigint,name:string,score:double>>" + ", redacted string" * with_text

    def row(i, text):
        spans = spans_of(text, threshold)
        return [(i, spans, redact(text, spans))] if with_text else [(i, spans)]

    return map_rows(docs, [id_col, text_col], schema, row)


def digest(spans, kinds: tuple[str, ...]):
    """kind:start:end of the spans of these kinds, comma-joined."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
