"""Personal data: regular expressions propose spans, checksums confirm them, context words move the score.

Base kinds (leftmost, non-overlapping within a kind, failing matches dropped without a retry): ``email``, ``ip``
(four parts, each at most 255), ``card`` (12 to 19 digits that pass Luhn), ``phone`` (9 to 15 digits after ``+``).
Base spans always stay. Further kinds are added where they don't overlap a base span and their score is at least
``threshold``:

* ``iban`` - country, check digits and 11 to 30 characters that pass mod 97; score 0.7;
* ``ssn`` - three, two and four digits with hyphens, in the ranges that are given out; score 0.3;
* ``mac`` - six pairs of hexadecimal digits with colons or hyphens; score 0.6;
* ``key`` - provider-prefixed access keys; score 0.8.

Context words are whole words that lie within ``CONTEXT`` characters on either side. One of a kind's own words adds
0.4 to the score, one that speaks against the kind takes 0.4 away: an IBAN after "example" is dropped, an SSN after
"ssn" is found, and where both kinds of words stand nearby the score stays.

Defined cases: a null text counts as empty; a null id passes through; repeated rows each get their own result.
All positions are code points, ends are exclusive, and every scan is linear in the text's length.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import picked, rowwise, sliced

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "mac", "key")
KINDS = BASE + ADDED
CONTEXT = 40
THRESHOLD = 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A run of digits fails as a whole, so that only its beginning is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_MAC = re.compile(r"(?<![0-9A-Fa-f:-])[0-9A-Fa-f]{2}(?:([:-])[0-9A-Fa-f]{2})(?:\1[0-9A-Fa-f]{2}){4}(?![0-9A-Fa-f:-])")
_KEY = re.compile(r"(?<![A-Za-z0-9_])(?:AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,72}|sk_live_[A-Za-z0-9]{16,64})(?![A-Za-z0-9])")
#: Words near a span that speak for its kind, and words that speak against it.
FOR = {
    "iban": ("iban", "account", "konto", "compte", "cuenta", "bank"),
    "ssn": ("ssn", "social", "security"),
    "mac": ("mac", "ethernet", "device", "address"),
    "key": ("key", "token", "secret"),
}
_UNREAL = ("example", "sample", "dummy", "fake", "placeholder")
AGAINST = {
    "iban": _UNREAL,
    "ssn": (*_UNREAL, "order", "invoice", "serial", "part"),
    "mac": (*_UNREAL, "hash", "checksum", "fingerprint"),
    "key": _UNREAL,
}
SHIFT = 0.4
_SCORE = {"iban": 0.7, "ssn": 0.3, "mac": 0.6, "key": 0.8}
_CONTEXT = {
    kind: tuple(re.compile(rf"(?<![^\W\d_])(?:{'|'.join(words[kind])})(?![^\W\d_])", re.IGNORECASE) for words in (FOR, AGAINST)) for kind in FOR
}

Span = tuple[int, int, str, float]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    rest = 0
    for c in iban[4:] + iban[:4]:
        rest = (rest * 10 + ord(c) - 48) % 97 if c.isdigit() else (rest * 100 + ord(c) - 55) % 97
    return rest == 1


def _emails(text: str) -> list[tuple[int, int]]:
    """The local part can't hold an @, so each match is the run before an @ that a domain follows."""
    out, free = [], 0
    for m in _DOMAIN.finditer(text):
        at = s = m.start()
        while s > free and text[s - 1] in _LOCAL:
            s -= 1
        if s < at:
            out.append((s, free := m.end()))
    return out


def base_spans(text: str) -> list[Span]:
    """The spans of the base kinds, by start and then by kind."""
    out: list[Span] = []
    if "@" in text:
        out += [(s, e, "email", 1.0) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), "ip", 1.0))
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() and len(digits := m[0].replace(" ", "").replace("-", "")) in range(12, 20) and luhn(digits):
            out.append((m.start(), m.end(), "card", 1.0))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append((m.start(), m.end(), "phone", 1.0))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def nearby(pattern: re.Pattern, text: str, start: int, end: int) -> bool:
    """Whether a whole word of ``pattern`` lies within ``CONTEXT`` characters before or after a span."""
    for lo, hi in ((max(0, start - CONTEXT), start), (end, min(len(text), end + CONTEXT))):
        for m in pattern.finditer(text, lo, hi):
            if m.end() < hi or hi == len(text) or not text[hi].isalpha():
                return True
    return False


def score_of(kind: str, text: str, start: int, end: int) -> float:
    speaks_for, against = _CONTEXT[kind]
    shift = SHIFT * (nearby(speaks_for, text, start, end) - nearby(against, text, start, end))
    return round(min(1.0, max(0.0, _SCORE[kind] + shift)), 6)


def added_spans(text: str, base: list[Span], threshold: float = THRESHOLD) -> list[Span]:
    """Spans of further kinds that overlap neither a base span nor each other."""
    found: list[Span] = []
    for kind, pattern in (("iban", _IBAN), ("ssn", _SSN), ("mac", _MAC), ("key", _KEY)):
        for m in pattern.finditer(text):
            s, e = m.span()
            if kind == "iban":
                e = _iban_end(m[0], s)
                if not e:
                    continue
            score = score_of(kind, text, s, e)
            if score >= threshold:
                found.append((s, e, kind, score))
    if not found:
        return []
    out: list[Span] = []
    taken = sorted((s, e) for s, e, *_ in base)
    starts = [s for s, _ in taken]
    reach = list(accumulate((e for _, e in taken), max))  # the furthest end so far
    for x in sorted(found, key=lambda x: (x[0], -x[3], KINDS.index(x[2]))):
        k = bisect_left(starts, x[1])
        if (k and reach[k - 1] > x[0]) or (out and out[-1][1] > x[0]):
            continue
        out.append(x)
    return out


def _iban_end(match: str, start: int) -> int:
    """The end of the longest prefix at a group's end that passes mod 97, or 0."""
    end = len(match)
    while end > 14:
        bare = match[:end].replace(" ", "")
        if 15 <= len(bare) <= 34 and mod97(bare):
            return start + end
        cut = match.rfind(" ", 0, end)
        if cut < 0:
            return 0
        end = cut
    return 0


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k, _ in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]))))


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with each span, overlapping ones together, replaced by its kind in brackets."""
    out, at = [], 0
    for s, e, kind, _ in sorted(spans, key=lambda x: (x[0], -x[1])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


_SPAN = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def find_pii(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, with_redacted: bool = True
) -> DataFrame:
    """A row for each row of ``docs``: its id, ``base`` and ``added`` spans (start, end, kind, score) and, if asked for,
    ``redacted``, the text with all spans replaced."""
    rows = picked(docs, id=id_col, text=text_col)
    fields = [T.StructField(id_col, rows.schema["id"].dataType), T.StructField("base", T.ArrayType(_SPAN)), T.StructField("added", T.ArrayType(_SPAN))]
    if with_redacted:
        fields.append(T.StructField("redacted", T.StringType()))
    as_dicts = lambda spans: [{"start": s, "end": e, "kind": k, "score": x} for s, e, k, x in spans]

    def step(b):
        base, added, clean = [], [], []
        for t in b.column(1).to_pylist():
            t = t or ""
            one = base_spans(t)
            two = added_spans(t, one, threshold)
            base.append(as_dicts(one))
            added.append(as_dicts(two))
            if with_redacted:
                clean.append(redacted(t, one + two) if one or two else t)
        return {id_col: b.column(0), "base": base, "added": added, "redacted": clean}

    return rowwise(rows, T.StructType(fields), lambda: step)


def pii_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Counts and span digests of :func:`find_pii`, a row for each row of ``docs``."""
    found = find_pii(docs, id_col, text_col, threshold, with_redacted=False)
    order = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    line = lambda c: F.array_join(
        F.transform(
            F.array_sort(F.transform(c, lambda s: F.struct(s["start"].alias("start"), order(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
    return found.select(
        id_col,
        *(count(k).alias(f"n_{k}") for k in BASE),
        F.sha2(line(F.col("base")), 256).alias("base_sha256"),
        line(F.concat("base", "added")).alias("spans"),
    )


def redact(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, personal data in the text replaced by its kind; null stays null."""
    at = docs.columns.index(text_col)

    def clean(t):
        spans = base_spans(t)
        spans += added_spans(t, spans, threshold)
        return redacted(t, spans) if spans else t

    def run(batches):
        for batch in batches:
            for b in sliced(batch):
                text = pa.array([t if t is None else clean(t) for t in b.column(at).to_pylist()], pa.string())
                yield b.set_column(at, b.schema.field(at), text.cast(b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
