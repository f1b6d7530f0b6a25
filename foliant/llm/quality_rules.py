"""Quality rules as a short-circuit cascade.

Words are runs of characters other than ASCII white space. Features of a text, such as ``n_words``, ``word_chars``,
``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` (words in 3-word windows that the text has twice or more, the first
included) and ``n_upper``, are computed when a rule first asks for them and kept for the rules after it.

All rules, the base test's two (under 50 words; over half of the words in repeated windows) among them, run as a
cascade. Each task estimates on a sample of its own texts what a rule costs and how often it rejects, orders the rules
by rejections per cost, and for each text ends at the first rule that rejects it: what only later rules need is never
computed. The order changes what is computed, never the verdict: a text is kept if no rule rejects it. The sample is
the task's first texts, up to ``SAMPLE_TEXTS`` and ``SAMPLE_BYTES``; nothing of it leaves the task.

Where the counts of all texts are asked for, as in :func:`quality_rules`, they are computed first: the rules on them
then cost next to nothing, and the cascade decides about the rest.

Defined cases: a null text has no words and fails the base test; a null id passes through; repeated rows each get
their own result; an empty table gives no rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import picked, rowwise

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A task's texts on which costs and rejections are estimated: one at least.
SAMPLE_TEXTS, SAMPLE_BYTES = 200, 256 << 10
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Text:
    """A text with its features, each computed once, when it is first asked for."""

    def __init__(self, raw: bytes):
        self.raw = raw

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [x for x in self.raw.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points in words: bytes of UTF-8 that don't continue a character."""
        a = np.frombuffer(b"".join(self.words), np.uint8)
        return int(len(a) - np.count_nonzero((a & 0xC0) == 0x80))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_upper(self) -> int:
        return sum(w.isupper() for w in self.words)

    @cached_property
    def n_repeat_words(self) -> int:
        n = len(self.words)
        if n < 4:
            return 0
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in self.words), np.int64, n)
        pair = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
        _, at, count = np.unique(pair[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
        again = count[at] > 1
        if not again.any():
            return 0
        inside = np.zeros(n, bool)
        for k in range(3):
            inside[k : k + n - 2] |= again
        return int(np.count_nonzero(inside))


Rule = Callable[[Text], bool]

#: The base test: a text that one of these rejects has ``base_failed``.
BASE: dict[str, Rule] = {
    "few_words": lambda t: t.n_words < MIN_WORDS,
    "repeats": lambda t: 100 * t.n_repeat_words > MAX_REPEAT_PERCENT * t.n_words,
}
#: name -> whether it rejects the text. Thresholds follow published heuristics for web text.
RULES: dict[str, Rule] = {
    **BASE,
    "too_many_words": lambda t: t.n_words > 1_000_000,
    "mean_word_length": lambda t: not 2 * t.n_words <= t.word_chars <= 25 * t.n_words,
    "symbols": lambda t: 4 * t.n_symbols > t.n_words,
    "dup_lines": lambda t: 10 * t.n_dup_lines > 3 * max(1, len(t.lines)),
    "upper_case": lambda t: 2 * t.n_upper > t.n_words,
}


def order_rules(sample: Sequence[bytes], rules: dict[str, Rule] = RULES, given: Sequence[str] = ()) -> list[str]:
    """Rule names by rejections per second on ``sample``, the most first; ties by cost.

    A rule is timed on texts that have nothing computed but the features ``given``.
    """
    rate = {}
    for name, rejects in rules.items():
        texts = [Text(x) for x in sample]
        for t in texts:
            for feature in given:
                getattr(t, feature)
        began = time.perf_counter()
        hits = sum(rejects(t) for t in texts)
        cost = max(time.perf_counter() - began, 1e-7)
        rate[name] = (-hits / cost, cost)
    return sorted(rules, key=lambda n: (rate[n], n))


def rejected_by(t: Text, order: Sequence[str], rules: dict[str, Rule] = RULES) -> str | None:
    """The first rule of the cascade that rejects the text."""
    return next((name for name in order if rules[name](t)), None)


def sampled(raws: Sequence[bytes]) -> list[bytes]:
    """The first texts up to the sample's bounds, one at least."""
    out, size = [], 0
    for raw in raws[:SAMPLE_TEXTS]:
        size += len(raw)
        if out and size > SAMPLE_BYTES:
            break
        out.append(raw)
    return out


def _cascaded(docs: DataFrame, id_col: str, text_col: str, rules: dict[str, Rule], given: Sequence[str], fields: list[T.StructField], row) -> DataFrame:
    rows = picked(docs, id=id_col, text=text_col)
    rows = rows.select("id", rows["text"].cast("binary").alias("text"))
    schema = T.StructType([T.StructField(id_col, rows.schema["id"].dataType), *fields])

    def build():
        order: list[str] = []

        def step(b):
            raws = [raw or b"" for raw in b.column(1).to_pylist()]
            if not order:
                order.extend(order_rules(sampled(raws), rules, given))
            out = [row(t, rejected_by(t, order, rules)) for t in map(Text, raws)]
            return {id_col: b.column(0), **{f.name: [r[k] for r in out] for k, f in enumerate(fields)}}

        return step

    return rowwise(rows, schema, build)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict[str, Rule] = RULES) -> DataFrame:
    """A row for each row of ``docs``: its id and ``kept``. Only what the cascade asks for is computed."""
    return _cascaded(docs, id_col, text_col, rules, (), [T.StructField("kept", T.BooleanType())], lambda t, rule: (rule is None,))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict[str, Rule] = RULES) -> DataFrame:
    """A row for each row of ``docs``: its id, the base counts, ``base_failed`` and ``kept``."""
    fields = [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField(c, T.BooleanType()) for c in ("base_failed", "kept")]

    def row(t: Text, rule: str | None) -> tuple:
        failed = rule is not None and any(rejects(t) for rejects in BASE.values())
        return (*(getattr(t, c) for c in COUNTS), failed, rule is None)

    return _cascaded(docs, id_col, text_col, {**BASE, **rules}, COUNTS, fields, row)
