"""The correction cascade over pages of words: reunify, split, autocorrect, mojibake, context.

A table of pages has ``volume``, ``page`` (consecutive whole numbers within a volume), ``lines`` (the words of each line
with any) and ``hyphens`` (of each line the word before a hyphen at its end, or null). Each stage is a table of pages
again, written before the next one reads it, with an audit of what it changed.

What is stored of pages is two strings, and words are looked up, put together and replaced for a batch of pages at once, in
tables of words that every worker holds (:mod:`lookup`). What goes over a page's end, and the choice by context, are rows,
of a page's ends and of single words. Splits, corrections and mended characters are decided once for each distinct word.

Defined cases: a null text has no lines; a page without lines passes through; repeated pages are each corrected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..sources.paths import stored
from . import tokens as W
from .lookup import HEAD, KNOWN, MADE, TAIL, Held, Looked, held, one_after_another, runs

STAGES = ("reunify", "split", "autocorrect", "mojibake", "context")
# How far a line's or page's last word looks ahead, how many pieces and how far apart a word may be.
LOOKAHEAD, PIECES, REACH = 6, 4, 6
# Zipf values of words that may be joined, of pieces of a split, and of pieces of a long word.
STRONG, SPLIT, LONG = 2.8, 3.2, 3.0


@dataclass
class Lexicon:
    """What the cascade knows of words.

    ``known`` (tok, freq), ``strong`` (tok) of words that parts may be joined to, ``vocab`` (tok, freq) of all words,
    ``total`` places of words, ``names`` (tok) never corrected.
    """

    known: DataFrame
    strong: DataFrame
    vocab: DataFrame
    total: int
    names: DataFrame
    _held: list = field(default_factory=list)

    @classmethod
    def of(cls, known: DataFrame, vocab: DataFrame, names: DataFrame | None = None) -> Lexicon:
        known = stored(known.select("tok", "freq"), "known")
        total = vocab.agg(F.sum("freq")).first()[0] or 0
        strong = known.filter(W.zipf(F.col("freq"), total) >= STRONG).select("tok")
        return cls(known, strong, vocab, total, known.select("tok").limit(0) if names is None else names.select("tok"))

    def held(self, pieces: DataFrame | None = None) -> Broadcast[Held]:
        """Known words and what they may be used for, for lookups in batches; and ``pieces`` (tok, m) of them."""
        if pieces is None and self._held:
            return self._held[0]
        strong = F.when(W.zipf(F.col("freq"), self.total) >= STRONG, MADE).otherwise(0)
        each = self.known.select("tok", (KNOWN + strong).alias("m"))
        if pieces is not None:
            return held(each.unionByName(pieces))
        self._held.append(held(each))
        return self._held[0]

    def at_least(self, zipf: float) -> DataFrame:
        return self.known.filter(W.zipf(F.col("freq"), self.total) >= zipf)


AT = ("volume", "page")

#: Letters outside A to Z and À to ÿ that in lower case are among these.
_STRANGE = "[\u0178\u1e9e\u212a\u212b]"
# A word before a hyphen at a line's end, which may be one that only ends lines beside "\n".
_HYPHENED = r"(?P<word>[A-Za-zÀ-ÿ]{2,})-[ \t\r]*[\x{85}\x{2028}\x{2029}]?$"


def pages_of(texts: DataFrame, volume: str, page: str, text: str = "text") -> DataFrame:
    """Pages from texts, their words in lower case: made for a batch of texts at once."""
    low, own = F.lower(F.coalesce(F.col(text), F.lit(""))), F.when(F.col(text).rlike(_STRANGE), F.col(text))
    rows = texts.select(F.col(volume).alias("volume"), F.col(page).cast("long").alias("page"), low.alias("low"), own.alias("own"))

    def make(b: pa.RecordBatch) -> list[pa.Array]:
        words, code, row = W._numbered(b.column("low"), True)
        line = (np.cumsum(code < 0) + row)[code >= 0]  # of all lines of these texts
        code, row = code[code >= 0], row[code >= 0]
        first = np.flatnonzero(np.r_[True, line[1:] != line[:-1]]) if len(line) else line
        hyphens = _hyphened(pc.split_pattern(pc.coalesce(b.column("own"), b.column("low")), "\n").flatten().take(pa.array(line[first])))
        outer = np.searchsorted(row[first], np.arange(b.num_rows + 1))  # lines with words
        full = np.diff(outer)
        begin = np.r_[0, np.cumsum(np.maximum(full, 1))]
        number = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(code)]))
        none = full == 0
        ends = pc.binary_join(pa.ListArray.from_arrays(pa.array(outer, pa.int32()), pc.fill_null(hyphens, "")), "\n")
        return [_written(_Words(words, code, row, begin[row] + number - outer[row], begin, none)), pc.if_else(pa.array(none), pa.scalar(None, pa.string()), ends)]

    return _as_pages(_by_slice(rows, make, "flat string, ends string"))


def _as_pages(flat: DataFrame) -> DataFrame:
    """Pages with ``lines`` and ``hyphens`` for those who want them; what is stored and read in batches are two strings."""
    lines = F.transform(F.split("flat", " *\n *"), lambda x: F.filter(F.split(x, " "), lambda w: w != ""))
    hyphens = F.transform(F.split("ends", "\n"), lambda x: F.nullif(x, F.lit("")))
    none = lambda kind: F.array().cast(kind)
    return flat.select(*AT, F.coalesce(lines, none("array<array<string>>")).alias("lines"), F.coalesce(hyphens, none("array<string>")).alias("hyphens"), "flat", "ends")


def _flat(pages: DataFrame) -> DataFrame:
    """(volume, page, flat, ends): a page's words with a blank between, and a line's end as a word; each line's hyphened word
    or nothing. Both are null for a page without lines."""
    if "flat" in pages.columns:
        return pages.select(*AT, "flat", "ends")
    some = F.size("lines") > 0
    flat = F.array_join(F.transform("lines", lambda x: F.array_join(x, " ")), " \n ")
    ends = F.array_join(F.transform("lines", lambda _, k: F.coalesce(F.get("hyphens", k), F.lit(""))), "\n")
    return pages.select(*AT, F.when(some, flat).alias("flat"), F.when(some, ends).alias("ends"))


def _kept(pages: DataFrame, name: str) -> DataFrame:
    return _as_pages(stored(_flat(pages), name))


@dataclass
class _Words:
    """The words of some pages: each place's distinct word, page and line by number. ``begin`` has each page's first line and
    the end, ``none`` says which pages have no lines."""

    words: pa.Array
    code: np.ndarray
    row: np.ndarray
    line: np.ndarray
    begin: np.ndarray
    none: np.ndarray

    def place(self, at: np.ndarray) -> np.ndarray:
        """Places on their pages: ``LINE`` times the line and the number in it."""
        line = self.line[at]
        return (line - self.begin[self.row[at]]) * LINE + at - np.searchsorted(self.line, line)

    def at(self, row: np.ndarray, place: np.ndarray, own: pa.Array) -> np.ndarray:
        """Where a page has a word at a place; -1 where it has none or another one there."""
        line = self.begin[row] + place // LINE
        at = np.searchsorted(self.line, line) + place % LINE
        there = at < len(self.code)
        at = np.where(there, at, 0)
        if len(self.code) and len(at):
            there &= (line < self.begin[row + 1]) & (self.line[at] == line)
            there &= pc.equal(self.words.take(pa.array(self.code[at])), own).to_numpy(zero_copy_only=False)
        return np.where(there, at, -1)

    def edited(self, first: np.ndarray, put: pa.Array, gone: np.ndarray) -> _Words:
        """With words put at some places and others gone."""
        new = put.dictionary_encode()
        code, left = self.code.copy(), np.ones(len(self.code), bool)
        code[first] = len(self.words) + new.indices.to_numpy(zero_copy_only=False)
        left[gone] = False
        return _Words(one_after_another(self.words, new.dictionary), code[left], self.row[left], self.line[left], self.begin, self.none)


def _read(flat: pa.Array) -> _Words:
    split = pc.split_pattern(pc.fill_null(flat, ""), " ")
    coded = split.values.dictionary_encode()
    words, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(flat)), np.diff(split.offsets.to_numpy()))
    ends = code == pc.index(words, "\n").as_py() if pc.index(words, "\n").as_py() >= 0 else np.zeros(len(code), bool)
    left = ~ends & (code != pc.index(words, "").as_py())
    begin = np.r_[0, np.cumsum(np.bincount(row[ends], minlength=len(flat)) + 1)]
    line = np.cumsum(ends) + row
    return _Words(words, code[left], row[left], line[left], begin, pc.is_null(flat).to_numpy(zero_copy_only=False))


def _written(w: _Words) -> pa.Array:
    count = np.bincount(w.line, minlength=w.begin[-1])
    size = count + 1
    size[w.begin[1:] - 1] -= 1  # no end behind a page's last line
    ends = np.r_[0, np.cumsum(size)]
    out = np.full(ends[-1], len(w.words))
    out[ends[w.line] + np.arange(len(w.code)) - (np.cumsum(count) - count)[w.line]] = w.code
    each = pa.ListArray.from_arrays(pa.array(ends[w.begin], pa.int32()), one_after_another(w.words, pa.array(["\n"])).take(pa.array(out)))
    return pc.if_else(pa.array(w.none), pa.scalar(None, pa.string()), pc.binary_join(each, " "))


def _by_slice(rows: DataFrame, make: Callable[[pa.RecordBatch], list[pa.Array]], schema: str) -> DataFrame:
    """``volume`` and ``page`` of some rows, and what ``make`` gives for each, a slice of a batch at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in W._sliced(batch):
                out = make(b)
                yield pa.RecordBatch.from_arrays([b.column("volume"), b.column("page"), *out], names=names)

    names = [*AT, *T.StructType.fromDDL(schema).names]
    return rows.mapInArrow(run, f"volume {rows.schema['volume'].dataType.simpleString()}, page long, {schema}")


def _many(pages: DataFrame, make: Callable[[pa.RecordBatch, _Words], list[pa.Array]], schema: str, *columns: str) -> DataFrame:
    """Rows that ``make`` gives for some pages and their words, a slice of a batch at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in W._sliced(batch):
                yield pa.RecordBatch.from_arrays(make(b, _read(b.column("flat"))), names=names)

    names = T.StructType.fromDDL(schema).names
    return _flat(pages).select(*columns, "flat").mapInArrow(run, schema)


def _listed(row: np.ndarray, n: int, **columns: pa.Array) -> pa.Array:
    """Structs in a list for each of ``n`` rows, in their order."""
    order = pa.array(np.argsort(row, kind="stable"))
    each = pa.StructArray.from_arrays([c.take(order) for c in columns.values()], names=list(columns))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(np.sort(row), np.arange(n + 1)), pa.int32()), each)


def _hyphened(lines: pa.Array) -> pa.Array:
    """The word before a hyphen at each line's end, or null."""
    at = np.flatnonzero(pc.match_substring_regex(lines, _HYPHENED).to_numpy(zero_copy_only=False))
    found = pc.utf8_lower(pc.extract_regex(lines.take(pa.array(at)), _HYPHENED).field("word"))
    place = np.full(len(lines), -1)
    place[at] = np.arange(len(at))
    return found.take(pa.array(place, mask=place < 0))



def unknown_words(pages: DataFrame, words: Lexicon, shortest: int = 1) -> DataFrame:
    """(tok): the distinct words of all pages, of so many letters, that aren't known; those of a slice are found before
    anything is shuffled."""
    table = words.held()

    def make(_: pa.RecordBatch, w: _Words) -> list[pa.Array]:
        each = w.words.take(pa.array(np.unique(w.code)))
        each = each.filter(pc.greater_equal(pc.utf8_length(each), shortest))
        return [each.filter(pa.array(table.value.find(each) < 0))]

    return _many(pages, make, "tok string").distinct()


def measured(pages: DataFrame, words: Lexicon, stage: str) -> DataFrame:
    """(stage, flagged, tokens): words of two letters or more that aren't known, and all."""
    table = words.held()

    def make(_: pa.RecordBatch, w: _Words) -> list[pa.Array]:
        n = np.bincount(w.code, minlength=len(w.words)) * (pc.utf8_length(w.words).to_numpy(zero_copy_only=False) >= 2)
        return [pa.array([n[table.value.find(w.words) < 0].sum()], pa.int64()), pa.array([n.sum()], pa.int64())]

    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return _many(pages, make, "flagged long, tokens long").agg(total("flagged"), total("tokens")).select(F.lit(stage).alias("stage"), "flagged", "tokens")



# --- reunify: words in pieces -------------------------------------------------------------------------
#
# Of what could be put together and has a place in common that with the least rank is taken, and then of what is left.

#: A word's place on its page: its line times this, and its number in the line.
LINE = 1 << 20
# Names of the rules in audits.
SPACE, BREAK, XPAGE, WINDOW = "reunify_space", "reunify_break", "reunify_xpage", "reunify_window"


_MARKED = "array<array<struct<tok:string,m:int>>>"



def _ends(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each page's lines begin among all lines of a batch, and each line's words among all words, and the ends."""
    size = lambda x: np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False), dtype=np.int64)]
    return size(lines), size(lines.flatten())


def _nested(lines: pa.Array, sizes: np.ndarray, flat: pa.Array) -> pa.Array:
    """``flat`` in the pages and lines of ``lines``, whose words have become so many each."""
    ends = np.r_[0, np.cumsum(sizes)]
    inner = np.r_[0, np.cumsum(pc.list_value_length(lines.flatten()).to_numpy(zero_copy_only=False))]
    outer = np.r_[0, np.cumsum(pc.list_value_length(lines).to_numpy(zero_copy_only=False))]
    return pa.ListArray.from_arrays(pa.array(outer, pa.int32()), pa.ListArray.from_arrays(pa.array(ends[inner], pa.int32()), flat))


def _put_together(pages: DataFrame, taken: DataFrame) -> DataFrame:
    """Pages of marked words, not in flat form, in which the first place of each row of ``taken`` has the whole word and its other places are gone."""
    edits = taken.groupBy(*AT).agg(F.collect_list(F.struct("places", "after")).alias("edits"))
    none = F.array().cast("array<struct<places:array<bigint>,after:string>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in W._sliced(batch):
                lines, edits = b.column("lines"), b.column("edits")
                some, flat = edits.flatten(), lines.flatten().flatten()
                outer, inner = _ends(lines)
                n = pc.list_value_length(some.field("places")).to_numpy(zero_copy_only=False)
                place = some.field("places").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                edit = np.repeat(np.arange(len(n)), n)
                row = np.repeat(np.arange(b.num_rows), pc.list_value_length(edits).to_numpy(zero_copy_only=False))[edit]
                line = outer[row] + place // LINE
                there = line < outer[row + 1]
                line = np.where(there, line, 0)
                word = inner[line] + place % LINE
                there &= word < inner[line + 1]  # repeated pages may differ
                whole = there & (np.r_[True, edit[1:] != edit[:-1]] if len(edit) else there) & pc.not_equal(some.field("after"), "").to_numpy(zero_copy_only=False)[edit]
                source, marks = np.arange(len(flat)), flat.field("m").to_numpy(zero_copy_only=False).copy()
                source[word[whole]], marks[word[whole]] = len(flat) + edit[whole], 0
                sizes = np.ones(len(flat), np.int64)
                sizes[word[there & ~whole]] = 0
                left = np.flatnonzero(sizes)
                words = one_after_another(flat.field("tok"), some.field("after")).take(pa.array(source[left]))
                words = pa.StructArray.from_arrays([words, pa.array(marks[left], pa.int32())], names=["tok", "m"])
                yield pa.RecordBatch.from_arrays([b.column("volume"), b.column("page"), b.column("hyphens"), _nested(lines, sizes, words)], names=["volume", "page", "hyphens", "lines"])

    joined = pages.join(edits, list(AT), "left").select(*AT, "hyphens", "lines", F.coalesce("edits", none).alias("edits"))
    return joined.mapInArrow(run, f"volume {pages.schema['volume'].dataType.simpleString()}, page long, hyphens array<string>, lines {_MARKED}").select(*pages.columns)


def _disjoint(*places: np.ndarray) -> np.ndarray:
    """Which of some rows are taken: one after another, those with no place that is taken."""
    used, out = set(), []
    for k, each in enumerate(zip(*(p.tolist() for p in places))):
        if used.isdisjoint(each):
            used.update(each)
            out.append(k)
    return np.array(out, np.int64)


def _within_lines(w: _Words, table: Held) -> tuple[_Words, list]:
    """Runs of up to ``PIECES`` words of a line that make a strong word, of five letters together. Returns also the rows,
    kinds, and words before and after."""
    first, count, put = runs(Looked(table, w.words), w.code, w.line, PIECES, 5, MADE)
    ends = np.cumsum(count)
    each = np.repeat(first - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)
    before = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), w.words.take(pa.array(w.code[each]))), " ")
    gone = np.setdiff1d(each, first, assume_unique=True)
    return w.edited(first, put, gone), [w.row[first], SPACE, before, put]


def _over_lines(w: _Words, hyphens: pa.Array, table: Held) -> tuple[_Words, list]:
    """A line's last word, if a hyphen stands behind it or it isn't known, and the first word of one of the next lines, the
    nearest that makes a known word with it; they aren't both known."""
    x, code = Looked(table, w.words), w.code
    first = np.flatnonzero(np.r_[True, w.line[1:] != w.line[:-1]]) if len(code) else np.zeros(0, np.int64)
    last, line = np.r_[first[1:], len(code)][: len(first)] - 1, w.line[first]
    odd = (x.m & KNOWN)[code] == 0
    split = pc.split_pattern(pc.fill_null(hyphens, ""), "\n")
    own = np.diff(split.offsets.to_numpy()) == np.diff(w.begin)
    at = np.where(own[w.row[first]], split.offsets.to_numpy()[w.row[first]] + line - w.begin[w.row[first]], 0)
    open_ = own[w.row[first]] & pc.equal(split.values.take(pa.array(at)), w.words.take(pa.array(code[last]))).to_numpy(zero_copy_only=False)
    open_ |= odd[last] & (x.letters[code[last]] >= 3)
    number = np.full(w.begin[-1] + LOOKAHEAD + 1, -1)  # of a line among those with words
    number[line] = np.arange(len(line))
    heads, tails = [], []
    for d in range(1, LOOKAHEAD + 1):
        to = number[line + d]
        ok = open_ & (to >= 0)
        to = first[to[ok]]
        ok, to = (y[w.row[to] == w.row[last[ok]]] for y in (last[ok], to))
        some = odd[ok] | odd[to]
        heads.append(ok[some])
        tails.append(to[some])
    heads, tails = np.concatenate(heads), np.concatenate(tails)
    found, put = x.made(table.hashes.joined(x.hashed[code[heads]], x.size[code[heads]], x.hashed[code[tails]]), [code[heads], code[tails]], KNOWN)
    heads, tails = heads[found], tails[found]
    order = np.lexsort((tails, heads))
    order = order[_disjoint(heads[order], tails[order])]
    heads, tails, put = heads[order], tails[order], put.take(pa.array(order))
    before = pc.binary_join_element_wise(w.words.take(pa.array(code[heads])), w.words.take(pa.array(code[tails])), "|")
    return w.edited(heads, put, tails), [w.row[heads], BREAK, before, put]


_AUDIT = "array<struct<kind:string,before:string,after:string>>"


def within_pages(pages: DataFrame, table: Broadcast[Held]) -> DataFrame:
    """Pages (flat) with words in pieces put together in a line and then over line ends, what was changed, and the words at a
    page's ends: ``head`` (at, tok), its last line's last word if that isn't known, and ``tail``, its first line's first."""

    def make(b: pa.RecordBatch) -> list[pa.Array]:
        w = _read(b.column("flat"))
        w, one = _within_lines(w, table.value)
        w, two = _over_lines(w, b.column("ends"), table.value)
        kinds = pa.array(np.repeat([SPACE, BREAK], [len(one[0]), len(two[0])]).tolist(), pa.string())
        edits = _listed(np.r_[one[0], two[0]], b.num_rows, kind=kinds, before=one_after_another(one[2], two[2]), after=one_after_another(one[3], two[3]))
        # only the last line's last word, and the first line's first, where these lines have one
        x, n = Looked(table.value, w.words), len(w.code)
        if not n:
            none = pa.nulls(b.num_rows, pa.string())
            return [_written(w), b.column("ends"), edits, pa.nulls(b.num_rows, pa.int64()), none, none]
        last, first = np.searchsorted(w.line, w.begin[1:] - 1, "right") - 1, np.minimum(np.searchsorted(w.line, w.begin[:-1]), n - 1)
        code = w.code[last]
        ok = (last >= 0) & (w.line[last] == w.begin[1:] - 1) & (x.letters[code] >= 3) & (x.m[code] & KNOWN == 0)
        tail = w.words.take(pa.array(w.code[first], mask=w.line[first] != w.begin[:-1]))
        return [_written(w), b.column("ends"), edits, pa.array(w.place(last), mask=~ok), w.words.take(pa.array(code, mask=~ok)), tail]

    return _by_slice(pages, make, f"flat string, ends string, edits {_AUDIT}, at long, head string, tail string")


def _over_pages(pages: DataFrame, words: Lexicon) -> tuple[DataFrame, DataFrame]:
    """A page's last word, if it isn't known, and the first word of the next page that begins with one, if both are a
    known word; of pages that would take the same word the nearest before it does. As changes, and as the audit."""
    starts = pages.select("volume", F.col("page").alias("at_"), "tail").filter("tail IS NOT NULL")
    ahead = pages.filter("head IS NOT NULL").select(*AT, "at", "head", F.explode(F.sequence(F.col("page") + 1, F.col("page") + LOOKAHEAD)).alias("at_"))
    near = ahead.join(starts, ["volume", "at_"]).groupBy(*AT, "at", "head").agg(F.min_by(F.struct("at_", "tail"), "at_").alias("t_")).select(*AT, "at", "head", "t_.*")
    near = near.withColumn("joined", F.concat("head", "tail"))
    found = W.join_words(near, words.known.select(F.col("tok").alias("joined")), words.vocab, "left_semi", "joined")
    found = stored(found.groupBy("volume", "at_").agg(F.max_by(F.struct("page", "at", "head", "tail", "joined"), "page").alias("f_")).select("volume", "at_", "f_.*"), "over-pages")
    put = found.select(*AT, "at", F.col("head").alias("own"), F.col("joined").alias("put"))
    gone = found.select("volume", F.col("at_").alias("page"), F.lit(0).cast("long").alias("at"), F.col("tail").alias("own"), F.lit("").alias("put"))
    return put.unionByName(gone), found.select(*AT, F.lit(XPAGE).alias("kind"), F.concat_ws("|", "head", "tail").alias("before"), F.col("joined").alias("after"))


def _with_changes(pages: DataFrame, changes: DataFrame) -> DataFrame:
    """Pages with ``changes`` (volume, page, at, own, put) of theirs in an array: the word at a place, and what it becomes."""
    each = changes.groupBy(*AT).agg(F.collect_list(F.struct("at", "own", "put")).alias("changes"))
    return pages.join(each, list(AT), "left").withColumn("changes", F.coalesce("changes", F.array().cast("array<struct<at:bigint,own:string,put:string>>")))


def _changed(w: _Words, changes: pa.Array) -> _Words:
    each = changes.flatten()
    row = np.repeat(np.arange(len(changes)), pc.list_value_length(changes).to_numpy(zero_copy_only=False))
    at = w.at(row, each.field("at").to_numpy(zero_copy_only=False).astype(np.int64), each.field("own"))
    put = pc.not_equal(each.field("put"), "").to_numpy(zero_copy_only=False)
    some = np.flatnonzero((at >= 0) & put)
    return w.edited(at[some], each.field("put").take(pa.array(some)), at[(at >= 0) & ~put])


def _reach(w: _Words, x: Looked) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Pieces that end a known word and a word up to ``REACH`` places before them, or that begin one and a word as far
    behind them, in reading order, that make a strong word. A known word ends the search, if it isn't itself the partner.

    By rank, in which the nearest place is first and a piece looks back before it looks ahead: each piece's place, side
    and distance, the places of both words, and what they make.
    """
    code = w.code
    m, letters = x.m[code], x.letters[code]
    odd = m & KNOWN == 0
    out = []
    for side, bit in ((0, TAIL), (1, HEAD)):
        own = np.flatnonzero((m & bit > 0) & odd & (letters >= 3))
        for d in range(REACH):
            to = own + (d + 1 if side else -d - 1)
            inside = (to >= 0) & (to < len(code))
            own, to = own[inside], to[inside]
            inside = w.row[own] == w.row[to]
            own, to = own[inside], to[inside]
            long = letters[to] >= 2
            a, b = (own[long], to[long]) if side else (to[long], own[long])
            found, put = x.made(x.table.hashes.joined(x.hashed[code[a]], x.size[code[a]], x.hashed[code[b]]), [code[a], code[b]], MADE)
            out.append((own[long][found], np.full(len(found), side), np.full(len(found), d), a[found], b[found], put))
            own = own[odd[to]]
    own, sides, far, a, b = (np.concatenate([o[k] for o in out]) for k in range(5))
    order = np.lexsort((far, sides, own))
    return *(y[order] for y in (own, sides, far, a, b)), one_after_another(*(o[5] for o in out)).take(pa.array(order))


_ENDS = "array<struct<tok:string,at:bigint,new:bigint,used:boolean>>"


def within_reach(pages: DataFrame, table: Broadcast[Held]) -> DataFrame:
    """Pages with their ``changes`` made and then pieces within reach on a page put together by rank, what was changed, and
    the words at a page's beginning and end: where they stood, where they stand, and whether they were taken."""

    def make(b: pa.RecordBatch) -> list[pa.Array]:
        w = _changed(_read(b.column("flat")), b.column("changes"))
        *_, first, second, put = _reach(w, Looked(table.value, w.words))
        taken = _disjoint(first, second)
        first, second, put = first[taken], second[taken], put.take(pa.array(taken))
        before = pc.binary_join_element_wise(*(w.words.take(pa.array(w.code[k])) for k in (first, second)), "+")
        edits = _listed(w.row[first], b.num_rows, kind=pa.array([WINDOW] * len(first), pa.string()), before=before, after=put)
        out = w.edited(first, put, second)
        begin = np.searchsorted(w.row, np.arange(b.num_rows + 1))
        used, left = np.zeros(len(w.code), bool), np.ones(len(w.code), bool)
        used[first] = used[second] = True
        left[second] = False
        new = np.zeros(len(w.code), np.int64)
        new[left] = out.place(np.arange(len(out.code)))

        def ends(low: np.ndarray, high: np.ndarray) -> pa.Array:
            stops = np.cumsum(high - low)
            at = np.repeat(high - stops, high - low) + np.arange(stops[-1])
            return _listed(np.repeat(np.arange(b.num_rows), high - low), b.num_rows, tok=w.words.take(pa.array(w.code[at])), at=pa.array(w.place(at)), new=pa.array(new[at]), used=pa.array(used[at]))

        return [_written(out), b.column("ends"), edits, ends(begin[:-1], np.minimum(begin[1:], begin[:-1] + REACH)), ends(np.maximum(begin[:-1], begin[1:] - REACH), begin[1:])]

    return _by_slice(pages, make, f"flat string, ends string, edits {_AUDIT}, first {_ENDS}, last {_ENDS}")


def _reach_over_pages(pages: DataFrame, table: Broadcast[Held]) -> tuple[DataFrame, DataFrame]:
    """The same over a page's end: each word by the least rank, where none of both is taken on its page. As changes, and as
    the audit."""
    last = pages.select("volume", F.col("page").alias("page_a"), (F.col("page") + 1).alias("page"), "last")
    both = last.join(pages.select(*AT, "first"), list(AT)).select("volume", "page_a", "page", F.size("last").alias("n"), F.concat("last", "first").alias("both"))
    kind, word = pages.schema["volume"].dataType.simpleString(), "struct<page:bigint,at:bigint,tok:string,new:bigint,used:boolean>"
    schema = f"volume {kind}, rank struct<page:bigint,at:bigint,side:int,d:int>, a {word}, b {word}, before string, after string"
    names = T.StructType.fromDDL(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in W._sliced(batch):
                each, size = b.column("both").flatten(), pc.list_value_length(b.column("both")).to_numpy(zero_copy_only=False).astype(np.int64)
                row, coded = np.repeat(np.arange(b.num_rows), size), each.field("tok").dictionary_encode()
                behind = np.arange(len(row)) - (np.cumsum(size) - size)[row] >= b.column("n").to_numpy(zero_copy_only=False)[row]
                w = _Words(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), row, row, np.arange(b.num_rows + 1), np.zeros(b.num_rows, bool))
                own, side, d, *ab, put = _reach(w, Looked(table.value, w.words))
                over = np.flatnonzero(behind[ab[0]] != behind[ab[1]])
                own, side, d, put = own[over], side[over], d[over], put.take(pa.array(over))
                pages_ = [x.to_numpy(zero_copy_only=False) for x in (b.column("page_a"), b.column("page"))]
                page = lambda at, r=row, p=pages_, k=behind: pa.array(np.where(k[at], p[1][r[at]], p[0][r[at]]))
                of = lambda c, at, e=each: e.field(c).take(pa.array(at))
                rank = pa.StructArray.from_arrays([page(own), of("at", own), pa.array(side, pa.int32()), pa.array(d, pa.int32())], names=["page", "at", "side", "d"])
                parts = [pa.StructArray.from_arrays([page(at), *(of(c, at) for c in ("at", "tok", "new", "used"))], names=["page", "at", "tok", "new", "used"]) for at in (k[over] for k in ab)]
                before = pc.binary_join_element_wise(*(p.field("tok") for p in parts), "+")
                yield pa.RecordBatch.from_arrays([b.column("volume").take(pa.array(row[own])), rank, *parts, before, put], names=names)

    rows = stored(both.mapInArrow(run, schema).dropDuplicates(), "in-reach")
    rows = rows.withColumn("id_", F.struct("a.page", "a.at", F.col("b.page").alias("page_b"), F.col("b.at").alias("at_b"), "rank"))
    ends = rows.select("volume", "id_", "rank", F.explode(F.array("a", "b")).alias("w")).select("volume", "id_", "rank", "w.page", "w.at", "w.used")
    ends = ends.withColumn("best_", F.min("rank").over(Window.partitionBy(*AT, "at")))
    won = ends.groupBy("volume", "id_").agg(F.every(~F.col("used") & (F.col("rank") == F.col("best_"))).alias("won_")).filter("won_").select("volume", "id_")
    rows = stored(rows.join(won, ["volume", "id_"], "left_semi").drop("id_"), "over-pages")
    changes = lambda w, put: rows.select("volume", F.col(f"{w}.page").alias("page"), F.col(f"{w}.new").alias("at"), F.col(f"{w}.tok").alias("own"), put.alias("put"))
    audit = rows.select("volume", F.col("a.page").alias("page"), F.lit(WINDOW).alias("kind"), "before", "after")
    return changes("a", F.col("after")).unionByName(changes("b", F.lit(""))), audit


def reunify(pages: DataFrame, words: Lexicon) -> tuple[DataFrame, DataFrame]:
    """Words in pieces put together: in a line, over line ends, over page ends, and within reach in a volume.

    The last rule is repeated until it finds nothing more, so that a word which was put together can be a partner.
    """
    pages = _flat(pages)
    part = W.fragments(unknown_words(pages, words), words.known, shortest=1).filter("is_head OR is_tail")
    table = words.held(part.select("tok", (F.col("is_head").cast("int") * HEAD + F.col("is_tail").cast("int") * TAIL).alias("m")))
    edits = lambda df: df.select(*AT, F.explode("edits").alias("e")).select(*AT, "e.*")
    pages = stored(within_pages(pages, table), "within-pages")
    changes, over = _over_pages(pages, words)
    audit = edits(pages).unionByName(over)
    while True:
        pages = stored(within_reach(_with_changes(pages.select(*AT, "flat", "ends"), changes), table), "in-reach")
        changes, over = _reach_over_pages(pages, table)
        if over.isEmpty() and edits(pages).isEmpty():
            return _as_pages(pages), audit
        audit = audit.unionByName(edits(pages)).unionByName(over)


# --- decisions for distinct words ---------------------------------------------------------------------


def replaced(pages: DataFrame, fixes: DataFrame, words: Lexicon, kind_of: str) -> tuple[DataFrame, DataFrame]:
    """Pages with each word of ``fixes`` (tok, fix) replaced, by several words if the fix has spaces, and the audit."""
    table = held(stored(fixes.select("tok", "fix"), "fixes"))

    def make(b: pa.RecordBatch) -> list[pa.Array]:
        w, fix = _read(b.column("flat")), table.value.columns["fix"]
        at = table.value.find(w.words)
        known = np.flatnonzero(at >= 0)
        put = pc.fill_null(fix.take(pa.array(at[known])), "")
        new = pc.split_pattern(put, " ")
        n, begin = np.ones(len(w.words), np.int64), np.arange(len(w.words))
        n[known] = pc.list_value_length(new).to_numpy(zero_copy_only=False)
        begin[known] = len(w.words) + np.cumsum(n[known]) - n[known]
        some = np.flatnonzero(at[w.code] >= 0)
        edit = np.searchsorted(known, w.code[some])
        edits = _listed(w.row[some], b.num_rows, before=w.words.take(pa.array(w.code[some])), after=put.take(pa.array(edit)))
        size = n[w.code]
        ends = np.cumsum(size)
        code = np.repeat(begin[w.code] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
        out = _Words(one_after_another(w.words, new.flatten()), code, np.repeat(w.row, size), np.repeat(w.line, size), w.begin, w.none)
        return [_written(out), b.column("ends"), edits]

    out = stored(_by_slice(_flat(pages), make, "flat string, ends string, edits array<struct<before:string,after:string>>"), kind_of)
    return _as_pages(out), out.select(*AT, F.explode("edits").alias("e")).select(*AT, F.lit(kind_of).alias("kind"), "e.before", "e.after")



def _candidates(pages: DataFrame, words: Lexicon, shortest: int) -> DataFrame:
    """(tok, affix) of the distinct unknown words of so many letters, and whether each begins or ends a known word."""
    each = unknown_words(pages, words, shortest)
    return stored(W.fragments(each, words.known, shortest=1).select("tok", (F.col("is_head") | F.col("is_tail")).alias("affix")), "unknown")


def split_fixes(pages: DataFrame, words: Lexicon) -> DataFrame:
    """(tok, fix) of run-on words: eight letters or more, not a part of a known word nor one edit from one."""
    odd = _candidates(pages, words, 8).filter("NOT affix").select("tok")
    odd = odd.join(W.within_one_edit(odd, words.known).select("tok").distinct(), "tok", "left_anti")
    two = W.best_split(odd, words.at_least(SPLIT)).select("tok", F.concat_ws(" ", "left", "right").alias("fix"))
    rest = odd.filter(F.length("tok") >= 15).join(two.select("tok"), "tok", "left_anti")
    return two.unionByName(W.decompositions(rest, words.at_least(LONG)).select("tok", F.array_join("pieces", " ").alias("fix")))


def garbage_shaped(word) -> object:
    """Four times one character, five consonants in a row, or five letters and no vowel."""
    return word.rlike(r"(.)\1\1\1") | word.rlike("[bcdfghjklmnpqrstvwxz]{5,}") | ((F.length(word) >= 5) & ~word.rlike("[aeiouy]"))


def _correctable(pages: DataFrame, words: Lexicon, shortest: int) -> DataFrame:
    roman = F.col("tok").rlike("^[ivxlcdm]{2,}$")
    return _candidates(pages, words, shortest).filter(~F.col("affix") & ~roman & ~garbage_shaped(F.col("tok"))).select("tok")


def correction_fixes(pages: DataFrame, words: Lexicon) -> DataFrame:
    """(tok, fix) of words one edit from a known word that stands out; names and garbage stay."""
    odd = _correctable(pages, words, 3).join(words.names, "tok", "left_anti")
    return W.best_correction(odd, words.known, words.total)


def mojibake_fixes(pages: DataFrame, words: Lexicon) -> DataFrame:
    return W.mojibake_fixes(unknown_words(pages, words).filter(F.col("tok").rlike(r"[^\x00-\x7F]")), words.known)


# --- context ------------------------------------------------------------------------------------------


def _word_places(pages: DataFrame, some: DataFrame, shown: int = 0) -> DataFrame:
    """(place, tok, prev, next) of some words' places (volume, page, line, tok_no), with the words beside them in the line or
    nothing; or (place, context), the word marked among up to ``shown`` ones on either side."""
    table = held(some.select("tok"))
    kind = pages.schema["volume"].dataType.simpleString()

    def make(b: pa.RecordBatch, w: _Words) -> list[pa.Array]:
        at = np.flatnonzero((table.value.find(w.words) >= 0)[w.code])
        row, place = pa.array(w.row[at]), w.place(at)
        place = pa.StructArray.from_arrays([b.column("volume").take(row), b.column("page").take(row), pa.array(place // LINE, pa.int32()), pa.array(place % LINE, pa.int32())], names=[*AT, "line", "tok_no"])
        tok = w.words.take(pa.array(w.code[at]))
        if shown:
            first, last = np.searchsorted(w.line, w.line[at]), np.searchsorted(w.line, w.line[at], "right")
            low, high = np.maximum(first, at - shown), np.minimum(last, at + shown + 1)
            ends = np.cumsum(high - low)
            near = np.repeat(high - ends, high - low) + np.arange(ends[-1] if len(ends) else 0)
            code = w.code[near]
            own = near == np.repeat(at, high - low)
            code[own] += len(w.words)
            mark = pc.binary_join_element_wise("<<", w.words, ">>", "")
            around = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), one_after_another(w.words, mark).take(pa.array(code)))
            return [place, pc.binary_join(around, " ")]
        line, code = np.r_[-1, w.line, -1], np.r_[0, w.code, 0]

        def beside(k: np.ndarray) -> pa.Array:
            near = line[k] == w.line[at]
            return pc.fill_null(w.words.take(pa.array(code[k], mask=~near)), "")

        return [place, tok, beside(at), beside(at + 2)]

    columns = "context string" if shown else "tok string, prev string, next string"
    return _many(pages, make, f"place struct<volume:{kind},page:bigint,line:int,tok_no:int>, {columns}", *AT)


def _choices(pages: DataFrame, words: Lexicon, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tok, candidate) of unknown words, and each of their places (volume, page, line, tok_no) and words with the candidate
    that fits its neighbours best and how well it does.

    Candidates are the known words at one edit and the lookup's at two; ``pairs`` (prev, next, n) says how often words
    stand together.
    """
    odd = stored(_correctable(pages, words, 4), "unknown")
    near = W.within_one_edit(odd, words.known).select("tok", "candidate")
    far = W.symmetric_lookup(odd.filter(F.length("tok") >= 5), words.known).select("tok", F.col("fix").alias("candidate"))
    candidates = stored(near.unionByName(far).distinct(), "candidates")
    at = stored(_word_places(pages, candidates.select("tok").distinct()), "places")
    chosen = stored(W.context_choice(at, candidates, pairs, "place"), "chosen")
    return candidates, at.select("place", "tok").join(chosen.hint("merge"), "place")


def by_context(pages: DataFrame, words: Lexicon, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Unknown words replaced by the candidate that fits their neighbours clearly best.

    A weaker best candidate is audited as ``context_weak`` and the word stays.
    """
    _, rows = _choices(pages, words, pairs)
    rows = rows.withColumn("pick", F.when(F.col("status") == "resolved", F.col("pick")))
    audit = stored(rows.filter("status <> 'no_ctx'").select("place", F.when(F.col("pick").isNotNull(), "context").otherwise("context_weak").alias("kind"), F.col("tok").alias("before"), F.col("pick").alias("after")), "by-context")
    at = F.col("place.line").cast("long") * LINE + F.col("place.tok_no")
    edits = audit.filter("after IS NOT NULL").select("place.volume", "place.page", at.alias("at"), F.col("before").alias("own"), F.col("after").alias("put"))

    def make(b: pa.RecordBatch) -> list[pa.Array]:
        return [_written(_changed(_read(b.column("flat")), b.column("changes"))), b.column("ends")]

    out = _by_slice(_with_changes(_flat(pages), edits), make, "flat string, ends string")
    return _kept(out, "context"), audit.select("place.volume", "place.page", "kind", "before", "after")



#: Words on either side of one that a list shows, and candidates that it names.
SHOWN, NAMED = 7, 6


def context_lists(pages: DataFrame, words: Lexicon, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What neighbours can't decide: places where no candidate stands with them anywhere, and words whose candidates they
    tell apart too little.

    The first as (volume, page, line, tok_no, tok, context, candidates), the word marked among those around it; the second
    as (tok, candidates, n). Candidates are named in their order, six at the most.
    """
    pages = _kept(pages, "pages")
    candidates, rows = _choices(pages, words, pairs)
    named = candidates.groupBy("tok").agg(F.array_join(F.slice(F.array_sort(F.collect_set("candidate")), 1, NAMED), "|").alias("candidates"))
    named = rows.select("place", "tok", "status").join(named.hint("merge"), "tok")
    around = _word_places(pages, candidates.select("tok").distinct(), SHOWN)
    lost = named.filter("status = 'no_ctx'").join(around.hint("merge"), "place").select("place.*", "tok", "context", "candidates")
    weak = named.filter("status NOT IN ('no_ctx', 'resolved')").groupBy("tok", "candidates").agg(F.count("*").alias("n"))
    return lost, weak



# --- the cascade --------------------------------------------------------------------------------------


def cascade(pages: DataFrame, words: Lexicon, pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The corrected pages, the audit (volume, page, kind, before, after) and the rates (stage, flagged, tokens)."""
    pages = _kept(pages, "pages")
    rates, audits = [measured(pages, words, "raw")], []
    for stage in STAGES:
        if stage == "reunify":
            pages, audit = reunify(pages, words)
        elif stage == "context":
            pages, audit = by_context(pages, words, pairs)
        else:
            fixes = {"split": split_fixes, "autocorrect": correction_fixes, "mojibake": mojibake_fixes}[stage](pages, words)
            pages, audit = replaced(pages, fixes, words, {"autocorrect": "autocorrect_e1"}.get(stage, stage))
        audits.append(audit)
        rates.append(measured(pages, words, stage))
    audit, rate = audits[0], rates[0]
    for a in audits[1:]:
        audit = audit.unionByName(a)
    for r in rates[1:]:
        rate = rate.unionByName(r)
    return pages, audit, rate


# --- the three-pass corrector -------------------------------------------------------------------------

#: How often a word must stand to be corrected, and a correction must stand and lead the next one.
OFTEN, LEAST, LEAD = 10, 50, 3.0


def three_passes(texts: DataFrame, words: Lexicon, volume: str, page: str, text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The corrected pages, the audit and the rates of the older corrector: words broken at line ends are put together,
    run-on words are cut where there is one way to, and words that stand often are corrected to the word at one edit
    that is far more frequent than any other.

    A word one edit from a known one isn't cut: it is a misspelling and no run-on.
    """
    whole = pages_of(texts.withColumn(text, X.dehyphenated(F.col(text))), volume, page, text)
    raw = _kept(pages_of(texts, volume, page, text), "raw-pages")
    joined = _kept(whole, "joined-pages")
    odd = _candidates(joined, words, 4).select("tok")
    odd = odd.join(W.within_one_edit(odd, words.known).select("tok").distinct(), "tok", "left_anti")
    cut, audit_b = replaced(joined, W.only_split(odd, words.known).select("tok", F.array_join("pieces", " ").alias("fix")), words, "demerge")
    often = words.vocab.filter(F.col("freq") >= OFTEN).select("tok")
    unsure = _candidates(cut, words, 2).select("tok").join(often, "tok", "left_semi")
    done, audit_c = replaced(cut, W.dominant(W.within_one_edit(unsure, words.known), LEAD, LEAST), words, "spell")
    rates = measured(raw, words, "raw")
    for pages, stage in ((joined, "rejoin"), (cut, "demerge"), (done, "spell")):
        rates = rates.unionByName(measured(pages, words, stage))
    return done, audit_b.unionByName(audit_c), rates
