"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A text is contaminated by an item if some ``window`` consecutive characters of the item (all of it, if it is
shorter) stand in the text with at most ``rate`` of them edited. Texts and items are compared in lower case, with
each run of other characters than letters and digits as one space.

By the q-gram lemma, a window of w characters with at most k edits shares at least ``w + 1 - q * (k + 1)`` q-grams
with the text, all on neighbouring diagonals. So the q-grams that a text shares with the benchmark are counted in
diagonal bands that overlap by half, each at least k + 1 wide in its overlap; bands with too few shared q-grams in
every stretch of w + k characters can't hold a match and go. What stays is verified by banded alignment. For an item
of which the lemma would ask for less than one q-gram of the usual length, q is shorter: its budget stays, and items of
one length of q are searched for together. Items so short that their budget is 0 are found where they stand as whole
words.

A q-gram that is frequent in texts and items has many postings. They are never laid out all at once: stretches of texts
and of items, overlapping by what a window needs, are looked at one by one, each of at most ``POSTINGS`` pairs of places
or of two windows' length. In each, items that stand in a text unedited are found first, as runs of pairs on one
diagonal, and are dropped from what is counted later.

The benchmark is a query set: its distinct texts are searched for in blocks of about ``block_chars`` characters, each
block over all texts.

Defined cases: a null text counts as empty; a null item, or one without letters and digits, is found nowhere; null ids
pass through; repeated texts and repeated items each give their own rows; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import picked, sliced

Q = 12
WINDOW = 80
RATE = 0.05
BLOCK_CHARS = 1_000_000
#: Texts that are searched at once; a q-gram takes some 30 times its character's bytes.
BATCH_BYTES = 2 << 20
#: Pairs of a place in a text and one in an item that are looked at at once.
POSTINGS = 500_000
#: Windows whose edits are remembered within a batch.
TRIED = 50_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_BITS = 22


def _fold_table() -> np.ndarray:
    """Lower case for letters and digits of the basic plane, a space for the rest."""
    out = np.full(1 << 16, 32, np.uint32)
    for c in range(1 << 16):
        if not 0xD800 <= c < 0xE000 and (x := chr(c)).isalnum():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


_FOLD: np.ndarray | None = None


def fold(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of all texts, a 0 before each and at the end, and where each begins."""
    global _FOLD
    if _FOLD is None:
        _FOLD = _fold_table()
    codes = np.frombuffer(("\0" + "\0".join(t.replace("\0", " ") for t in texts) + "\0").encode("utf-32-le", "replace"), np.uint32)
    walls = codes == 0
    codes = np.where(codes < 1 << 16, _FOLD[np.minimum(codes, (1 << 16) - 1)], codes)
    codes[walls] = 0
    blank = codes == 32
    keep = ~blank
    keep[1:] |= blank[1:] & (codes[:-1] > 32)
    codes = codes[keep]
    return codes, np.flatnonzero(codes == 0)[:-1] + 1


def qgrams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q code points from each position; built up by doubling."""
    part, width, out, done = codes.astype(np.uint64) + np.uint64(1), 1, None, 0
    power = _BASE
    with np.errstate(over="ignore"):
        while True:
            if q & width:
                if out is None:
                    out, done, out_power = part, width, power
                else:  # bits already taken stand first
                    n = len(part) - done
                    out = out[:n] * power + part[done : done + n]
                    done += width
            width *= 2
            if width > q:
                return out[: max(0, len(codes) - q + 1)]
            half = width // 2
            part = part[: len(part) - half] * power + part[half:] if len(part) > half else part[:0]
            power = power * power


def gram_length(size: int, q: int = Q, window: int = WINDOW, rate: float = RATE) -> int:
    """The greatest q up to the usual one of which the lemma asks for one q-gram or more."""
    w = min(size, window)
    return max(1, min(q, w // (int(w * rate) + 1)))


def bare(codes: np.ndarray) -> np.ndarray:
    """Folded code points without a space at either end."""
    return codes[(1 if len(codes) and codes[0] == 32 else 0) : len(codes) - (1 if len(codes) and codes[-1] == 32 else 0)]


def benchmarks(items: list[tuple[object, str | None]], q: int = Q, window: int = WINDOW, rate: float = RATE) -> list[Benchmark]:
    """A block of items, those with one length of q-grams together."""
    codes, starts = fold([t or "" for _, t in items])
    ends = np.r_[starts[1:] - 1, len(codes) - 1] if len(starts) else starts
    by: dict[int, list] = {}
    for (i, t), s, e in zip(items, starts, ends):
        if size := len(bare(codes[s:e])):
            by.setdefault(gram_length(size, q, window, rate), []).append((i, t))
    return [Benchmark(some, n, window, rate) for n, some in sorted(by.items())]


class Benchmark:
    """The q-grams of a block of items, and what the lemma asks of each item."""

    def __init__(self, items: list[tuple[object, str | None]], q: int = Q, window: int = WINDOW, rate: float = RATE):
        self.q = q
        codes, starts = fold([t or "" for _, t in items])
        ends = np.r_[starts[1:] - 1, len(codes) - 1] if len(starts) else starts
        self.items, self.codes = [], []
        for (i, _), s, e in zip(items, starts, ends):
            text = bare(codes[s:e])
            if len(text) >= q:
                self.items.append(i)
                self.codes.append(text)
        size = np.array([len(c) for c in self.codes], np.int64)
        self.w = np.minimum(size, window)
        self.k = np.minimum((self.w * rate).astype(np.int64), np.maximum(0, self.w // q - 1))
        self.need = self.w + 1 - q * (self.k + 1)
        self.step = int(self.k.max(initial=0)) + 1
        #: A match's characters in the text and in the item.
        self.reach, self.span = int((self.w + self.k).max(initial=1)), int(self.w.max(initial=1))
        #: Items one behind the other: where each begins. Between their q-grams lie some places without any.
        self.begin = np.cumsum(size) - size
        self.places = int(size.sum())
        grams = [qgrams(c, q) for c in self.codes]
        all_grams = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        at = np.concatenate([b + np.arange(len(g)) for b, g in zip(self.begin, grams)]) if grams else np.zeros(0, np.int64)
        order = np.argsort(all_grams, kind="stable")
        self.gram, count = np.unique(all_grams[order], return_counts=True)
        self.at = at[order]
        #: Postings by q-gram and place.
        self.key = np.repeat(np.arange(len(self.gram)), count) * self.places + self.at
        self.present = np.zeros(1 << _BITS, bool)
        self.present[self._slot(self.gram)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (h * _SPREAD) >> np.uint64(64 - _BITS)

    def _parts(self, at: np.ndarray, gram: np.ndarray, lo: int, hi: int, known: Callable[[int, int, int, int], bool]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places in texts with the first and last posting of each, for items' places from ``lo`` to ``hi``: cut up, with
        overlaps, until there are few pairs or two windows. ``known`` says of a stretch that nothing is left to find."""
        if not len(at) or known(int(at[0]), int(at[-1]), lo, hi):
            return
        first, stop = (np.searchsorted(self.key, gram * self.places + x) for x in (lo, hi))
        some = stop > first
        at, gram, first, stop = at[some], gram[some], first[some], stop[some]
        if not len(at):
            return
        long, wide = int(at[-1] - at[0]) > 2 * self.reach, hi - lo > 2 * self.span
        if int((stop - first).sum()) <= POSTINGS or not (long or wide):
            yield at, first, stop
        elif long:
            middle = int(at[0] + at[-1]) // 2
            for k in (at < middle + self.reach, at >= middle):
                yield from self._parts(at[k], gram[k], lo, hi, known)
        else:
            middle = (lo + hi) // 2
            yield from self._parts(at, gram, lo, middle + self.span, known)
            yield from self._parts(at, gram, middle, hi, known)

    def found(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> dict[tuple[int, int], int]:
        """(text, item) to the fewest edits of any window of the item in the text, where these are within the budget."""
        if not len(self.gram):
            return {}
        h = qgrams(codes, self.q)
        at = np.flatnonzero(self.present[self._slot(h)])
        gram = np.minimum(np.searchsorted(self.gram, h[at]), len(self.gram) - 1)
        same = self.gram[gram] == h[at]
        at, gram = at[same], gram[same]
        exact: dict[int, np.ndarray] = {}  # text to the items that stand in it unedited
        for place, own, text, item in self._pairs(at, gram, starts, ends, exact):
            rows = self._unedited(codes, place, own, text, item)
            for t in np.unique(rows[:, 0]).tolist():
                exact[t] = np.union1d(exact.get(t, rows[:0, 1]), rows[rows[:, 0] == t, 1])
        best = {(t, i): 0 for t, some in exact.items() for i in some.tolist()}
        tried: dict = {}
        for place, own, text, item in self._pairs(at, gram, starts, ends, exact):
            left = self.k[item] > 0
            for (t, i), bands in self._bands(place[left], own[left] - self.begin[item[left]], text[left], item[left]).items():
                d = self.verify(codes, int(starts[t]), int(ends[t]), i, bands, tried)
                if d is not None and d < best.get((t, i), d + 1):
                    best[t, i] = d
        return best

    def _pairs(self, at: np.ndarray, gram: np.ndarray, starts: np.ndarray, ends: np.ndarray, exact: dict[int, np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
        """Places in texts and in items of shared q-grams, texts and items, some at a time, without what is in ``exact``."""

        def known(a: int, b: int, lo: int, hi: int) -> bool:
            t = int(np.searchsorted(starts, a, "right")) - 1
            if t not in exact or b >= ends[t]:
                return False
            i, j = np.searchsorted(self.begin, [lo, hi - 1], "right") - 1
            return np.diff(np.searchsorted(exact[t], [i, j + 1]))[0] == j + 1 - i

        for at, first, stop in self._parts(at, gram, 0, self.places, known):
            many = stop - first
            place = np.repeat(at, many)
            own = self.at[np.repeat(first - (np.cumsum(many) - many), many) + np.arange(len(place))]
            text, item = np.searchsorted(starts, place, "right") - 1, np.searchsorted(self.begin, own, "right") - 1
            if here := [t for t in range(text[0], text[-1] + 1) if t in exact]:
                table = np.zeros((text[-1] - text[0] + 1, len(self.items)), bool)
                for t in here:
                    table[t - text[0], exact[t]] = True
                left = ~table[text - text[0], item]
                place, own, text, item = place[left], own[left], text[left], item[left]
            if len(place):
                yield place, own, text, item

    def _unedited(self, codes: np.ndarray, place: np.ndarray, own: np.ndarray, text: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Distinct (text, item) of which a window stands in the text as it is: as many q-grams as it has, one behind the
        other on one diagonal. No run goes from one text or item to the next, since q-grams hold no end."""
        order = np.argsort((place - own + self.places << 32) + place)
        p, d = place[order], (place - own)[order]
        fresh = np.r_[True, (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1)]
        begin = np.flatnonzero(fresh)
        size = np.diff(np.r_[begin, len(p)])
        k = order[begin]
        enough = size >= (self.w - self.q + 1)[item[k]]
        k, p = k[enough], p[begin][enough]
        i = item[k]
        # items without a budget stand as whole words
        whole = (self.k[i] > 0) | ((codes[p - 1] <= 32) & (codes[np.minimum(p + self.w[i], len(codes) - 1)] <= 32))
        return np.unique(np.c_[text[k][whole], i[whole]], axis=0).reshape(-1, 2)

    def _bands(self, place: np.ndarray, pos: np.ndarray, text: np.ndarray, item: np.ndarray) -> dict[tuple[int, int], list[tuple[int, np.ndarray]]]:
        """(text, item) to bands that meet the lemma: first diagonal, positions in the item."""
        out: dict = {}
        if not len(place):
            return out
        band = (place - pos) // self.step
        item, pos, text, place = (np.r_[x, x] for x in (item, pos, text, place))
        band = np.r_[band, band - 1]
        order = np.lexsort((place, band, item, text))
        item, pos, text, place, band = (x[order] for x in (item, pos, text, place, band))
        i = np.arange(len(item))
        j = i + self.need[item] - 1
        inside = j < len(item)
        i, j = i[inside], j[inside]
        full = (text[i] == text[j]) & (item[i] == item[j]) & (band[i] == band[j])
        full &= place[j] - place[i] <= (self.w + self.k)[item[i]] - self.q
        if not full.any():
            return out
        fresh = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])])
        group = np.unique(np.searchsorted(fresh, i[full], "right") - 1)
        stops = np.r_[fresh[1:], len(item)]
        for g in group:
            s, e = fresh[g], stops[g]
            out.setdefault((int(text[s]), int(item[s])), []).append((int(band[s]) * self.step, pos[s:e]))
        return out

    def verify(self, codes: np.ndarray, lo: int, hi: int, item: int, bands: list, tried: dict) -> int | None:
        """The fewest edits of any window of the item within the text ``codes[lo:hi]``, or None if over the budget.

        ``tried`` remembers windows, since items share passages."""
        w, k, text = int(self.w[item]), int(self.k[item]), self.codes[item]
        best = None
        for diagonal, pos in bands:
            hits = np.bincount(pos, minlength=len(text))
            sums = np.r_[0, np.cumsum(np.minimum(hits, 1))]
            first = np.arange(len(text) - w + 1)
            in_window = sums[first + w - self.q + 1] - sums[first]
            for s in first[np.argsort(-in_window, kind="stable")]:
                if in_window[s] < self.need[item]:
                    break
                key = (text[s : s + w].tobytes(), int(s) + diagonal)
                if (d := tried.get(key, w)) == w:
                    if len(tried) >= TRIED:
                        tried.clear()
                    d = tried[key] = banded(text[s : s + w], codes, lo, hi, int(s) + diagonal - k, 2 * self.step + 2 * k + 1, k)
                if d is not None and (best is None or d < best):
                    best = d
                    if best <= 1:  # unedited ones are known
                        return best
        return best


def banded(word: np.ndarray, codes: np.ndarray, lo: int, hi: int, start: int, width: int, k: int) -> int | None:
    """The fewest edits (at most k, else None) that turn ``word`` into a piece of ``codes[lo:hi]`` which, along its
    whole length, keeps within the diagonals from ``start`` to ``start + width - 1``."""
    steps = np.arange(width)
    far = len(word) + 1
    row = np.where((start + steps >= lo) & (start + steps <= hi), 0, far)
    padded = np.full(width + len(word) + 1, -1, np.int64)
    a, b = max(lo, start), min(hi, start + len(padded))
    if a < b:
        padded[a - start : b - start] = codes[a:b]
    for r, c in enumerate(word):
        places = start + r + 1 + steps  # what of the text is used after this character
        new = row + (padded[r : r + width] != c)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        new[(places < lo) | (places > hi)] = far
        # the piece of text that ends here may also hold more: one edit for each further character
        row = np.minimum.accumulate(new - steps) + steps
        row[(places < lo) | (places > hi)] = far
        if row.min() > k:
            return None
    return int(row.min())


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    q: int = Q,
    window: int = WINDOW,
    rate: float = RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """A row (id, item id, ``edits``) for each text and each item that contaminates it; ``edits`` is the least number
    of edits of any window."""
    spark = docs.sparkSession
    rows = picked(docs, id=id_col, text=text_col)
    items = picked(benchmark, item=item_col, text=item_text_col).withColumn("digest", F.sha2("text", 256))
    distinct = items.filter("text IS NOT NULL").groupBy("digest").agg(F.first("text").alias("text"))
    schema = T.StructType([T.StructField(id_col, rows.schema["id"].dataType), T.StructField("digest", T.StringType()), T.StructField("edits", T.IntegerType())])
    chars = distinct.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = int(chars // block_chars) + 1
    out = None
    for k in range(blocks):
        block = distinct.filter(F.pmod(F.xxhash64("digest"), F.lit(blocks)) == k) if blocks > 1 else distinct
        found = [(r.digest, r.text) for r in block.collect()]
        part = _search(rows, spark.sparkContext.broadcast(found), schema, q, window, rate)
        out = part if out is None else out.unionByName(part)
    owners = items.select("digest", F.col("item").alias(item_col))
    return out.join(owners, "digest").select(F.col(f"`{id_col}`"), F.col(f"`{item_col}`"), "edits")


def _search(rows: DataFrame, block, schema: T.StructType, q: int, window: int, rate: float) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches):
        some = benchmarks(block.value, q, window, rate)
        for batch in batches:
            for b in sliced(batch, BATCH_BYTES):
                codes, starts = fold([t or "" for t in b.column(1).to_pylist()])
                ends = np.r_[starts[1:] - 1, len(codes) - 1]
                texts, items, edits = [], [], []
                for bench in some:
                    for (t, i), d in bench.found(codes, starts, ends).items():
                        texts.append(t)
                        items.append(bench.items[i])
                        edits.append(d)
                if texts:
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(texts)), pa.array(items, arrow.field(1).type), pa.array(edits, pa.int32())], schema=arrow
                    )

    return rows.mapInArrow(run, schema)
