"""Tables of words that every worker holds, to look up the words of a batch at once.

A table is sent to the workers once: of each word its text, a 64-bit hash and a few columns, some 8 bytes and the word
itself. The words of a batch are found by a search in the sorted hashes, and what is found is compared as text, so that no
two words are taken for one another. The hash of words put together is made from theirs, without their text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# An odd number whose powers are a byte's weights, and words that are hashed at once.
_BASE, _AT_ONCE = 0x9E3779B97F4A7C15, 1 << 16
#: What a table's ``m`` may say of a word: that it is known, that parts may be joined to it, and that a known word begins or
#: ends with it.
KNOWN, MADE, HEAD, TAIL = 1, 2, 4, 8


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(1, n), base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Hashes:
    """Hashes of words: the sum of each byte times a power of ``base``, modulo 2^64."""

    def __init__(self, base: int = _BASE):
        self.base, self._up, self._down = base, _powers(base, 1), _powers(base, 1)

    def __getstate__(self) -> int:
        return self.base

    def __setstate__(self, base: int) -> None:
        self.__init__(base)

    def power(self, n: np.ndarray) -> np.ndarray:
        self._grown(int(n.max()) + 1 if len(n) else 1)
        return self._up[n]

    def _grown(self, n: int) -> None:
        if len(self._up) < n:
            n = max(n, 2 * len(self._up), 1 << 12)
            self._up, self._down = _powers(self.base, n), _powers(pow(self.base, -1, 1 << 64), n)

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each word's hash, and its length in bytes."""
        if isinstance(words, pa.ChunkedArray):
            words = words.combine_chunks()
        _, ends, data = words.buffers()
        if data is None or not len(words):
            return np.zeros(len(words), np.uint64), np.zeros(len(words), np.int64)
        offsets = np.frombuffer(ends, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
        each = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        self._grown(len(each) + 1)
        sums = np.zeros(len(each) + 1, np.uint64)
        np.cumsum(each * self._up[: len(each)], out=sums[1:])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) * self._down[offsets[:-1]], np.diff(offsets)

    def joined(self, first: np.ndarray, size: np.ndarray, then: np.ndarray) -> np.ndarray:
        """The hash of two words put together, the first one of ``size`` bytes."""
        return first + self.power(size) * then


class Held:
    """Distinct words in the order of their hashes, with other columns of their table."""

    def __init__(self, table: pa.Table):
        words = table.column(0).combine_chunks()
        words = words if isinstance(words, pa.Array) else pa.concat_arrays(words.chunks or [pa.array([], pa.string())])
        for k in range(8):
            self.hashes = Hashes((_BASE * (2 * k + 1)) % (1 << 64))
            each = [self.hashes.of(words.slice(i, _AT_ONCE))[0] for i in range(0, len(words), _AT_ONCE)]
            hashed = np.concatenate(each) if each else np.zeros(0, np.uint64)
            order = np.argsort(hashed, kind="stable")
            self.sorted = hashed[order]
            if not len(words) or (self.sorted[1:] != self.sorted[:-1]).all():
                break
        else:
            raise ValueError("a word stands twice in a table, or two words have one hash")
        self.words = words.take(pa.array(order))
        self.columns = {c: table.column(c).take(pa.array(order)).combine_chunks() for c in table.column_names[1:]}

    def at(self, hashed: np.ndarray) -> np.ndarray:
        """Where words with these hashes may be; -1 where none has it."""
        if not len(self.sorted):
            return np.full(len(hashed), -1)
        at = np.minimum(np.searchsorted(self.sorted, hashed), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashed, at, -1)

    def same(self, at: np.ndarray, words: pa.Array) -> np.ndarray:
        """Whether the words at these places are the given ones."""
        return pc.equal(self.words.take(pa.array(at)), words).to_numpy(zero_copy_only=False)

    def find(self, words: pa.Array, hashed: np.ndarray | None = None) -> np.ndarray:
        """Each word's place in the table, or -1."""
        at = self.at(self.hashes.of(words)[0] if hashed is None else hashed)
        some = np.flatnonzero(at >= 0)
        at[some[~self.same(at[some], words.take(pa.array(some)))]] = -1
        return at


def held(words: DataFrame):
    """A broadcast of a table of distinct words, its first column."""
    return words.sparkSession.sparkContext.broadcast(Held(words.toArrow()))


def one_after_another(*words: pa.Array) -> pa.Array:
    """Words of several arrays; empty ones that Spark sends may lack offsets."""
    return pa.concat_arrays([x for x in words if len(x)] or [pa.array([], pa.string())])


class Looked:
    """The distinct words of a slice as a table with ``m`` has them: their ``m``, letters, hashes and bytes."""

    def __init__(self, table: Held, words: pa.Array):
        self.table, self.words = table, words
        self.hashed, self.size = table.hashes.of(words)
        self.bits = np.r_[table.columns["m"].to_numpy(zero_copy_only=False), 0].astype(np.int64)
        self.m = self.bits[table.find(words, self.hashed)]
        self.letters = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)

    def made(self, hashed: np.ndarray, parts: list[np.ndarray], bit: int) -> tuple[np.ndarray, pa.Array]:
        """Which words of these hashes, made of these parts, have a bit in the table; and they themselves."""
        at = self.table.at(hashed)
        some = np.flatnonzero(self.bits[at] & bit)
        words = pc.binary_join_element_wise(*(self.words.take(pa.array(p[some])) for p in parts), "")
        same = self.table.same(at[some], words)
        return some[same], words.filter(pa.array(same))


def runs(x: Looked, code: np.ndarray, line: np.ndarray, most: int, shortest: int, bit: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Where runs of up to ``most`` words of a line begin that make a word with a bit in the table, how many words they have,
    and what they make: from left to right, the longest first, without overlap.

    Some word of a run isn't known; all have two letters, those that aren't known three, and ``shortest`` together.
    """
    letters, odd = x.letters[code], (x.m & KNOWN)[code] == 0
    fit = (letters >= 2) & ((letters >= 3) | ~odd)
    total, fits, some, hashed, size = letters, fit, odd, x.hashed[code], x.size[code]
    none = np.zeros(0, np.int64)
    first, count, put = [none], [none], []
    for n in range(2, most + 1):  # words from each place on, in the same line
        k = len(code) - n + 1
        if k <= 0:
            break
        hashed = x.table.hashes.joined(hashed[:k], size[:k], x.hashed[code[n - 1 :]])
        size, total = size[:k] + x.size[code[n - 1 :]], total[:k] + letters[n - 1 :]
        fits, some = fits[:k] & fit[n - 1 :] & (line[:k] == line[n - 1 :]), some[:k] | odd[n - 1 :]
        at = np.flatnonzero(fits & some & (total >= shortest))
        found, made = x.made(hashed[at], [code[at + j] for j in range(n)], bit)
        first.append(at[found])
        count.append(np.full(len(found), n))
        put.append(made)
    first, count = np.concatenate(first), np.concatenate(count)
    free, kept = 0, []
    order = np.lexsort((-count, first))
    for k, at, n in zip(order.tolist(), first[order].tolist(), count[order].tolist()):
        if at >= free:
            free = at + n
            kept.append(k)
    kept = np.array(kept, np.int64)
    return first[kept], count[kept], one_after_another(*put).take(pa.array(kept))
