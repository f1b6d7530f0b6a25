"""Pairs of words at one or two edits, for a batch of words at once.

Two words that near have a form in common that is left when as many letters are taken out. Forms are made as hashes, from
sums over the letters before and behind a gap, and none as text; words meet by them and are then compared. An edit is a
letter more, less or another one, or a swap of neighbours; no place is edited twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lookup import _BASE, _powers

# Forms that are made at once, and letters of words that are compared at once.
_FORMS, _LETTERS = 1 << 18, 1 << 20


class _Letters:
    """The letters of some words, one after another."""

    def __init__(self, words: pa.Array):
        text = "".join(words.to_pylist()) if len(words) < 2 else pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "")[0].as_py()
        self.size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        self.each, self.begin = np.frombuffer(text.encode("utf-32-le"), np.uint32), np.cumsum(self.size) - self.size

    def of(self, some: np.ndarray) -> np.ndarray:
        """Rows of letters: the first ones of some words, the second ones, and on, 0 behind a word's end."""
        n = np.arange(self.size[some].max())[:, None]
        at = np.minimum(self.begin[some] + n, max(0, len(self.each) - 1))
        return np.where(n < self.size[some], self.each[at], 0) if len(self.each) else np.zeros(at.shape, np.uint32)


def forms(words: pa.Array, edits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Some words by number, and the hashes of what is left of each when up to ``edits`` letters are taken out."""
    letters = _Letters(words)
    back, twice = (np.uint64(pow(_BASE, -k, 1 << 64)) for k in (1, 2))
    for n in np.unique(letters.size).tolist():
        own, up = np.flatnonzero(letters.size == n), _powers(_BASE, n)
        i, j = np.triu_indices(n, 1) if edits > 1 else (np.zeros(0, np.int64),) * 2
        step = max(1, _FORMS // (1 + n + len(i)))
        for k in range(0, len(own), step):
            part = own[k : k + step]
            sums = np.zeros((len(part), n + 1), np.uint64)
            if n:
                np.cumsum(letters.of(part).T * up[:n], axis=1, out=sums[:, 1:])
            whole = sums[:, n:]
            keys = [whole, sums[:, :n] + (whole - sums[:, 1:]) * back]
            if len(i):
                keys.append(sums[:, i] + (sums[:, j] - sums[:, i + 1]) * back + (whole - sums[:, j + 1]) * twice)
            keys = np.sort(np.hstack(keys), axis=1)
            new = np.ones(keys.shape, bool)
            new[:, 1:] = keys[:, 1:] != keys[:, :-1]
            yield np.repeat(part, new.sum(axis=1)), keys[new].view(np.int64)


def distances(a: pa.Array, b: pa.Array, most: int) -> np.ndarray:
    """Edits between words, or ``most`` + 1 for more: the diagonals around the main one, a letter of all words at once."""
    one, two = _Letters(a), _Letters(b)
    n, m = one.size, two.size
    out = np.full(len(n), most + 1, np.uint8)
    near = np.flatnonzero(np.abs(n - m) <= most)
    near = near[np.argsort(np.maximum(n, m)[near], kind="stable")]
    begin = 0
    while begin < len(near):
        # as many as fit, by the longest of them; one at least
        longest = np.maximum(n, m)[near[begin : begin + _LETTERS]]
        fit = int(np.searchsorted(np.arange(1, len(longest) + 1) * (longest + 1), _LETTERS, "right"))
        part = near[begin : begin + max(1, fit)]
        begin += len(part)
        out[part] = _banded(one.of(part), two.of(part), n[part], m[part], most)
    return out


def _banded(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, most: int) -> np.ndarray:
    far, width = np.uint8(most + 1), 2 * most + 1
    out = np.full(a.shape[1], far)
    rows: list[np.ndarray] = []
    for i in range(int(n.max()) + 1):
        row = np.full((width, a.shape[1]), far)
        for k in range(width):
            j = i + k - most
            if j < 0 or j > b.shape[0]:
                continue
            if not i or not j:
                row[k] = min(i + j, most + 1)
                continue
            best = rows[-1][k] + (a[i - 1] != b[j - 1])
            if k + 1 < width:
                np.minimum(best, rows[-1][k + 1] + 1, out=best)
            if k:
                np.minimum(best, row[k - 1] + 1, out=best)
            if i > 1 and j > 1:
                np.minimum(best, np.where((a[i - 1] == b[j - 2]) & (a[i - 2] == b[j - 1]), rows[-2][k] + 1, far), out=best)
            row[k] = np.minimum(best, far)
        rows = [*rows[-1:], row]
        done = np.flatnonzero(n == i)
        out[done] = row[m[done] - i + most, done]
    return out


#: Bits of a sieve's part, by their logarithm, bits for each key, and parts at the most: 64 MB in all.
_PART, _EACH, _PARTS = 20, 16, 1 << 9
_ONE, _TWO = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def _sifted(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each key's part of a sieve, and its two bits there."""
    one, two = (keys.view(np.uint64) * x for x in (_ONE, _TWO))
    low = np.uint64(64 - _PART)
    return ((one & np.uint64(0xFFFFFFFF)) % np.uint64(parts)).astype(np.int64), (one >> low).astype(np.int64), (two >> low).astype(np.int64)


class Sieve:
    """Bits that say of a key that a table doesn't have it, or that it may."""

    def __init__(self, parts: dict[int, bytes], n: int):
        self.bits = np.zeros((n, 1 << (_PART - 3)), np.uint8)
        for k, bits in parts.items():
            self.bits[k] = np.frombuffer(bits, np.uint8)

    def passes(self, keys: np.ndarray) -> np.ndarray:
        part, *both = _sifted(keys, len(self.bits))
        one, two = (self.bits[part, at >> 3] >> (at & 7) & 1 for at in both)
        return (one & two) > 0


def sieve(keys: DataFrame, n: int):
    """A broadcast sieve of some ``n`` keys (key), each part of it put together by one task."""
    parts = min(_PARTS, 1 + n * _EACH // (1 << _PART))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, one, two = _sifted(b.column(0).to_numpy(), parts)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(one << _PART | two)], names=["part", "both"])

    def put(t: pa.Table) -> pa.Table:
        both, bits = t.column("both").to_numpy(), np.zeros(1 << _PART, np.uint8)
        bits[both >> _PART] = bits[both & (1 << _PART) - 1] = 1
        return pa.table({"part": t.column("part").slice(0, 1), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    rows = keys.select("key").mapInArrow(dealt, "part int, both long").groupBy("part").applyInArrow(put, "part int, bits binary").toArrow().to_pylist()
    return keys.sparkSession.sparkContext.broadcast(Sieve({r["part"]: r["bits"] for r in rows}, parts))


def near(unknown: DataFrame, known: DataFrame, edits: int) -> DataFrame:
    """(tok, candidate, freq, d) of ``unknown`` (tok) and ``known`` (tok, freq) at up to ``edits`` edits, one at least.

    Most forms of unknown words are no known word's: they are sifted before anything is shuffled.
    """
    n = F.length("tok")
    some = known.agg(F.max(n).alias("longest"), F.sum(1 + n + (n * (n - 1) / 2 if edits > 1 else 0)).alias("forms")).first()
    unknown = unknown.select("tok").filter(n <= (some.longest or 0) + edits).distinct()

    def keyed(words: DataFrame, sifted=None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at, keys in forms(b.column(0), edits):
                    if sifted is not None:
                        left = sifted.value.passes(keys)
                        at, keys = at[left], keys[left]
                    at = pa.array(at)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), *(b.column(c).take(at) for c in columns)], names=["key", *columns])

        columns = words.columns
        # a few words are many forms: they are made by all tasks
        words = words.repartition(words.sparkSession.sparkContext.defaultParallelism, columns[0])
        return words.mapInArrow(run, T.StructType([T.StructField("key", T.LongType()), *words.schema]))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = distances(b.column(0), b.column(1), edits)
            at = pa.array(np.flatnonzero((d > 0) & (d <= edits)))
            yield pa.RecordBatch.from_arrays([*(c.take(at) for c in b.columns), pa.array(d, pa.int32()).take(at)], names=schema.names)

    right = keyed(known.select(F.col("tok").alias("candidate"), "freq"))
    left = keyed(unknown, sieve(right, int(some.forms or 0)))
    pairs = left.join(right.hint("merge"), "key").select("tok", "candidate", "freq")
    schema = T.StructType([*pairs.schema, T.StructField("d", T.IntegerType())])
    return pairs.mapInArrow(compared, schema).distinct()
