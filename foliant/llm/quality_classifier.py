"""A quality classifier: naive Bayes support vectors.

A text's features are indicators of its character n-grams (2 to 4 characters, hashed to ``FEATURES`` slots) and of
word pairs that repeat one word. Each
indicator is scaled by the class log-count ratio of its n-gram, and the scaled vector to length one. A linear model
with hinge loss is fitted by dual coordinate descent; two half-fits give margins on texts that they haven't seen, and
a logistic curve through these turns margins into scores.

The fit takes at most ``sample_rows`` labelled rows, those with the least hash of their id; scoring covers every
text as a whole. Only the text enters a score.

Defined cases: a null or empty text has no n-grams and scores as the curve says at the model's offset; ids with
several labels count with the least of them; null labels don't count; without labels of both classes each score is
the share of label 1, or 0.5 without any label; a null id is never a training row and is not held out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import picked, removed, rowwise, sliced, written

FEATURES = 1 << 16
SIZES = (2, 3, 4)
#: Indicators for so many word pairs, or more, of a word and itself.
REPEATS = (2, 4, 8)
#: Labelled rows in a fit.
SAMPLE_ROWS = 6_000
#: Bytes of slots that are fitted, two for each.
SAMPLE_BYTES = 64 << 20
COST = 1.0
ROUNDS = 12
SMOOTH = 1.0
THRESHOLD = 0.3

_MIX = np.uint64(0x9E3779B97F4A7C15)


def slots(text: str | None) -> np.ndarray:
    """The sorted feature slots of a text's n-grams."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    on = np.zeros(FEATURES, bool)
    with np.errstate(over="ignore"):
        for n in SIZES:
            if len(codes) < n:
                break
            h = np.full(len(codes) - n + 1, n, np.uint64)
            for k in range(n):
                h = (h + codes[k : len(codes) - n + 1 + k]) * _MIX
            on[h >> np.uint64(48)] = True
    words = (text or "").split()
    again = sum(map(eq, words, words[1:]))
    for k, least in enumerate(REPEATS):
        if again >= least:
            on[k] = True
    return np.flatnonzero(on).astype(np.int32)


@dataclass(frozen=True)
class Model:
    """score = logistic(slope * margin + offset), the margin a weighted mean over a text's features."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, on: np.ndarray) -> float:
        r = self.ratio[on]
        length = float(np.sqrt(r @ r))
        return (float(r @ self.weight[on]) / length if length else 0.0) + self.bias

    def score(self, text: str | None) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * self.margin(slots(text)) + self.offset, -30, 30))))


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """The log of the smoothed share of each indicator among label 1 over that among label 0."""
    up, down = (np.full(FEATURES, SMOOTH) for _ in range(2))
    for on, label in zip(rows, y):
        (up if label > 0 else down)[on] += 1
    return np.log(up / (2 * SMOOTH + (y > 0).sum())) - np.log(down / (2 * SMOOTH + (y < 0).sum()))


def dual_coordinate_descent(rows: list[np.ndarray], values: Sequence[np.ndarray], y: np.ndarray, cost: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise half the squared norm plus ``cost`` times the hinge losses."""
    w, bias, alpha = np.zeros(FEATURES), 0.0, np.zeros(len(rows))
    norm = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            v = values[i]
            gradient = y[i] * (w[rows[i]] @ v + bias) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[rows[i]] += step * v
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w, bias


class Scaled(Sequence):
    """Each row's ratios at length 1, computed when asked for: the driver holds slots and no values."""

    def __init__(self, rows: list[np.ndarray], ratio: np.ndarray):
        self.rows, self.ratio = rows, ratio

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> np.ndarray:
        r = self.ratio[self.rows[i]]
        return r / max(np.sqrt(r @ r), 1e-12)


def _fit_linear(rows: list[np.ndarray], y: np.ndarray, cost: float, rounds: int) -> tuple[np.ndarray, np.ndarray, float]:
    ratio = log_count_ratio(rows, y)
    w, b = dual_coordinate_descent(rows, Scaled(rows, ratio), y, np.full(len(y), cost), rounds)
    return ratio, w, b


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = COST, rounds: int = ROUNDS) -> Model:
    """A model from feature slots and labels 0 or 1."""
    zero = np.zeros(FEATURES)
    share = (labels.sum() + 1) / (len(labels) + 2) if len(labels) else 0.5
    if min((labels == 1).sum(), (labels == 0).sum()) < 2:
        return Model(zero, zero, 0.0, 1.0, float(np.log(share / (1 - share))))
    y = np.where(labels == 1, 1.0, -1.0)
    margins = np.zeros(len(y))
    half = np.zeros(len(y), int)
    for c in (-1.0, 1.0):
        own = np.flatnonzero(y == c)
        half[own] = np.arange(len(own)) % 2
    for h in (0, 1):
        fold, rest = np.flatnonzero(half != h), np.flatnonzero(half == h)
        ratio, w, b = _fit_linear([rows[i] for i in fold], y[fold], cost, rounds)
        part = Model(ratio, w, b, 1.0, 0.0)
        margins[rest] = [part.margin(rows[i]) for i in rest]
    slope, offset = _logistic_curve(margins, labels.astype(float))
    ratio, w, b = _fit_linear(rows, y, cost, rounds)
    return Model(ratio, w, b, slope, offset)


def _logistic_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, with targets drawn in from 0 and 1 by the class sizes."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((p - t) * x).sum() + 1e-3 * a, (p - t).sum()])
        v = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(v * x * x).sum() + 1e-3, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-6]])
        s = np.linalg.solve(h, g)
        a, b = a - np.clip(s[0], -5, 5), b - np.clip(s[1], -5, 5)
        if abs(s).max() < 1e-8:
            break
    return float(a), float(b)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """A model from labelled rows that aren't held out.

    At most ``sample_rows`` ids are fitted, those with the least hashes; of ids with several texts, the one whose slots
    are least. Of these, in the order of hashes, as many are taken as have ``sample_bytes`` of slots together. Both
    bounds are of what is fitted only; every row is scored.
    """
    of = picked(labels, id=id_col, label=label_col).filter("id IS NOT NULL AND label IS NOT NULL").filter(~held_out(F.col("id")))
    chosen = of.groupBy("id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    # at most sample_rows ids and labels: a bounded side
    rows = picked(docs, id=id_col, text=text_col).join(F.broadcast(chosen), "id").select("id", "label", "text")
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("label", T.IntegerType()), T.StructField("slots", T.BinaryType())])
    features = rowwise(
        rows,
        schema,
        lambda: lambda b: {"id": b.column(0), "label": b.column(1).cast("int32"), "slots": [slots(t).astype("<u2").tobytes() for t in b.column(2).to_pylist()]},
    )
    features, path = written(features.groupBy("id", "label").agg(F.min("slots").alias("slots")).withColumn("hash", F.xxhash64("id")), "features")
    sizes = sorted(features.select("hash", F.length("slots").alias("bytes")).collect())  # at most sample_rows
    fits = np.cumsum([r.bytes for r in sizes]) <= sample_bytes
    last = sizes[fits.sum() - 1].hash if fits.any() else None
    got = sorted(features.filter(F.col("hash") <= F.lit(last).cast("long")).collect(), key=lambda r: (r.hash, r.id))
    removed(docs.sparkSession, path)
    return fit([np.frombuffer(r.slots, "<u2") for r in got], np.array([r.label for r in got], int))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """A row for each row of ``docs``: id, ``held_out``, ``score`` and ``predicted``."""
    rows = picked(docs, id=id_col, text=text_col)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("score", T.DoubleType())])

    def build():
        m = shared.value
        return lambda b: {"id": b.column(0), "score": [m.score(t) for t in b.column(1).to_pylist()]}

    return rowwise(rows, schema, build).select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"),
    )


def kept(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            for b in sliced(batch):
                yield b.filter(pa.array([m.score(t) >= threshold for t in b.column(at).to_pylist()], pa.bool_()))

    at = docs.columns.index(text_col)
    return docs.mapInArrow(run, docs.schema)
