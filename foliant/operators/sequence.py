"""Ordinals in reading order: gaps, anchors, fills, clusters and breaks.

Inputs are streams of acts: a volume, a position (0-based, total order within the volume), a number read for the
act, and whether it is trusted. All window functions run within a volume. Greedy rules, where each decision depends on
the one before, run over sorted rows with a small state; only the longest chain and the robust line hold a volume's
numbers.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

BRACKET_MARGIN = 2
ONE_SIDED_MARGIN = 6


def _before(key: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _after(key: Sequence[str], order: Sequence[str]):
    """The rows after each, the nearest last: a frame that grows. One that shrinks is read anew for each row."""
    return Window.partitionBy(*key).orderBy(*(F.desc(c) for c in order)).rowsBetween(Window.unboundedPreceding, -1)


def ordinals(df: DataFrame, key: Sequence[str], order: Sequence[Column | str], name: str = "ordinal") -> DataFrame:
    """0-based ordinals in an explicit total order."""
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1).cast("long"))


def missing(have: DataFrame, totals: DataFrame, key: str, n: str, total: str) -> DataFrame:
    """(key, n) of 1 to the key's total that ``have`` lacks."""
    want = totals.filter(F.col(total) >= 1).select(key, F.explode(F.sequence(F.lit(1).cast("long"), F.col(total).cast("long"))).alias(n))
    return want.join(have.select(key, F.col(n).cast("long").alias(n)).distinct(), [key, n], "left_anti")


def islands(numbers: DataFrame, key: str, n: str) -> DataFrame:
    """Runs of consecutive numbers: (key, run_start, run_end, run_length)."""
    by = Window.partitionBy(key).orderBy(n)
    runs = numbers.select(key, n).distinct().withColumn("run_", F.col(n) - F.row_number().over(by))
    return runs.groupBy(key, "run_").agg(
        F.min(n).alias("run_start"), F.max(n).alias("run_end"), F.count("*").cast("long").alias("run_length")
    ).drop("run_")


def neighbours(stream: DataFrame, key: Sequence[str], order: Sequence[str], trusted: Column, values: Sequence[str]) -> DataFrame:
    """The nearest trusted row before and after each row: ``prev_<v>`` and ``next_<v>`` for each of ``values``."""
    one = F.when(trusted, F.struct(*values))
    out = stream.withColumns(
        {
            "p_": F.last(one, ignorenulls=True).over(_before(key, order)),
            "n_": F.last(one, ignorenulls=True).over(_after(key, order)),
        }
    )
    return out.select("*", *(F.col(f"p_.{v}").alias(f"prev_{v}") for v in values), *(F.col(f"n_.{v}").alias(f"next_{v}") for v in values)).drop("p_", "n_")


def brackets(have: DataFrame, lost: DataFrame, key: str, n: str, page: str) -> DataFrame:
    """Pages to look for each missing number, from the nearest present numbers below and above.

    ``have``: one row for each (key, n). With both neighbours the pages between them and ``BRACKET_MARGIN`` more on
    either side; with one, ``ONE_SIDED_MARGIN`` and the run's length. ``implausible``: the run has more numbers than
    there are pages.
    """
    runs = islands(lost, key, n)
    numbered = runs.select(key, F.explode(F.sequence("run_start", "run_end")).alias(n), "run_length")
    stream = have.select(key, n, page, F.lit(None).cast("long").alias("run_length"), F.lit(True).alias("present")).unionByName(
        numbered.select(key, n, F.lit(None).cast(have.schema[page].dataType).alias(page), "run_length", F.lit(False).alias("present"))
    )
    near = neighbours(stream, [key], [n], F.col("present"), [n, page]).filter(~F.col("present"))
    lo, hi = F.col(f"prev_{page}"), F.col(f"next_{page}")
    both = lo.isNotNull() & hi.isNotNull()
    run = F.col("run_length")
    return near.select(
        key,
        n,
        F.col(f"prev_{n}").alias("lo"),
        F.col(f"next_{n}").alias("hi"),
        F.when(both, F.greatest(F.lit(1), F.least(lo, hi) - BRACKET_MARGIN)).when(lo.isNotNull(), lo).when(hi.isNotNull(), F.greatest(F.lit(1), hi - ONE_SIDED_MARGIN - run)).alias("first_page"),
        F.when(both, F.greatest(lo, hi) + BRACKET_MARGIN).when(lo.isNotNull(), lo + ONE_SIDED_MARGIN + run).when(hi.isNotNull(), hi).alias("last_page"),
        F.coalesce(both & (F.abs(hi - lo) < run), F.lit(False)).alias("implausible"),
    )


def records(stream: DataFrame, key: Sequence[str], order: Sequence[str], n: str) -> DataFrame:
    """Rows above all before them: what a greedy filter to increasing numbers keeps."""
    best = F.max(n).over(_before(key, order))
    return stream.withColumn("best_", best).filter(F.col("best_").isNull() | (F.col(n) > F.col("best_"))).drop("best_")


def _sorted_runs(rows: DataFrame, key: Sequence[str], order: Sequence[Column | str], schema: T.StructType, state: Callable[[], Callable[..., object]], inputs: Sequence[str]) -> DataFrame:
    """``rows`` with one more column, computed in order by a function that ``state`` makes anew for each key.

    The first columns of ``schema`` are the key's, the last is the new one. Rows are sorted by key in tasks and stream through: what is held is a batch and what the function remembers.
    """
    columns, n = [f.name for f in schema.fields[:-1]], len(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_now, step = object(), None
        for b in batches:
            keys, out = zip(*(b.column(k).to_pylist() for k in range(n))), []
            for k, *values in zip(keys, *(b.column(columns.index(c)).to_pylist() for c in inputs)):
                if step is None or k != key_now:
                    key_now, step = k, state()
                out.append(step(*values))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, to_arrow_type(schema.fields[-1].dataType))], names=schema.names)

    return rows.select(*columns).repartition(*key).sortWithinPartitions(*key, *order).mapInArrow(run, schema)


def span_end(acts: DataFrame, key: str, order: Sequence[str], page: str) -> DataFrame:
    """``end_page``: the first later page that is greater, else the act's own.

    From the last act to the first, a stack holds the later pages that no page before them hides.
    """

    def state() -> Callable[..., object]:
        stack: list = []

        def step(p):
            if p is None:
                return None
            while stack and stack[-1] <= p:
                stack.pop()
            end = stack[-1] if stack else p
            stack.append(p)
            return end

        return step

    others = [f for f in acts.schema.fields if f.name not in key]
    schema = T.StructType([*(acts.schema[k] for k in key), *others, T.StructField("end_page", acts.schema[page].dataType)])
    return _sorted_runs(acts, key, [F.desc(c) for c in order], schema, state, [page])


def gap_fill(
    stream: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    n: str,
    anchor: Column,
    *,
    total: str | None = None,
    conflict: Column | None = None,
) -> DataFrame:
    """``filled`` and ``status`` (anchor, filled, ambiguous) of each row.

    The rows between two anchors are filled in order if there are as many as numbers between the anchors' numbers;
    before the first anchor the numbers from 1 on count, after the last those up to ``total``, if given. A
    ``conflict`` in a gap leaves the whole gap ambiguous.
    """
    marked = stream.withColumn("anchor_", F.coalesce(anchor, F.lit(False)))
    marked = marked.withColumn("gap_", F.sum(F.col("anchor_").cast("long")).over(Window.partitionBy(*key).orderBy(*order)))
    near = neighbours(marked, key, order, F.col("anchor_"), [n])
    gap = Window.partitionBy(*key, "gap_", "anchor_")
    rank = F.row_number().over(gap.orderBy(*order))
    lo = F.when(F.col(f"prev_{n}").isNull() & F.col(f"next_{n}").isNotNull(), 0).otherwise(F.col(f"prev_{n}"))
    above = F.col(total) + 1 if total else F.lit(None).cast("long")
    hi = F.when(F.col(f"next_{n}").isNull() & F.col(f"prev_{n}").isNotNull(), above).otherwise(F.col(f"next_{n}"))
    near = near.withColumns({"rank_": rank, "rows_": F.count("*").over(gap), "lo_": lo, "hi_": hi})
    fits = F.col("hi_") - F.col("lo_") - 1 == F.col("rows_")
    if conflict is not None:
        near = near.withColumn("bad_", F.max(F.coalesce(conflict, F.lit(False))).over(gap))
        fits = fits & ~F.col("bad_")
    fits = F.coalesce(fits, F.lit(False))
    out = near.withColumns(
        {
            "filled": F.when(F.col("anchor_"), F.col(n)).when(fits, F.col("lo_") + F.col("rank_")).cast("long"),
            "status": F.when(F.col("anchor_"), "anchor").when(fits, "filled").otherwise("ambiguous"),
        }
    )
    return out.select(*stream.columns, "filled", "status")


def reconstruct(stream: DataFrame, key: Sequence[str], pos: str, n: str, clean: Column) -> DataFrame:
    """``filled``: the number of an unclean row between clean neighbours whose numbers and positions differ alike."""
    near = neighbours(stream, key, [pos], clean, [pos, n])
    same = F.col(f"next_{n}") - F.col(f"prev_{n}") == F.col(f"next_{pos}") - F.col(f"prev_{pos}")
    return near.withColumn("filled", F.when(~clean & same, F.col(f"prev_{n}") + F.col(pos) - F.col(f"prev_{pos}"))).drop(
        *(f"{side}_{v}" for side in ("prev", "next") for v in (pos, n))
    )


def five_tiers(stream: DataFrame, key: Sequence[str], pos: str, n: str, raw: str, clean: Column) -> DataFrame:
    """``tier`` and ``corrected`` of rows that aren't clean, from the clean rows on either side and the number read."""
    near = neighbours(stream, key, [pos], clean, [pos, n]).filter(~clean)
    a, b, read = F.col(f"prev_{n}"), F.col(f"next_{n}"), F.col(n)
    step = F.col(pos) - F.col(f"prev_{pos}")
    up = a + step
    down = b - (F.col(f"next_{pos}") - F.col(pos))
    both, left, right = a.isNotNull() & b.isNotNull(), a.isNotNull() & b.isNull(), a.isNull() & b.isNotNull()
    fill = F.when(both & (b <= a), F.lit(None)).when(a.isNotNull(), up).when(right, down)
    digits = F.regexp_replace(F.col(raw), "[^0-9]", "")
    one_less = F.when(
        F.length(digits) > 1,
        F.exists(F.sequence(F.lit(1), F.length(digits)), lambda i: F.concat(F.substring(digits, F.lit(1), i - 1), F.substring(digits, i + 1, F.length(digits))) == fill.cast("string")),
    ).otherwise(False)
    tier = (
        F.when(both & (b > a) & (b - a == F.col(f"next_{pos}") - F.col(f"prev_{pos}")), "AUTO")
        .when(both & (b <= a), "REVIEW")
        .when(both & (up == read) & (up < b), "CONFIRMED")
        .when(both & (a < read) & (read < b), "OCR_PLAUSIBLE")
        .when(left & (up == read), "CONFIRMED")
        .when(left & (read > a), "OCR_PLAUSIBLE")
        .when(right & (down > 0) & (down == read), "CONFIRMED")
        .when(right & (read > 0) & (read < b), "OCR_PLAUSIBLE")
        .when(fill.isNotNull() & one_less, "MODERN_DIGITFIX")
        .otherwise("REVIEW")
    )
    out = near.withColumn("tier", tier)
    return out.withColumn(
        "corrected", F.when(F.col("tier").isin("AUTO", "MODERN_DIGITFIX"), fill).when(F.col("tier") != "REVIEW", read).cast("long")
    ).select(*stream.columns, "tier", "corrected")


def certify_unique(acts: DataFrame, key: str, witnesses: str, totals: DataFrame, total: str) -> DataFrame:
    """``certified``: the one number that all witnesses of an act agree on, in range and claimed by one act alone."""
    agreed = F.array_distinct(F.array_compact(F.col(witnesses)))
    one = acts.withColumn("n_", F.when(F.size(agreed) == 1, agreed[0])).join(totals.select(key, total), key, "left")
    one = one.withColumn("n_", F.when(F.col("n_").between(1, F.coalesce(F.col(total), F.col("n_"))), F.col("n_")))
    claims = F.count("n_").over(Window.partitionBy(key, "n_"))
    return one.withColumn("certified", F.when(claims == 1, F.col("n_"))).drop("n_", total)


def upper_median(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """(key, name): of each key's sorted values the one at half their count, by rank; no list is gathered."""
    ranked = rows.select(key, value).withColumns(
        {"r_": F.row_number().over(Window.partitionBy(key).orderBy(value)), "n_": F.count("*").over(Window.partitionBy(key))}
    )
    return ranked.filter(F.col("r_") == F.floor(F.col("n_") / 2) + 1).select(key, F.col(value).alias(name))


def breaks(stream: DataFrame, key: str, order: Sequence[str], n: str, factor: int = 5, least: int = 30) -> DataFrame:
    """``step`` and ``is_break``: whether a step is over ``factor`` times the key's upper-median step and ``least``."""
    by = Window.partitionBy(key).orderBy(*order)
    steps = stream.withColumn("step", F.col(n) - F.lag(n).over(by))
    typical = upper_median(steps.filter("step <> 0").select(key, F.abs("step").alias("s_")), key, "s_", "typical")
    return steps.join(typical, key, "left").withColumn(
        "is_break", F.coalesce(F.col("step") > F.greatest(factor * F.col("typical"), F.lit(least)), F.lit(False))
    )


def contiguous_top(numbers: DataFrame, key: str, n: str, tolerance: int = 15, trim: int = 5) -> DataFrame:
    """(key, top): the top of the run that starts at the least number, after lone high values are trimmed off."""
    by = Window.partitionBy(key).orderBy(n)
    step = F.col(n) - F.lag(n).over(by)
    one = numbers.select(key, n).distinct().withColumn("step_", step)
    one = one.withColumn("broken_", F.sum(F.when(F.col("step_") > tolerance, 1).otherwise(0)).over(by)).filter("broken_ = 0")
    return one.filter(F.col("step_").isNull() | (F.col("step_") <= trim)).groupBy(key).agg(F.max(n).alias("top"))


def primary_cluster(numbers: DataFrame, key: str, n: str, tolerance: int = 1000, ratio: float = 2.5) -> DataFrame:
    """(key, lo, hi, size, outliers) of the largest cluster of numbers; the first of equal ones."""
    by = Window.partitionBy(key).orderBy(n)
    one = numbers.select(key, n).distinct().withColumn("step_", F.col(n) - F.lag(n).over(by))
    one = one.withColumn("cluster_", F.sum(F.when(F.col("step_") > tolerance, 1).otherwise(0)).over(by))
    sizes = one.groupBy(key, "cluster_").agg(F.min(n).alias("lo"), F.max(n).alias("hi"), F.count("*").alias("size"))
    best = sizes.groupBy(key).agg(F.max_by(F.struct("lo", "hi", "size"), F.struct("size", -F.col("lo"))).alias("b")).select(key, "b.*")
    out = one.join(best, key).groupBy(key, "lo", "hi", "size").agg(F.sum(F.when(F.col(n) > F.col("hi") * ratio, 1).otherwise(0)).alias("outliers"))
    return out


def supported_ceiling(numbers: DataFrame, key: str, n: str) -> DataFrame:
    """(key, ceiling): the greatest number with one or two below it present, or 1; else the greatest."""
    one = numbers.select(key, n).distinct()
    by = Window.partitionBy(key).orderBy(n)
    step = F.col(n) - F.lag(n).over(by)
    ok = (F.col("step_") <= 2) | (F.col(n) == 1)
    return one.withColumn("step_", step).groupBy(key).agg(F.coalesce(F.max(F.when(ok, F.col(n))), F.max(n)).alias("ceiling"))


def sessions(points: DataFrame, boundaries: DataFrame, key: str, at: str, label: str) -> DataFrame:
    """``points`` with the label of the last boundary at or before them: one sort of both, no range join."""
    both = points.withColumns({label: F.lit(None).cast(boundaries.schema[label].dataType), "side_": F.lit(1)}).unionByName(
        boundaries.select(key, at, label).withColumn("side_", F.lit(0)), allowMissingColumns=True
    )
    by = Window.partitionBy(key).orderBy(at, "side_").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn(label, F.last(label, ignorenulls=True).over(by)).filter("side_ = 1").drop("side_")


def first_run(stream: DataFrame, key: str, order: Sequence[str], flag: Column, length: int, value: str) -> DataFrame:
    """(key, start): ``value`` of the first row of the first ``length`` rows in a row that are flagged."""
    w = Window.partitionBy(key).orderBy(*order)
    frame = w.rowsBetween(0, length - 1)
    on = F.coalesce(flag, F.lit(False)).cast("int")
    out = stream.withColumns({"on_": F.sum(on).over(frame), "rows_": F.count("*").over(frame)})
    return out.filter((F.col("on_") == length) & (F.col("rows_") == length)).groupBy(key).agg(F.min(value).alias("start"))


def empty_windows(found: DataFrame, lengths: DataFrame, key: str, page: str, length: str, size: int = 75, step: int = 37) -> DataFrame:
    """(key, first_page, last_page) of merged windows of ``size`` pages, ``step`` apart, without any row of ``found``."""
    wide = lengths.filter(F.col(length) >= 1).select(key, length, F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col(length) - 1, F.lit(0)), F.lit(step).cast("long"))).alias("w_"))
    wide = wide.withColumn("to_", F.least(F.col("w_") + size, F.col(length)) - 1)
    # a page lies in the windows that begin within ``size`` pages before it: a bounded set of keys, so an equi join
    hits = found.select(key, F.explode(F.sequence(F.greatest(F.lit(0), F.ceil((F.col(page) - size + 1) / step)).cast("long"), F.floor(F.col(page) / step).cast("long"))).alias("k_"))
    bare = wide.withColumn("k_", (F.col("w_") / step).cast("long")).join(hits.distinct(), [key, "k_"], "left_anti")
    by = Window.partitionBy(key).orderBy("w_")
    grown = bare.withColumn("new_", F.when(F.col("w_") <= F.lag("to_").over(by) + 1, 0).otherwise(1))
    grown = grown.withColumn("run_", F.sum("new_").over(by))
    return grown.groupBy(key, "run_").agg(F.min("w_").alias("first_page"), F.max("to_").alias("last_page")).drop("run_")


# --- greedy rules: each decision depends on the one before ------------------------------------------------


def kept_by_gap(gap: int) -> Callable[[int, int], bool]:
    """Whether a value is at least ``gap`` after the last kept one."""
    last = None

    def step(_: int, v: int) -> bool:
        nonlocal last
        keep = last is None or v - last >= gap
        last = v if keep else last
        return keep

    return step


def pruned_chain(slack: int = 60) -> Callable[[int, int], bool]:
    """Whether a value rises by at most ``slack`` more than its position since the last kept one."""
    kept = None

    def step(p: int, v: int) -> bool:
        nonlocal kept
        keep = kept is None or v - kept[1] <= p - kept[0] + slack
        kept = (p, v) if keep else kept
        return keep

    return step


def split_runs() -> Callable[[int, int], int]:
    """A run number for each value; a run begins where a value of 5 or less falls over 2 below the run's greatest."""
    run, top = 0, None

    def step(_: int, v: int) -> int:
        nonlocal run, top
        if top is not None and v <= 5 and v < top - 2:
            run, top = run + 1, 0
        top = max(0 if top is None else top, v)
        return run

    return step


RULES = {"kept_by_gap": kept_by_gap, "pruned_chain": pruned_chain, "split_runs": split_runs}


def greedy(stream: DataFrame, key: str, pos: str, n: str, rule: str, **args) -> DataFrame:
    """(key, pos, n, kept or run) by one of ``RULES``: a volume's rows stream through with a state of a few numbers."""
    narrow = stream.select(key, F.col(pos).cast("long").alias(pos), F.col(n).cast("long").alias(n))
    last = T.StructField("run", T.LongType()) if rule == "split_runs" else T.StructField("kept", T.BooleanType())
    return _sorted_runs(narrow, [key], [pos, n], T.StructType([*narrow.schema.fields, last]), lambda: RULES[rule](**args), [pos, n])


# --- rules on all of a volume's numbers -------------------------------------------------------------------


def increasing_chain(values: Sequence[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence; of equal ones that with the least last values."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, v in enumerate(values):
        i = bisect_left(tails, v)
        tails[i : i + 1] = [v]
        at[i : i + 1] = [k]
        back.append(at[i - 1] if i else -1)
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(k)
        k = back[k]
    return out[::-1]


#: Slopes that are listed at once, and those that are drawn to narrow them down.
SLOPES_AT_ONCE, DRAWN = 1 << 20, 1 << 16


def _merged(values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """A merge sort's steps: places in blocks' sorted first halves, those in second halves, and for each of these where
    in the first ones those that are greater begin, or as great, and where its block's end."""
    n = len(values)
    rank = np.unique(values, return_inverse=True)[1].astype(np.int64)
    width = 1
    while width < n:
        block, second = np.arange(n) // (2 * width), (np.arange(n) // width) % 2 == 1
        key = block * n + rank
        left, right = np.flatnonzero(~second), np.flatnonzero(second)
        left = left[np.argsort(key[left], kind="stable")]
        stop = np.searchsorted(block[left], block[right], "right")
        yield left, right, np.searchsorted(key[left], key[right], "right"), stop
        width *= 2


def _inversions(values: np.ndarray, ranks: np.ndarray | None = None) -> np.ndarray:
    """The pairs of places (i, j), i < j, with values[j] < values[i]: all, or of these those with the given ranks."""
    pairs, before = [np.zeros((0, 2), np.int64)], 0
    for left, right, first, stop in _merged(values):
        many = stop - first
        ends = np.cumsum(many)
        own = np.arange(ends[-1]) if ranks is None else ranks[(ranks >= before) & (ranks < before + ends[-1])] - before
        j = np.searchsorted(ends, own, "right")
        pairs.append(np.c_[left[first[j] + own - ends[j] + many[j]], right[j]])
        before += int(ends[-1])
    return np.concatenate(pairs)


def upper_median_slope(x: np.ndarray, y: np.ndarray, at_once: int = SLOPES_AT_ONCE, drawn: int = DRAWN) -> float | None:
    """The upper median of the slopes of all pairs of whole points with different ``x``: exact, in n log^2 n steps.

    Of points in the order of x, a pair's slope is under p / q if q y - p x falls, so that pairs up to a slope are
    counted as inversions. Slopes drawn from those between two bounds give nearer bounds, until the rest can be listed.
    Coordinates are whole numbers whose products have 62 bits at the most.
    """
    order = np.lexsort((y, x))
    x, y = x[order].astype(np.int64), y[order].astype(np.int64)
    n = len(x)
    runs, same = np.unique(x, return_counts=True)[1], np.unique(np.c_[x, y], axis=0, return_counts=True)[1]
    choose = lambda k: int((k * (k - 1) // 2).sum())
    total, twice = n * (n - 1) // 2 - choose(runs), choose(same)
    if not total:
        return None
    rank = total // 2
    low = high = None  # slopes as fractions; the median's is over low and under high
    below, above = 0, total
    rng = np.random.default_rng(0)

    def counts(p: int, q: int) -> tuple[int, int]:
        """How many slopes are under p / q, and how many at most that. Equal points are as high at any slope."""
        values = q * y - p * x
        under = sum(int((stop - first).sum()) for _, _, first, stop in _merged(values))
        return under, under + choose(np.unique(values, return_counts=True)[1]) - twice

    def between(ranks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        # where pairs up to low are turned round, those under high are inversions
        first = np.arange(n) if low is None else np.lexsort((-np.arange(n), low[1] * y - low[0] * x))
        values = -np.arange(n) if high is None else (high[1] * y - high[0] * x)[first]
        i, j = first[_inversions(values, ranks)].T
        ahead = x[i] < x[j]
        return y[j[ahead]] - y[i[ahead]], x[j[ahead]] - x[i[ahead]]

    while above - below > at_once:
        most = n * (n - 1) // 2 if high is None else above - below
        dy, dx = between(np.unique(rng.integers(0, most, drawn)))
        if not len(dx):
            continue
        by_slope = np.argsort(dy / dx, kind="stable")
        middle, slack = len(dx) * (rank - below) / (above - below), 3 * np.sqrt(len(dx))
        for at in (middle - slack, middle, middle + slack):
            k = by_slope[int(np.clip(at, 0, len(dx) - 1))]
            p, q = int(dy[k]), int(dx[k])
            if (low and p * low[1] <= low[0] * q) or (high and p * high[1] >= high[0] * q):
                continue
            under, up_to = counts(p, q)
            if under <= rank < up_to:
                return p / q
            if up_to <= rank:
                low, below = (p, q), up_to
            else:
                high, above = (p, q), under
    dy, dx = between()
    return float(np.sort(dy / dx)[rank - below])


def robust_line(x: np.ndarray, y: np.ndarray, factor: float = 5.0, floor: float = 25.0) -> np.ndarray:
    """Which points lie near the Theil-Sen line: upper medians of slopes, offsets and absolute residuals."""
    n = len(x)
    if n < 6:
        return np.ones(n, bool)
    slope = upper_median_slope(x, y)
    if slope is None:
        return np.ones(n, bool)
    upper = lambda v: np.sort(v)[len(v) // 2]
    rest = y - slope * x
    rest = np.abs(rest - upper(rest))
    return rest <= max(factor * upper(rest), floor)


def chosen(stream: DataFrame, key: str, pos: str, n: str, rule: str) -> DataFrame:
    """(key, pos, n, kept) by ``increasing_chain`` or ``robust_line``, which look at all of a volume's numbers: a task
    holds 16 bytes for each of a volume's acts, of which a volume has thousands."""
    narrow = stream.select(key, F.col(pos).cast("long").alias(pos), F.col(n).cast("long").alias(n))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([pos, n], ignore_index=True)
        if rule == "robust_line":
            pdf["kept"] = robust_line(pdf[pos].to_numpy(float), pdf[n].to_numpy(float))
        else:
            pdf["kept"] = np.isin(np.arange(len(pdf)), increasing_chain(pdf[n].tolist()))
        return pdf

    fields = f"{key} {narrow.schema[key].dataType.simpleString()}, {pos} long, {n} long, kept boolean"
    return narrow.groupBy(key).applyInPandas(one, fields)


def checkpoint_fill(stream: DataFrame, key: str, pos: str, n: str, page: str, anchor: Column, checkpoints: DataFrame, pages: int = 2) -> DataFrame:
    """``filled`` and ``status`` of rows between anchors by counting boundaries, checked against ``checkpoints``.

    Rows between two anchors take the numbers between if there are as many. A checkpoint (key, n, page) is a number that
    something else places on a page: a gap with a checkpoint whose filled row is over ``pages`` pages away is not
    filled. ``strict`` where all of a gap's checkpoints hold and there is one at least, ``loose`` where it has none.
    """
    counted = gap_fill(stream, [key], [pos], n, anchor)
    gap = F.count(F.when(F.col("status") == "anchor", 1)).over(Window.partitionBy(key).orderBy(pos))
    known = checkpoints.groupBy(key, F.col(n).alias("filled")).agg(F.min(page).alias("lo_"), F.max(page).alias("hi_"))
    near = counted.withColumn("gap_", gap).join(known, [key, "filled"], "left")
    near = near.withColumn("holds_", F.when((F.col("status") == "filled") & F.col("lo_").isNotNull(), F.col(page).between(F.col("lo_") - pages, F.col("hi_") + pages)))
    verdicts = near.filter("status = 'filled'").groupBy(key, "gap_").agg(F.every("holds_").alias("all_"), F.count("holds_").alias("n_"))
    out = near.join(verdicts, [key, "gap_"], "left")
    fills = F.col("status") == "filled"
    status = F.when(fills & (F.col("n_") == 0), "loose").when(fills & F.col("all_"), "strict").when(fills, "rejected").otherwise(F.col("status"))
    out = out.withColumn("status", status)
    return out.select(*stream.columns, F.when(F.col("status").isin("strict", "loose", "anchor"), F.col("filled")).alias("filled"), "status")
