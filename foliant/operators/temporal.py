"""Validity intervals folded from an append-only log.

An interval is half-open, ``[valid_from, valid_to)``; a null lower bound is unbounded, a null upper bound is open.
Events of one key on one date give empty intervals for all but the last; these stay, and no question about a date
or an overlap sees them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAR_PAST, FAR_FUTURE = "0001-01-01", "9999-12-31"


def version_fold(
    log: DataFrame,
    key: Sequence[str],
    date: str,
    order: Sequence[str],
    *,
    nulls_first: bool = False,
    repealed: Column | None = None,
    text: str | None = None,
    superseded: Column | None = None,
) -> DataFrame:
    """``log`` with ``valid_from``, ``valid_to`` and ``is_empty``; one shuffle by key.

    ``order`` breaks ties of a date, with nulls as 0. Rows where ``superseded`` holds are left out. ``text`` is null
    where ``repealed`` holds.
    """
    at = F.col(date).asc_nulls_first() if nulls_first else F.col(date).asc_nulls_last()
    by = Window.partitionBy(*key).orderBy(at, *(F.coalesce(F.col(c), F.lit(0)) for c in order))
    out = log if superseded is None else log.filter(~F.coalesce(superseded, F.lit(False)))
    out = out.withColumns({"valid_from": F.col(date), "valid_to": F.lead(date).over(by)})
    out = out.withColumn("is_empty", F.coalesce(F.col("valid_from") == F.col("valid_to"), F.lit(False)))
    if repealed is not None and text is not None:
        out = out.withColumn(text, F.when(~F.coalesce(repealed, F.lit(False)), F.col(text)))
    return out


def holds_at(date: Column | str, lo: str = "valid_from", hi: str = "valid_to", unbounded_below: bool = True) -> Column:
    """Whether an interval contains a date."""
    d = F.lit(date).cast("date") if isinstance(date, str) else date
    since = F.col(lo) <= d
    if unbounded_below:
        since = F.col(lo).isNull() | since
    return since & (F.col(hi).isNull() | (F.col(hi) > d))


def as_of(versions: DataFrame, date: Column | str, **bounds) -> DataFrame:
    """The versions in force on a date."""
    return versions.filter(holds_at(date, **bounds))


def intersects(a_lo: Column, a_hi: Column, b_lo: Column, b_hi: Column) -> Column:
    """Whether two non-empty intervals share a date."""
    lo = lambda c: F.coalesce(c, F.lit(FAR_PAST).cast("date"))
    hi = lambda c: F.coalesce(c, F.lit(FAR_FUTURE).cast("date"))
    return (lo(a_lo) < hi(b_hi)) & (lo(b_lo) < hi(a_hi)) & (lo(a_lo) < hi(a_hi)) & (lo(b_lo) < hi(b_hi))


def overlapping_pairs(intervals: DataFrame, key: str, ident: str, lo: str = "valid_from", hi: str = "valid_to", width: int = 16, most: int = 8) -> DataFrame:
    """(key, a, b), a < b, of overlapping intervals with one key.

    Days are cut into stretches of ``width``. Intervals over ``most`` stretches at most are joined by key and stretch,
    and a pair is taken in the stretch where the later one begins, so that a key's intervals far apart never meet; a
    key with a great part of the rows is dealt out by stretch. Longer ones, and open ones, are joined by key.
    """
    day = lambda c, far: F.unix_date(F.coalesce(F.col(c), F.lit(far).cast("date"))).cast("long")
    real = intervals.select(key, F.col(ident).alias("i"), day(lo, FAR_PAST).alias("lo"), day(hi, FAR_FUTURE).alias("hi")).filter("lo < hi")
    real = real.withColumns({"s0": F.floor(F.col("lo") / width), "s1": F.floor((F.col("hi") - 1) / width)})
    short, long = real.filter(F.col("s1") - F.col("s0") < most), real.filter(F.col("s1") - F.col("s0") >= most)
    meets = (F.col("lo") < F.col("hi_")) & (F.col("lo_") < F.col("hi"))
    other = lambda df: df.select(key, F.col("i").alias("i_"), F.col("lo").alias("lo_"), F.col("hi").alias("hi_"), F.col("s0").alias("s0_"), *(c for c in ("at",) if c in df.columns))
    cut = short.withColumn("at", F.explode(F.sequence("s0", "s1")))
    near = cut.join(other(cut), [key, "at"]).filter((F.col("i") < F.col("i_")) & meets & (F.greatest("s0", "s0_") == F.col("at")))
    far = long.join(other(long), key).filter((F.col("i") < F.col("i_")) & meets).unionByName(long.join(other(short), key).filter(meets))
    return near.select(key, "i", "i_").unionByName(far.select(key, "i", "i_")).select(key, F.least("i", "i_").alias("a"), F.greatest("i", "i_").alias("b"))


def overlap_verdict(intervals: DataFrame, key: str, order: Sequence[str], lo: str = "valid_from", hi: str = "valid_to") -> DataFrame:
    """A row for each key: versions, empty ones, and those that begin before an earlier one has ended.

    The greatest end so far takes the place of a self-join, so a key costs a sort and not a square.
    """
    begin = F.coalesce(F.col(lo), F.lit(FAR_PAST).cast("date"))
    end = F.coalesce(F.col(hi), F.lit(FAR_FUTURE).cast("date"))
    so_far = Window.partitionBy(key).orderBy("lo_", "hi_", *order).rowsBetween(Window.unboundedPreceding, -1)
    real = intervals.withColumns({"lo_": begin, "hi_": end})
    real = real.withColumn("before_", F.max(F.when(F.col("lo_") < F.col("hi_"), F.col("hi_"))).over(so_far))
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return real.groupBy(key).agg(
        F.count("*").alias("n_versions"),
        count(F.col("lo_") >= F.col("hi_")).alias("n_empty"),
        count((F.col("lo_") < F.col("hi_")) & (F.col("before_") > F.col("lo_"))).alias("n_overlaps"),
    )


def purge_and_reinsert(current: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """The end state after all rows of the keys in ``fresh`` are replaced by ``fresh``."""
    return current.join(fresh.select(key).distinct(), key, "left_anti").select(*current.columns).unionByName(fresh)


def refold_touched(versions_log: DataFrame, touched: DataFrame, key: Sequence[str], date: str, order: Sequence[str]) -> DataFrame:
    """Fold again only the keys in ``touched``: late events change their neighbours' intervals and no other key's."""
    return version_fold(versions_log.join(touched.select(*key).distinct(), list(key), "left_semi"), key, date, order)
