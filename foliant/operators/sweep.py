"""Sweeps over a sorted axis, cut into ranges: what a range ends with is carried to those behind it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.paths import stored_at


def carried_sums(rows: DataFrame, order: Sequence[str], **sums: str) -> DataFrame:
    """``rows`` with running sums of columns over all rows in ``order``, each named by its keyword, its own row included.

    Rows are sorted by ranges and written, sums are taken within each file, and those of whole files, one row a file,
    are carried on. ``order`` has no ties.
    """
    _, path = stored_at(rows.orderBy(*order), "sorted")
    own = rows.sparkSession.read.schema(rows.schema).parquet(path).select("*", F.col("_metadata.file_name").alias("file_"))
    files = own.groupBy("file_").agg(*(F.sum(c).alias(f"{name}_all_") for name, c in sums.items()))
    earlier = Window.orderBy("file_").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file_", *(F.coalesce(F.sum(f"{name}_all_").over(earlier), F.lit(0)).alias(f"{name}_before_") for name in sums))
    inside = Window.partitionBy("file_").orderBy(*order)
    out = own.withColumns({f"{name}_in_": F.sum(c).over(inside) for name, c in sums.items()}).join(files, "file_")
    return out.select(*rows.columns, *((F.col(f"{name}_before_") + F.col(f"{name}_in_")).alias(name) for name in sums))


def busy_windows(intervals: DataFrame, key: str, begin: str, end: str, least: int = 2) -> DataFrame:
    """(key, begin, end, peak) of the stretches in which ``least`` or more intervals of a key are open at once.

    ``peak``: the most that are. Intervals hold their begin and not their end; empty ones count for nothing, and a stretch
    goes on where one interval ends as another begins. One sweep over all keys: each key's opens and closes cancel out.
    """
    valid = intervals.filter(F.col(begin) < F.col(end))
    points = valid.select(key, F.explode(F.array(F.struct(F.col(begin).alias("at"), F.lit(1).alias("d")), F.struct(F.col(end).alias("at"), F.lit(-1).alias("d")))).alias("x"))
    points = points.groupBy(key, "x.at").agg(F.sum("x.d").alias("d")).filter("d <> 0")
    level = carried_sums(points, [key, "at"], level="d")
    was = F.col("level") - F.col("d")
    level = level.withColumn("opens", F.when((F.col("level") >= least) & (was < least), 1).otherwise(0)).filter((F.col("level") >= least) | (was >= least))
    numbered = carried_sums(level, [key, "at"], stretch="opens")
    return numbered.groupBy(key, "stretch").agg(F.min("at").alias("begin"), F.max("at").alias("end"), F.max("level").alias("peak")).drop("stretch")
