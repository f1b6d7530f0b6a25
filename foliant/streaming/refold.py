"""Streams of change events: late events rewrite their neighbours, so each batch folds the keys that it touches anew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.temporal import version_fold
from ..sources.paths import shared_path


def bucketed(df: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def refold_stream(
    spark: SparkSession, source: DataFrame, log: str, versions: str, key: Sequence[str], date: str, order: Sequence[str], checkpoint: str | None = None, buckets: int = 16
):
    """Start a query that appends each batch to the log at ``log`` and folds the touched keys' buckets into ``versions``.

    Both tables are partitioned by a hash bucket of the key; a batch rewrites the buckets that it touches and no others.
    A batch that runs again after a failure finds its own rows in the log by its number and doesn't add them twice.
    """

    def each(batch: DataFrame, number: int) -> None:
        fresh = bucketed(batch, key, buckets).withColumn("batch", F.lit(number))
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "bucket").parquet(log)
        kind = fresh.schema
        whole = spark.read.schema(kind).parquet(log)
        touched = whole.filter(F.col("batch") == number).select("bucket").distinct()
        # as many values as there are buckets: a filter by partition, which prunes folders
        some = [r.bucket for r in touched.collect()]
        folded = version_fold(whole.filter(F.col("bucket").isin(some)).drop("batch"), list(key), date, list(order))
        folded.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(versions)

    return source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint or shared_path(spark, "offsets")).trigger(availableNow=True).start()


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 3) -> DataFrame:
    """New files below ``path`` as a stream, at most so many a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def counts_by_window(events: DataFrame, at: str = "ts", late: str = "1 hour", size: str = "1 day") -> DataFrame:
    """Counts by event-time window, with a watermark after which a window is closed: its state ends and later events of
    it are dropped."""
    return events.withWatermark(at, late).groupBy(F.window(at, size)).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "n")


def sessions_by_key(events: DataFrame, key: str, at: str = "ts", gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """(key, start, end, n) of a key's events that are less than ``gap`` apart."""
    w = events.withWatermark(at, late).groupBy(key, F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n"))
    return w.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def collected(stream: DataFrame, out: str, mode: str, checkpoint: str | None = None) -> None:
    """Run a stream until it has read what there is; each batch's rows go to a folder of its number, which a batch that
    runs again overwrites."""

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = stream.writeStream.outputMode(mode).foreachBatch(each)
    query.option("checkpointLocation", checkpoint or shared_path(stream.sparkSession, "offsets")).trigger(availableNow=True).start().awaitTermination()
