"""Streams over the event log, run until what there is has been read."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..registry import query, table
from ..sources.paths import shared_path
from ..streaming import refold
from .temporal_queries import dates


def _arrivals(spark, sf):
    """The log in files that arrive out of the order of dates."""
    e = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("d"), F.col("ts").cast("timestamp").alias("ts"))
    path = shared_path(spark, "arrivals")
    e.repartition(6, F.col("event_id") % 5).write.parquet(path)
    return refold.file_stream(spark, path, e.schema)


@query(
    "r01_stream_refold",
    "SELECT event_id, user_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS valid_from, strftime(lead(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) NULLS LAST, event_id), '%Y-%m-%d') AS valid_to FROM events",
)
def r01_stream_refold(spark, sf):
    log, versions = shared_path(spark, "log"), shared_path(spark, "versions")
    refold.refold_stream(spark, _arrivals(spark, sf).drop("ts"), log, versions, ["user_id"], "d", ["event_id"]).awaitTermination()
    return dates(spark.read.parquet(versions).select("event_id", "user_id", "valid_from", "valid_to"))


@query("r02_file_stream", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1")
def r02_file_stream(spark, sf):
    """The watermark lies further back than any file comes late, so that nothing is dropped and state still ends."""
    out = shared_path(spark, "daily")
    refold.collected(refold.counts_by_window(_arrivals(spark, sf), late="3650 days"), out, "update")
    # a window's count comes again when it has grown
    return spark.read.parquet(out).groupBy(F.date_format("start", "yyyy-MM-dd").alias("day")).agg(F.max_by("n", "batch").alias("n"))


def _in_turn(spark, sf, *parts):
    """The events in one file for each part, read in this order."""
    e = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    path = shared_path(spark, "in-turn")
    for p in parts:
        e.filter(p).coalesce(1).write.mode("append").parquet(path)
    return refold.file_stream(spark, path, e.schema, 1)


@query("r01_late_events", """WITH e AS (SELECT event_id % 10 AS k, ts, date_trunc('day', ts) AS day FROM events), w AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM e WHERE k BETWEEN 1 AND 8)
SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS n FROM e, w WHERE k <> 0 OR day + INTERVAL 1 DAY > mark GROUP BY 1""")
def r01_late_events(spark, sf):
    """The last file's events come after the watermark has passed: those of closed windows are dropped."""
    out = shared_path(spark, "late")
    stream = _in_turn(spark, sf, "event_id % 10 BETWEEN 1 AND 8", "event_id % 10 = 9", "event_id % 10 = 0")
    refold.collected(refold.counts_by_window(stream), out, "update")
    return spark.read.parquet(out).groupBy(F.date_format("start", "yyyy-MM-dd").alias("day")).agg(F.max_by("n", "batch").alias("n"))


@query("r01_sessions", """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first, strftime(max(ts) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS last, count(*) AS n FROM s GROUP BY user_id, k""")
def r01_sessions(spark, sf):
    out = shared_path(spark, "sessions")
    refold.collected(refold.sessions_by_key(_in_turn(spark, sf, "event_id % 2 = 0", "event_id % 2 = 1"), "user_id"), out, "complete")
    rows = spark.read.parquet(out)
    last = rows.agg(F.max("batch")).first()[0]
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return rows.filter(F.col("batch") == last).select("user_id", stamp("start").alias("first"), stamp("end").alias("last"), "n")
