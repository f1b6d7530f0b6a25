"""Version folds, as-of questions, overlaps, purges and lineage over the test tables.

Roles: ``events`` is a log (provision: user, date: day of ts, order: event_id, ``error``: repeal); ``orders`` and
``lineitem`` are enactments and the acts in them; ``customer`` holds provisions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lineage, temporal
from ..registry import query, table

LOG = """
log AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS d, event_type = 'error' AS repealed FROM events),
v AS (
  SELECT event_id, user_id, CASE WHEN NOT repealed THEN event_type END AS version_text, d AS valid_from,
         lead(d) OVER (PARTITION BY user_id ORDER BY d NULLS LAST, event_id) AS valid_to
  FROM log)"""
DAY = "2024-01-15"


def log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("date").alias("d"))


def versions(spark: SparkSession, sf: str, **how) -> DataFrame:
    e = log(spark, sf)
    folded = temporal.version_fold(e.withColumn("version_text", F.col("event_type")), ["user_id"], "d", ["event_id"], repealed=F.col("event_type") == "error", text="version_text", **how)
    return folded.select("event_id", "user_id", "version_text", "valid_from", "valid_to", "is_empty")


def dates(df: DataFrame) -> DataFrame:
    """Dates as text, which every engine hands over alike."""
    return df.select(*(F.date_format(c, "yyyy-MM-dd").alias(c) if t == "date" else F.col(c) for c, t in df.dtypes))


@query("w01_p01_asof", f"WITH {LOG} SELECT user_id, event_id, version_text FROM v WHERE valid_from <= DATE '{DAY}' AND (valid_to IS NULL OR valid_to > DATE '{DAY}')")
def w01_p01_asof(spark, sf):
    return temporal.as_of(versions(spark, sf), DAY, unbounded_below=False).select("user_id", "event_id", "version_text")


@query(
    "w01_version_fold",
    f"WITH {LOG} SELECT event_id, user_id, version_text, strftime(valid_from, '%Y-%m-%d') AS valid_from, strftime(valid_to, '%Y-%m-%d') AS valid_to, coalesce(valid_from = valid_to, false) AS is_empty FROM v",
)
def w01_version_fold(spark, sf):
    return dates(versions(spark, sf))


@query(
    "w02_fold_nulls_first",
    """WITH log AS (SELECT event_id, user_id, CASE WHEN event_type <> 'view' THEN CAST(ts AS DATE) END AS d FROM events)
SELECT event_id, user_id, strftime(d, '%Y-%m-%d') AS valid_from,
       strftime(lead(d) OVER (PARTITION BY user_id ORDER BY d ASC NULLS FIRST, event_id), '%Y-%m-%d') AS valid_to,
       CASE WHEN d IS NULL THEN 'unbounded' WHEN lead(d) OVER (PARTITION BY user_id ORDER BY d ASC NULLS FIRST, event_id) IS NULL THEN 'open'
            WHEN d = lead(d) OVER (PARTITION BY user_id ORDER BY d ASC NULLS FIRST, event_id) THEN 'empty' ELSE 'closed' END AS shape
FROM log""",
)
def w02_fold_nulls_first(spark, sf):
    e = log(spark, sf).withColumn("d", F.when(F.col("event_type") != "view", F.col("d")))
    v = temporal.version_fold(e, ["user_id"], "d", ["event_id"], nulls_first=True)
    shape = F.when(F.col("valid_from").isNull(), "unbounded").when(F.col("valid_to").isNull(), "open").when(F.col("is_empty"), "empty").otherwise("closed")
    return dates(v.select("event_id", "user_id", "valid_from", "valid_to", shape.alias("shape")))


@query(
    "w02_chaptered_out",
    """WITH log AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS d FROM events),
m AS (SELECT *, event_id < max(event_id) OVER (PARTITION BY user_id, d) AS out_ FROM log)
SELECT event_id, user_id, strftime(d, '%Y-%m-%d') AS valid_from,
       strftime(lead(d) OVER (PARTITION BY user_id ORDER BY d NULLS LAST, event_id), '%Y-%m-%d') AS valid_to
FROM m WHERE NOT out_""",
)
def w02_chaptered_out(spark, sf):
    """Of the events of one key and day only the last, superseding the others, makes a version."""
    from pyspark.sql import Window

    e = log(spark, sf).withColumn("out_", F.col("event_id") < F.max("event_id").over(Window.partitionBy("user_id", "d")))
    v = temporal.version_fold(e, ["user_id"], "d", ["event_id"], superseded=F.col("out_"))
    return dates(v.select("event_id", "user_id", "valid_from", "valid_to"))


@query(
    "p02_designation_asof",
    f"""WITH {LOG}, last AS (
  SELECT user_id, version_text AS label, valid_from FROM v WHERE (valid_from IS NULL OR valid_from <= DATE '2024-01-10') AND (valid_to IS NULL OR valid_to > DATE '2024-01-10'))
SELECT user_id, label, strftime(valid_from, '%Y-%m-%d') AS valid_from, count(*) OVER (PARTITION BY user_id) AS n FROM last""",
)
def p02_designation_asof(spark, sf):
    from pyspark.sql import Window

    v = temporal.as_of(versions(spark, sf), "2024-01-10")
    return dates(v.select("user_id", F.col("version_text").alias("label"), "valid_from", F.count("*").over(Window.partitionBy("user_id")).alias("n")))


_STAYS = """stays AS (
  SELECT event_id, user_id, CAST(ts AS DATE) AS lo, CAST(ts AS DATE) + CAST(event_id % 4 AS INTEGER) AS hi FROM events)"""


def stays(spark, sf):
    return log(spark, sf).select("event_id", "user_id", F.col("d").alias("valid_from"), F.expr("date_add(d, cast(event_id % 4 as int))").alias("valid_to"))


@query(
    "p03_overlap_pairs",
    f"""WITH {_STAYS} SELECT a.user_id, a.event_id AS a, b.event_id AS b FROM stays a JOIN stays b
ON a.user_id = b.user_id AND a.event_id < b.event_id AND a.lo < b.hi AND b.lo < a.hi AND a.lo < a.hi AND b.lo < b.hi""",
)
def p03_overlap_pairs(spark, sf):
    return temporal.overlapping_pairs(stays(spark, sf), "user_id", "event_id")


@query(
    "d01_overlap",
    f"""WITH {LOG}, i AS (SELECT user_id, event_id, coalesce(valid_from, DATE '0001-01-01') AS lo, coalesce(valid_to, DATE '9999-12-31') AS hi FROM v),
p AS (SELECT b.user_id, count(DISTINCT b.event_id) AS n FROM i a JOIN i b ON a.user_id = b.user_id AND (a.lo, a.hi, a.event_id) < (b.lo, b.hi, b.event_id) AND a.lo < a.hi AND b.lo < b.hi AND a.hi > b.lo GROUP BY 1)
SELECT i.user_id, count(*) AS n_versions, count(*) FILTER (lo >= hi) AS n_empty, coalesce(any_value(p.n), 0) AS n_overlaps FROM i LEFT JOIN p USING (user_id) GROUP BY i.user_id""",
)
def d01_overlap(spark, sf):
    return temporal.overlap_verdict(versions(spark, sf), "user_id", ["event_id"])


@query(
    "d02_designation_overlap",
    f"""WITH {_STAYS}, r AS (SELECT *, max(CASE WHEN lo < hi THEN hi END) OVER (PARTITION BY user_id ORDER BY lo, hi, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM stays)
SELECT user_id, count(*) AS n_versions, count(*) FILTER (lo >= hi) AS n_empty, count(*) FILTER (lo < hi AND b > lo) AS n_overlaps FROM r GROUP BY user_id""",
)
def d02_designation_overlap(spark, sf):
    return temporal.overlap_verdict(stays(spark, sf), "user_id", ["event_id"])


@query(
    "i01_purge_reinsert",
    """WITH fresh AS (SELECT l_orderkey, l_linenumber, l_partkey + 1 AS l_partkey FROM lineitem WHERE l_orderkey % 7 = 3)
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM fresh)
UNION ALL SELECT * FROM fresh""",
)
def i01_purge_reinsert(spark, sf):
    now = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return temporal.purge_and_reinsert(now, now.filter("l_orderkey % 7 = 3").withColumn("l_partkey", F.col("l_partkey") + 1), "l_orderkey")


@query(
    "r01_refold_touched",
    """WITH log AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_id % 97 = 0))
SELECT event_id, user_id, strftime(d, '%Y-%m-%d') AS valid_from, strftime(lead(d) OVER (PARTITION BY user_id ORDER BY d NULLS LAST, event_id), '%Y-%m-%d') AS valid_to FROM log""",
)
def r01_refold_touched(spark, sf):
    e = log(spark, sf)
    v = temporal.refold_touched(e, e.filter("event_id % 97 = 0"), ["user_id"], "d", ["event_id"])
    return dates(v.select("event_id", "user_id", "valid_from", "valid_to"))


# --- lineage -------------------------------------------------------------------------------------------

_EDGES = """edges AS (
  SELECT event_id AS edge_id, event_id AS from_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS to_id,
         CASE WHEN event_id % 3 = 0 THEN 'renumbered' ELSE 'amended' END AS edge_type FROM events)"""


def edges(spark, sf) -> DataFrame:
    from pyspark.sql import Window

    e = table(spark, sf, "events")
    kind = F.when(F.col("event_id") % 3 == 0, "renumbered").otherwise("amended")
    out = e.select(F.col("event_id").alias("edge_id"), F.col("event_id").alias("from_id"), F.lead("event_id").over(Window.partitionBy("user_id").orderBy("event_id")).alias("to_id"), kind.alias("edge_type"))
    return out.filter("to_id IS NOT NULL")


def _walk(name: str, source: str, target: str) -> str:
    return f"""{name} AS (
  SELECT event_id AS start, event_id AS id, 0 AS depth, CAST(NULL AS BIGINT) AS edge_id, CAST(NULL AS VARCHAR) AS edge_type, CAST(NULL AS BIGINT) AS parent
  FROM events
  UNION ALL SELECT start, {target}, depth + 1, e.edge_id, e.edge_type, id FROM {name} JOIN edges e ON e.{source} = id WHERE depth < 9 AND e.to_id IS NOT NULL)"""


def starts(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(F.col("event_id").alias("id"))


@query("g01_lineage", f"WITH RECURSIVE {_EDGES}, {_walk('w', 'from_id', 'to_id')} SELECT * FROM w")
def g01_lineage(spark, sf):
    return lineage.closure(edges(spark, sf), starts(spark, sf))


@query(
    "g01_bidirectional",
    f"""WITH RECURSIVE {_EDGES}, {_walk('down', 'from_id', 'to_id')}, {_walk('up', 'to_id', 'from_id')}
SELECT *, 'descendant' AS direction FROM down UNION SELECT *, 'ancestor' AS direction FROM up""",
)
def g01_bidirectional(spark, sf):
    return lineage.both_ways(edges(spark, sf), starts(spark, sf), every=True)


@query(
    "o01_ordered_lineage",
    f"""WITH RECURSIVE {_EDGES}, {_walk('down', 'from_id', 'to_id')}, {_walk('up', 'to_id', 'from_id')}, b AS (SELECT *, 'descendant' AS direction FROM down UNION SELECT *, 'ancestor' AS direction FROM up)
SELECT start, direction, depth, id, row_number() OVER (PARTITION BY start ORDER BY direction, depth, id) AS place FROM b""",
)
def o01_ordered_lineage(spark, sf):
    """Each start's lineage in the order of direction, depth and id, and in this order."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("start").orderBy("direction", "depth", "id")).cast("long")
    rows = lineage.both_ways(edges(spark, sf), starts(spark, sf), every=True).select("start", "direction", "depth", "id", place.alias("place"))
    return rows.orderBy("start", "direction", "depth", "id")


@query(
    "g02_full_history",
    f"""WITH RECURSIVE {_EDGES}, {_walk('w', 'from_id', 'to_id')}, {LOG}
SELECT w.start, w.depth, v.event_id, v.version_text FROM w JOIN v ON v.event_id = w.id""",
)
def g02_full_history(spark, sf):
    reached = lineage.closure(edges(spark, sf), starts(spark, sf)).select("start", "depth", F.col("id").alias("event_id"))
    return reached.join(versions(spark, sf), "event_id").select("start", "depth", "event_id", "version_text")


@query(
    "g03_identity_rule",
    f"""WITH {_EDGES} SELECT edge_type, CASE edge_type WHEN 'renumbered' THEN 'same identity' ELSE 'new version' END AS rule, count(*) AS n
FROM edges WHERE to_id IS NOT NULL GROUP BY edge_type""",
)
def g03_identity_rule(spark, sf):
    rules = spark.createDataFrame([("renumbered", "same identity"), ("amended", "new version")], "edge_type string, rule string")
    return edges(spark, sf).join(F.broadcast(rules), "edge_type", "left").groupBy("edge_type", "rule").agg(F.count("*").alias("n"))


@query(
    "g04_cycles",
    """WITH RECURSIVE n AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS i, count(*) OVER () AS n FROM supplier),
e AS (SELECT i AS a, CASE WHEN i % 15 < least(13, n - i // 15 * 15) - 1 THEN i + 1 WHEN i % 15 = least(13, n - i // 15 * 15) - 1 THEN i // 15 * 15 ELSE i - 1 END AS b FROM n),
w AS (SELECT a AS start, b AS id FROM e UNION SELECT start, e.b FROM w JOIN e ON e.a = w.id)
SELECT s_suppkey AS start, i IN (SELECT start FROM w WHERE start = id) AS cyclic FROM n""",
)
def g04_cycles(spark, sf):
    """Of each 15 suppliers 13 form a ring; the other two lead into it."""
    from pyspark.sql import Window

    s = table(spark, sf, "supplier").select("s_suppkey")
    n = s.count()
    i = (F.row_number().over(Window.orderBy("s_suppkey")) - 1).cast("long")  # a number for each supplier of a small table
    first = F.floor(F.col("i") / 15) * 15
    last = F.least(F.lit(13), n - first) - 1
    numbered = s.withColumn("i", i)
    to = F.when(F.col("i") % 15 < last, F.col("i") + 1).when(F.col("i") % 15 == last, first).otherwise(F.col("i") - 1)
    found = lineage.cyclic(numbered.select(F.col("i").alias("from_id"), to.cast("long").alias("to_id")), numbered.select(F.col("i").alias("id")))
    return numbered.join(found, F.col("i") == F.col("start")).select(F.col("s_suppkey").alias("start"), "cyclic")


@query(
    "u01_union_distinct",
    """SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier""",
)
def u01_union_distinct(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey")).unionByName(table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"))).distinct()
