"""Verdicts on volumes, flags on acts and index totals, over tables made of orders and line items."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import headings as H
from ..operators import sequence as S
from ..operators import verify as V
from ..registry import query, table

#: A supplier is a volume, its line items are acts and pages.
_VOLUMES = """a AS (SELECT DISTINCT l_suppkey AS volume, CASE l_suppkey % 3 WHEN 0 THEN 'REGULAR' WHEN 1 THEN 'EXTRA' || CAST(l_linenumber % 2 AS VARCHAR) ELSE 'UNKNOWN' END AS session, l_orderkey % (20 + l_suppkey % 900) + 1 AS chapter FROM lineitem WHERE l_suppkey % 13 <> 0 OR l_orderkey % 50 = 1),
p AS (SELECT l_suppkey AS volume, l_partkey AS page, min(CASE WHEN l_suppkey % 5 <> 0 THEN CASE WHEN (l_partkey + l_suppkey) % 11 = 0 THEN 'index' ELSE 'body' END END) AS shape, min(CASE WHEN l_partkey % 400 > l_suppkey % 7 * 3 AND NOT (l_suppkey % 4 = 0 AND l_partkey % 97 = 5) THEN 1 + (l_suppkey + l_partkey) % 3 END) AS engines, min(l_partkey % 10 >= l_suppkey % 6) AS sure, min(CASE WHEN l_suppkey % 9 = 0 AND l_partkey % 10 = 0 THEN 0 ELSE 99 END) AS n_chars FROM lineitem GROUP BY ALL),
s AS (SELECT volume, session, count(*) AS n, max(chapter) AS top, min(chapter) AS low FROM a GROUP BY ALL),
m AS (SELECT volume, count(*) AS sessions, CAST(sum(n) AS BIGINT) AS chapters, arg_min({'t': top, 'l': low, 'n': n}, CASE session WHEN 'REGULAR' THEN '0' WHEN 'UNKNOWN' THEN '1' ELSE '2' || session END) AS p FROM s GROUP BY volume),
r AS (SELECT *, min(CASE WHEN engines IS NOT NULL THEN page END) OVER (PARTITION BY volume) AS first_ FROM p),
f AS (SELECT volume, bool_or(shape IS NOT NULL) AS classified, count(*) FILTER (engines IS NULL AND shape = 'body' AND page > first_) AS body_gaps, count(*) FILTER (engines IS NULL AND page < first_) AS "leading",
  coalesce(count(*) FILTER (engines > 1 AND NOT sure) / nullif(count(*) FILTER (engines > 1), 0), 0) AS doubtful, coalesce(count(*) FILTER (engines IS NOT NULL AND n_chars = 0) / nullif(count(engines), 0), 0) AS empty FROM r GROUP BY volume),
e AS (SELECT volume, volume % 2 = 0 AS multi, CASE WHEN volume % 3 = 0 THEN 10 * (volume % 100) END AS expected FROM (SELECT DISTINCT volume FROM p))"""


def volumes(spark, sf):
    l = table(spark, sf, "lineitem")
    k, o, p = F.col("l_suppkey"), F.col("l_orderkey"), F.col("l_partkey")
    session = F.when(k % 3 == 0, "REGULAR").when(k % 3 == 1, F.concat(F.lit("EXTRA"), (F.col("l_linenumber") % 2).cast("string"))).otherwise("UNKNOWN")
    acts = l.filter((k % 13 != 0) | (o % 50 == 1)).select(k.alias("volume"), session.alias("session"), (o % (20 + k % 900) + 1).alias("chapter"))
    pages = l.groupBy(k.alias("volume"), p.alias("page")).agg(
        F.min(F.when(k % 5 != 0, F.when((p + k) % 11 == 0, "index").otherwise("body"))).alias("shape"),
        F.min(F.when((p % 400 > k % 7 * 3) & ~((k % 4 == 0) & (p % 97 == 5)), 1 + (k + p) % 3)).alias("engines"),
        F.min(p % 10 >= k % 6).alias("sure"),
        F.min(F.when((k % 9 == 0) & (p % 10 == 0), 0).otherwise(99)).alias("n_chars"),
    )
    label = F.when(F.col("volume") % 2 == 0, "1907-vol1").otherwise("1907")
    expected = pages.select("volume").distinct().select("volume", label.alias("label"), F.when(F.col("volume") % 3 == 0, 10 * (F.col("volume") % 100)).alias("expected"))
    return acts, pages, expected


@query("c08_volume_verdicts", f"""WITH {_VOLUMES} SELECT f.volume, classified, body_gaps, "leading", round(doubtful, 6) AS doubtful, round(empty, 6) AS empty, coalesce(sessions, 0) AS sessions, coalesce(chapters, 0) AS chapters, p.t AS top, round(1 - p.n / (p.t - p.l + 1), 6) AS gap_rate,
CASE WHEN coalesce(chapters, 0) < 5 THEN 'STUB' WHEN classified AND body_gaps > 0 THEN 'GAPS_FOUND' WHEN round(doubtful, 6) > 0.3 OR round(empty, 6) > 0.05 THEN 'SUSPECT' WHEN sessions = 1 AND round(1 - p.n / (p.t - p.l + 1), 6) >= 0.3 AND NOT multi THEN 'GAPS_FOUND'
WHEN p.t < expected - greatest(5, floor(expected * 0.08)) THEN 'GAPS_FOUND' WHEN NOT classified THEN 'UNVERIFIED' WHEN "leading" > 0 THEN 'LEADING_GAP_ONLY' ELSE 'COMPLETE' END AS verdict FROM f JOIN e USING (volume) LEFT JOIN m USING (volume)""")
def c08_volume_verdicts(spark, sf):
    acts, pages, expected = volumes(spark, sf)
    return V.volume_verdicts(V.volume_facts(acts, pages), expected).drop("label", "expected")


_ACTS = """SELECT o_custkey AS volume, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS position, o_orderkey AS k, o_orderkey % 97 AS chapter, 1900 + o_orderkey % 60 AS y FROM orders"""
_STEPS = "steps AS (SELECT *, chapter - lag(chapter) OVER (PARTITION BY volume ORDER BY position) AS step FROM o), typical AS (SELECT volume, list_sort(list(abs(step)))[len(list(step)) // 2 + 1] AS t FROM steps WHERE step <> 0 GROUP BY volume)"


def flagged_acts(spark, sf):
    k = F.col("o_orderkey")
    y = (1900 + k % 60).cast("int")
    year = y.cast("string")
    text = F.concat(
        F.when(k % 5 == 0, "CHAPTEN 4. ").otherwise("CHAPTER 4. "),
        F.when(k % 7 == 0, F.concat(F.lit("[Approved May 3, "), (y + 30).cast("string"))).otherwise(F.concat(F.lit("[Approved May 3, "), year)),
        F.lit(".]\nSection 1. It is so.\nSection "),
        F.when(k % 3 == 0, "2l3").otherwise("2"),
        F.lit(". And so.\nSection "),
        F.when(k % 4 == 0, "9002").otherwise("3"),
        F.lit(". "),
        F.when(k % 2 == 0, F.concat(F.repeat(F.lit("and on and on "), F.lit(20)), F.when(k % 6 == 0, "do enact as follows").otherwise("."))).otherwise(""),
    )
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("volume"), "o_orderkey", (k % 97).alias("chapter"), F.lit(90).alias("ceiling"), y.alias("year"), F.concat(F.lit("Approved May 3, "), year).alias("approved"), text.alias("text"))
    return o.withColumn("position", F.row_number().over(Window.partitionBy("volume").orderBy("o_orderkey")).cast("long"))


_FLAGS = f"""o AS ({_ACTS}), {_STEPS}, flags AS (SELECT volume, position, 'range' AS "check", CAST(chapter AS VARCHAR) AS detail FROM o WHERE chapter NOT BETWEEN 1 AND 90
UNION ALL SELECT volume, position, 'dates', 'text_year:' || (y + 30) FROM o WHERE k % 7 = 0 UNION ALL SELECT volume, position, 'keywords', 'chapter' FROM o WHERE k % 5 = 0
UNION ALL SELECT volume, position, 'sections', 'damaged' FROM o WHERE k % 3 = 0 UNION ALL SELECT volume, position, 'sections', 'leap' FROM o WHERE k % 4 = 0 AND k % 3 <> 0
UNION ALL SELECT volume, position, 'formula', 'missing' FROM o WHERE k % 2 = 0 AND k % 6 <> 0
UNION ALL SELECT s.volume, position, 'sequence', 'break' FROM steps s LEFT JOIN typical t USING (volume) WHERE step > greatest(5 * t, 30)
UNION ALL SELECT volume, position, 'sequence', 'duplicate' FROM (SELECT *, row_number() OVER (PARTITION BY volume, chapter ORDER BY position) AS r FROM o) WHERE r > 1)"""


@query("c09_act_flags", f"WITH {_FLAGS} SELECT * FROM flags")
def c09_act_flags(spark, sf):
    return V.act_flags(flagged_acts(spark, sf))


@query("c09_flag_quality", f"""WITH {_FLAGS}, truth AS (SELECT volume, position FROM o WHERE k % 15 = 0), seen AS (SELECT DISTINCT volume, position, "check" FROM flags)
SELECT "check", count(*) AS flagged, count(t.volume) AS "true", round(count(t.volume) / count(*), 4) AS precision, round(count(t.volume) / (SELECT count(*) FROM truth), 4) AS recall FROM seen LEFT JOIN truth t ON t.volume = seen.volume AND t.position = seen.position GROUP BY 1""")
def c09_flag_quality(spark, sf):
    acts = flagged_acts(spark, sf)
    return V.flag_quality(V.act_flags(acts), acts.filter("o_orderkey % 15 = 0"))


@query("c10_index_totals", """WITH o AS (SELECT o_custkey % 50 AS volume, o_orderkey % 120 + 1 AS chapter FROM orders), e AS (SELECT DISTINCT * FROM o WHERE chapter < 40 + volume OR chapter % 50 = 49),
g AS (SELECT *, chapter - lag(chapter) OVER (PARTITION BY volume ORDER BY chapter) AS step FROM e), b AS (SELECT *, sum(CASE WHEN step > 15 THEN 1 ELSE 0 END) OVER (PARTITION BY volume ORDER BY chapter) AS broken FROM g),
t AS (SELECT volume, max(chapter) AS top FROM b WHERE broken = 0 AND (step IS NULL OR step <= 5) GROUP BY volume), h AS (SELECT volume, top, count(*) AS entries FROM e JOIN t USING (volume) WHERE chapter <= top GROUP BY ALL),
d AS (SELECT volume, CASE WHEN entries >= 0.75 * top THEN top END AS derived FROM h), k AS (SELECT DISTINCT volume, 40 + volume + volume % 3 - 2 AS known FROM o)
SELECT volume, derived, known, CASE WHEN derived IS NULL THEN 'NO_INDEX' WHEN abs(derived - known) <= 1 THEN 'MATCH' WHEN known < derived THEN 'ORACLE_LOW' ELSE 'ORACLE_HIGH' END AS verdict FROM k LEFT JOIN d USING (volume)""")
def c10_index_totals(spark, sf):
    """Entries printed as lines of an index, read from them again."""
    o = table(spark, sf, "orders").select((F.col("o_custkey") % 50).alias("volume"), (F.col("o_orderkey") % 120 + 1).alias("chapter"))
    e = o.filter("chapter < 40 + volume OR chapter % 50 = 49").distinct()
    lines = e.select("volume", F.col("chapter").alias("line_no"), F.concat(F.col("chapter").cast("string"), F.lit(" | An Act to provide, "), (F.col("chapter") * 3).cast("string")).alias("line"))
    entries = H.index_entries(lines, "volume")
    known = o.select("volume").distinct().withColumn("known", 40 + F.col("volume") + F.col("volume") % 3 - 2)
    return V.index_verdicts(V.index_totals(entries.withColumn("chapter", F.col("chapter").cast("long"))), known).select("volume", "derived", "known", "verdict")


@query("c12_manifest_brackets", """WITH n AS (SELECT o_custkey % 20 AS s, o_orderkey % 900 + 1 AS n, min(o_orderkey % 900 * 2) AS page FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL), top AS (SELECT s, max(n) AS total FROM n GROUP BY s),
m AS (SELECT s, i AS n FROM top, range(1, 901) r(i) WHERE i <= total EXCEPT SELECT s, n FROM n), r AS (SELECT s, n, count(*) OVER (PARTITION BY s, g) AS run_length FROM (SELECT *, n - row_number() OVER (PARTITION BY s ORDER BY n) AS g FROM m)),
b AS (SELECT r.*, (SELECT max(x.n) FROM n x WHERE x.s = r.s AND x.n < r.n) AS lo, (SELECT min(x.n) FROM n x WHERE x.s = r.s AND x.n > r.n) AS hi FROM r),
p AS (SELECT b.*, x.page AS a, y.page AS z FROM b LEFT JOIN n x ON x.s = b.s AND x.n = lo LEFT JOIN n y ON y.s = b.s AND y.n = hi)
SELECT s, n, lo, hi, CASE WHEN a IS NOT NULL AND z IS NOT NULL THEN greatest(1, least(a, z) - 2) WHEN a IS NOT NULL THEN a WHEN z IS NOT NULL THEN greatest(1, z - 6 - run_length) END AS first_page,
CASE WHEN a IS NOT NULL AND z IS NOT NULL THEN greatest(a, z) + 2 WHEN a IS NOT NULL THEN a + 6 + run_length ELSE z END AS last_page, coalesce(abs(z - a) < run_length, false) AS implausible FROM p""")
def c12_manifest_brackets(spark, sf):
    """Each missing ordinal with the pages on which to look for it."""
    o = table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    n = o.groupBy((F.col("o_custkey") % 20).alias("s"), (F.col("o_orderkey") % 900 + 1).alias("n")).agg(F.min(F.col("o_orderkey") % 900 * 2).alias("page"))
    lost = S.missing(n, n.groupBy("s").agg(F.max("n").alias("total")), "s", "n", "total")
    return S.brackets(n, lost, "s", "n", "page")
