"""Recovery of lost numbers, windows without headings, headings paired in rounds, and times of several workers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import headings as H
from ..operators import recovery as R
from ..operators import sweep
from ..registry import query, table


def session_acts(spark, sf) -> DataFrame:
    """Sessions of several volumes: the true number ``n`` counts a session's acts and leaves one out after each 25.

    Certain numbers are those of four fifths of the events that aren't errors. Of the others some are lost, a reading
    may be right, wrong or missing, and of three readers each has its own faults.
    """
    e = table(spark, sf, "events").select((F.col("user_id") % 20).alias("session"), F.col("user_id").alias("volume"), "event_id", "event_type")
    by = Window.partitionBy("session").orderBy("volume", "event_id")
    e = e.withColumns({"n": (F.row_number().over(by) + F.floor((F.row_number().over(by) - 1) / 25)).cast("long"), "at": F.row_number().over(Window.partitionBy("session", "volume").orderBy("event_id"))})
    e = e.withColumns({"total": F.max("n").over(Window.partitionBy("session")), "certain": (F.col("event_type") != "error") & (F.col("event_id") % 5 != 0)})
    k = F.col("event_id") % 7
    e = e.filter(F.col("certain") | (k != 0))
    printed = F.when(k == 1, None).when(k == 2, F.col("n") + 40).otherwise(F.col("n"))
    reader = lambda j: F.when((F.col("event_id") + j) % 4 == 0, F.col("n")).when((F.col("event_id") + j) % 4 == 1, F.col("n") + j).otherwise(F.lit(None))
    e = e.withColumn("pos", F.row_number().over(by).cast("long"))
    return e.select(
        "session", "pos", "volume", (10 + 2 * F.col("at") - F.col("event_id") % 3).cast("long").alias("page"), "n", F.when(F.col("certain"), F.col("n")).alias("number"),
        F.array(reader(0), reader(4), reader(3)).alias("readings"), printed.cast("long").alias("printed"), "total",
    )


@query("w20_session_fill")
def w20_session_fill(spark, sf):
    """Tested against all assignments on small sessions."""
    acts = session_acts(spark, sf)
    return R.session_fill(acts, "session", ["pos"], ["volume", "page"], "number", F.col("number").isNotNull(), "printed", "total").select("session", "pos", "filled", "lo", "hi")


@query("c06_recovery")
def c06_recovery(spark, sf):
    """What each step of the recovery gained, and the share of acts that have their true number before and after it."""
    acts = session_acts(spark, sf)
    known, gains = R.recovered(acts.drop("n"))
    steps = spark.createDataFrame(gains, "step int, pass string, gained long")  # a row for each step
    right = known.join(acts.select("session", "pos", "n"), ["session", "pos"]).groupBy("step").agg(F.count_if(F.col("number") == F.col("n")).alias("right"))
    total = acts.agg(F.count("*").alias("acts"))
    base = right.filter("step = 0").select(F.col("right").alias("base"))
    out = steps.join(right, "step", "left").fillna(0, ["right"]).crossJoin(F.broadcast(total)).crossJoin(F.broadcast(base))
    by = Window.orderBy("step")  # a row for each step
    out = out.withColumn("after", F.col("base") + F.sum("right").over(by))
    share = lambda c: F.round(c / F.col("acts"), 6)
    return out.select("step", "pass", "gained", "right", share(F.col("after") - F.col("right")).alias("recall_before"), share(F.col("after")).alias("recall_after"))


@query(
    "w32_silent_windows",
    r"""WITH p AS (SELECT doc_id // 400 AS vol, doc_id % 400 + 1 AS page, regexp_matches(coalesce(text, ''), 'MIT') AS heading, regexp_matches(coalesce(text, ''), ' (der|les|la) ') AS body FROM documents),
t AS (SELECT vol, max(page) AS n FROM p GROUP BY vol HAVING max(page) >= 150),
w AS (SELECT vol, s AS a, s + 74 AS b FROM t, range(1, 400, 37) r(s) WHERE s <= n - 75),
e AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.vol = w.vol AND p.page BETWEEN a AND b AND heading)
      AND (SELECT count(*) FROM p WHERE p.vol = w.vol AND p.page BETWEEN a AND b AND (p.page - a) % 10 = 0 AND body) <= 3),
g AS (SELECT *, sum(CASE WHEN a <= lb + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY vol ORDER BY a) AS run FROM (SELECT *, lag(b) OVER (PARTITION BY vol ORDER BY a) AS lb FROM e))
SELECT vol, min(a) AS first_page, max(b) AS last_page FROM g GROUP BY vol, run""",
)
def w32_silent_windows(spark, sf):
    """Documents as pages of volumes of 400; a licence's name is a heading, common words are the text of a long act."""
    text = F.coalesce("text", F.lit(""))
    pages = table(spark, sf, "documents").select(F.floor(F.col("doc_id") / 400).alias("vol"), (F.col("doc_id") % 400 + 1).alias("page"), text.rlike("MIT").alias("heading"), text.rlike(" (der|les|la) ").alias("body"))
    return R.silent_windows(pages, "vol", "page", F.col("heading"), F.col("body"))


@query("j21_aligned_headings")
def j21_aligned_headings(spark, sf):
    """Tested against rounds in plain Python, with a chain of rivals."""
    h = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "O").alias("kept"), (F.dayofyear("o_orderdate") / 366).alias("pos"))
    return H.aligned_headings(h.filter("kept"), h.filter("NOT kept"), "o_custkey")


@query(
    "c22_busy_windows",
    """WITH i AS (SELECT event_type, epoch_us(ts) AS a, epoch_us(ts) + CAST(floor(value * 4) AS BIGINT) * 1000000 AS b FROM events WHERE floor(value * 4) >= 1),
p AS (SELECT event_type, t, sum(d) AS d FROM (SELECT event_type, a AS t, 1 AS d FROM i UNION ALL SELECT event_type, b, -1 FROM i) GROUP BY ALL HAVING sum(d) <> 0),
l AS (SELECT *, sum(d) OVER (PARTITION BY event_type ORDER BY t) AS level FROM p),
o AS (SELECT *, sum(CASE WHEN level >= 2 AND level - d < 2 THEN 1 ELSE 0 END) OVER (PARTITION BY event_type ORDER BY t) AS stretch FROM l WHERE level >= 2 OR level - d >= 2)
SELECT event_type, CAST(min(t) AS BIGINT) AS "begin", CAST(max(t) AS BIGINT) AS "end", CAST(max(level) AS BIGINT) AS peak FROM o GROUP BY event_type, stretch""",
)
def c22_busy_windows(spark, sf):
    """Events as work of four seconds for each unit of their value: when two or more of a kind were at work."""
    begin = F.unix_micros(F.col("ts").cast("timestamp"))
    work = table(spark, sf, "events").select("event_type", begin.alias("a"), (begin + F.floor(F.col("value") * 4).cast("long") * 1_000_000).alias("b"))
    return sweep.busy_windows(work, "event_type", "a", "b")
