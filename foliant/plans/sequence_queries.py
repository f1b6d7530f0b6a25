"""Sequence operators over acts made from ``events``: a volume is a user, a position the rank by time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import sequence as S
from ..registry import query, table

#: n: the true number with a jump of 3 after each 40 positions; read: what was read, garbled in some unclean rows.
ACTS = """acts AS (
  SELECT vol, pos, event_id, event_type, value, n, clean, page,
         CASE WHEN clean THEN n WHEN event_id % 3 = 0 THEN n * 10 + 7 WHEN event_id % 3 = 1 THEN n ELSE n + 1 END AS read
  FROM (SELECT user_id AS vol, event_id, event_type, value, event_type <> 'error' AS clean,
               row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos,
               row_number() OVER (PARTITION BY user_id ORDER BY event_id) + 3 * ((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 40) AS n,
               10 + 2 * (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) - (event_id % 3) AS page
        FROM events))"""


def acts(spark, sf) -> DataFrame:
    e = table(spark, sf, "events").select(F.col("user_id").alias("vol"), "event_id", "event_type", "value", (F.col("event_type") != "error").alias("clean"))
    e = S.ordinals(e, ["vol"], ["event_id"], "pos")
    e = e.withColumns({"n": F.col("pos") + 1 + 3 * F.floor(F.col("pos") / 40), "page": 10 + 2 * F.col("pos") - F.col("event_id") % 3})
    read = F.when(F.col("clean"), F.col("n")).when(F.col("event_id") % 3 == 0, F.col("n") * 10 + 7).when(F.col("event_id") % 3 == 1, F.col("n")).otherwise(F.col("n") + 1)
    return e.withColumn("read", read)


NUMBERS = "numbers AS (SELECT o_custkey % 20 AS k, o_orderkey % 900 AS n FROM orders WHERE o_orderstatus = 'F')"


def numbers(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").filter("o_orderstatus = 'F'").select((F.col("o_custkey") % 20).alias("k"), (F.col("o_orderkey") % 900).alias("n"))


@query("w03_ordinals", "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS ordinal FROM orders")
def w03_ordinals(spark, sf):
    return S.ordinals(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("j11_anchors", f"""WITH {ACTS}, m AS (SELECT *, CASE WHEN clean THEN n END AS c FROM acts)
SELECT vol, pos, last_value(c IGNORE NULLS) OVER (PARTITION BY vol ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_n,
       first_value(c IGNORE NULLS) OVER (PARTITION BY vol ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_n FROM m""")
def j11_anchors(spark, sf):
    return S.neighbours(acts(spark, sf), ["vol"], ["pos"], F.col("clean"), ["n"]).select("vol", "pos", "prev_n", "next_n")


_TOTAL = "totals AS (SELECT k, max(n) AS total FROM numbers GROUP BY k)"
_MISSING = f"{NUMBERS}, {_TOTAL}, lost AS (SELECT k, i AS n FROM totals, range(1, 901) r(i) WHERE i <= total EXCEPT SELECT k, n FROM numbers)"


def lost(spark, sf) -> DataFrame:
    n = numbers(spark, sf)
    return S.missing(n, n.groupBy("k").agg(F.max("n").alias("total")), "k", "n", "total")


@query("w08_gaps", f"WITH {_MISSING} SELECT k, n FROM lost")
def w08_gaps(spark, sf):
    return lost(spark, sf)


_RUNS = "runs AS (SELECT k, min(n) AS run_start, max(n) AS run_end, count(*) AS run_length FROM (SELECT k, n, n - row_number() OVER (PARTITION BY k ORDER BY n) AS g FROM lost) GROUP BY k, g)"


@query("w09_islands", f"WITH {_MISSING}, {_RUNS} SELECT * FROM runs")
def w09_islands(spark, sf):
    return S.islands(lost(spark, sf), "k", "n")


@query(
    "w10_brackets",
    f"""WITH {_MISSING}, {_RUNS},
have AS (SELECT k, n, min(n * 3 % 500) AS page FROM numbers GROUP BY k, n),
nb AS (SELECT l.k, l.n, r.run_length, (SELECT max(h.n) FROM have h WHERE h.k = l.k AND h.n < l.n) AS lo, (SELECT min(h.n) FROM have h WHERE h.k = l.k AND h.n > l.n) AS hi
       FROM lost l JOIN runs r ON r.k = l.k AND l.n BETWEEN r.run_start AND r.run_end),
p AS (SELECT nb.*, a.page AS pa, b.page AS pb FROM nb LEFT JOIN have a ON a.k = nb.k AND a.n = nb.lo LEFT JOIN have b ON b.k = nb.k AND b.n = nb.hi)
SELECT k, n, lo, hi,
  CASE WHEN pa IS NOT NULL AND pb IS NOT NULL THEN greatest(1, least(pa, pb) - 2) WHEN pa IS NOT NULL THEN pa WHEN pb IS NOT NULL THEN greatest(1, pb - 6 - run_length) END AS first_page,
  CASE WHEN pa IS NOT NULL AND pb IS NOT NULL THEN greatest(pa, pb) + 2 WHEN pa IS NOT NULL THEN pa + 6 + run_length WHEN pb IS NOT NULL THEN pb END AS last_page,
  coalesce(pa IS NOT NULL AND pb IS NOT NULL AND abs(pb - pa) < run_length, false) AS implausible FROM p""",
)
def w10_brackets(spark, sf):
    have = numbers(spark, sf).groupBy("k", "n").agg(F.min(F.col("n") * 3 % 500).alias("page"))
    return S.brackets(have, lost(spark, sf), "k", "n", "page")


@query("w11_records", """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, max(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM orders)
WHERE b IS NULL OR o_totalprice > b""")
def w11_records(spark, sf):
    return S.records(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], ["o_orderkey"], "o_totalprice")


@query(
    "w07_span_end",
    """WITH l AS (SELECT l_orderkey, l_linenumber, min(l_partkey) % 50 AS page FROM lineitem GROUP BY ALL)
SELECT a.l_orderkey, a.l_linenumber, a.page, coalesce((SELECT min_by(b.page, b.l_linenumber) FROM l b WHERE b.l_orderkey = a.l_orderkey AND b.l_linenumber > a.l_linenumber AND b.page > a.page), a.page) AS end_page
FROM l a""",
)
def w07_span_end(spark, sf):
    l = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg((F.min("l_partkey") % 50).alias("page"))
    return S.span_end(l, ["l_orderkey"], ["l_linenumber"], "page")


_GAP = """g AS (SELECT *, {extra} sum(CAST(anchor AS BIGINT)) OVER (PARTITION BY vol ORDER BY pos) AS gap,
  last_value(CASE WHEN anchor THEN n END IGNORE NULLS) OVER (PARTITION BY vol ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pn,
  first_value(CASE WHEN anchor THEN n END IGNORE NULLS) OVER (PARTITION BY vol ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nn FROM a),
h AS (SELECT *, count(*) OVER (PARTITION BY vol, gap, anchor) AS rows_, row_number() OVER (PARTITION BY vol, gap, anchor ORDER BY pos) AS r,
  {bad} AS bad, CASE WHEN pn IS NULL AND nn IS NOT NULL THEN 0 ELSE pn END AS lo, CASE WHEN nn IS NULL AND pn IS NOT NULL THEN {top} ELSE nn END AS hi FROM g)
SELECT vol, pos, CASE WHEN anchor THEN n WHEN hi - lo - 1 = rows_ AND NOT bad THEN lo + r END AS filled,
  CASE WHEN anchor THEN 'anchor' WHEN hi - lo - 1 = rows_ AND NOT bad THEN 'filled' ELSE 'ambiguous' END AS status FROM h"""


@query("w16_gap_fill", f"WITH {ACTS}, a AS (SELECT *, clean AS anchor FROM acts), " + _GAP.format(extra="", bad="false", top="NULL"))
def w16_gap_fill(spark, sf):
    return S.gap_fill(acts(spark, sf), ["vol"], ["pos"], "n", F.col("clean")).select("vol", "pos", "filled", "status")


@query(
    "w17_gap_fill_witness",
    f"WITH {ACTS}, a AS (SELECT *, clean AS anchor, max(n) OVER (PARTITION BY vol) AS total FROM acts), "
    + _GAP.format(extra="", bad="bool_or(read > 2 * n) OVER (PARTITION BY vol, gap, anchor)", top="total + 1"),
)
def w17_gap_fill_witness(spark, sf):
    a = acts(spark, sf).withColumn("total", F.max("n").over(Window.partitionBy("vol")))
    return S.gap_fill(a, ["vol"], ["pos"], "n", F.col("clean"), total="total", conflict=F.col("read") > 2 * F.col("n")).select("vol", "pos", "filled", "status")


@query(
    "w18_certify_unique",
    f"""WITH {ACTS}, t AS (SELECT vol, max(n) - 2 AS total FROM acts GROUP BY vol),
c AS (SELECT vol, pos, CASE WHEN read = n + (event_id % 5) // 4 AND read BETWEEN 1 AND total THEN read END AS u FROM acts JOIN t USING (vol))
SELECT vol, pos, CASE WHEN count(u) OVER (PARTITION BY vol, u) = 1 THEN u END AS certified FROM c""",
)
def w18_certify_unique(spark, sf):
    a = acts(spark, sf)
    totals = a.groupBy("vol").agg((F.max("n") - 2).alias("total"))
    a = a.withColumn("witnesses", F.array(F.col("read"), F.lit(None).cast("long"), F.col("n") + F.floor(F.col("event_id") % 5 / 4)))
    return S.certify_unique(a, "vol", "witnesses", totals, "total").select("vol", "pos", "certified")


@query(
    "w19_fill_not_taken",
    f"WITH {ACTS}, a AS (SELECT *, clean AS anchor FROM acts), f AS (SELECT * FROM (WITH "
    + _GAP.format(extra="", bad="false", top="NULL")
    + """)) SELECT f.vol, f.pos, f.filled FROM f WHERE status = 'filled' AND NOT EXISTS (SELECT 1 FROM acts t WHERE t.vol = f.vol AND t.read = f.filled AND t.event_type = 'click')""",
)
def w19_fill_not_taken(spark, sf):
    """Filled numbers that no certified act of the volume has taken."""
    a = acts(spark, sf)
    filled = S.gap_fill(a, ["vol"], ["pos"], "n", F.col("clean")).filter("status = 'filled'").select("vol", "pos", "filled")
    taken = a.filter("event_type = 'click'").select("vol", F.col("read").alias("filled")).distinct()
    return filled.join(taken, ["vol", "filled"], "left_anti").select("vol", "pos", "filled")


@query(
    "w20_one_per_page",
    f"""WITH {ACTS}, a AS (SELECT *, clean AS anchor FROM acts WHERE page % 4 <> 1 OR clean), b AS (SELECT *, row_number() OVER (PARTITION BY vol, page, clean ORDER BY pos) AS k FROM a)
SELECT vol, page, pos FROM b WHERE NOT clean AND k = 1""",
)
def w20_one_per_page(spark, sf):
    a = acts(spark, sf).filter("NOT clean AND page % 4 <> 1")
    return a.groupBy("vol", "page").agg(F.min("pos").alias("pos"))


@query(
    "w22_interpolated",
    f"""WITH {ACTS}, m AS (SELECT *, CASE WHEN clean THEN pos END AS cp, CASE WHEN clean THEN n END AS cn, max(n) OVER (PARTITION BY vol) AS total FROM acts),
k AS (SELECT *, last_value(cp IGNORE NULLS) OVER p AS pp, last_value(cn IGNORE NULLS) OVER p AS pn, first_value(cp IGNORE NULLS) OVER f AS np, first_value(cn IGNORE NULLS) OVER f AS nn FROM m
  WINDOW p AS (PARTITION BY vol ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), f AS (PARTITION BY vol ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT vol, pos, read, abs(read - (pn + (nn - pn) * (pos - pp) / (np - pp))) <= greatest(12, 0.03 * total) AS plausible FROM k WHERE NOT clean AND pp IS NOT NULL AND np IS NOT NULL""",
)
def w22_interpolated(spark, sf):
    a = acts(spark, sf).withColumn("total", F.max("n").over(Window.partitionBy("vol")))
    near = S.neighbours(a, ["vol"], ["pos"], F.col("clean"), ["pos", "n"]).filter("NOT clean AND prev_pos IS NOT NULL AND next_pos IS NOT NULL")
    want = F.expr("prev_n + (next_n - prev_n) * (pos - prev_pos) / (next_pos - prev_pos)")
    return near.select("vol", "pos", "read", (F.abs(F.col("read") - want) <= F.greatest(F.lit(12.0), 0.03 * F.col("total"))).alias("plausible"))


_NEAR = """k AS (SELECT *, last_value(cp IGNORE NULLS) OVER p AS pp, last_value(cn IGNORE NULLS) OVER p AS pn, first_value(cp IGNORE NULLS) OVER f AS np, first_value(cn IGNORE NULLS) OVER f AS nn
  FROM (SELECT *, CASE WHEN clean THEN pos END AS cp, CASE WHEN clean THEN n END AS cn FROM acts)
  WINDOW p AS (PARTITION BY vol ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), f AS (PARTITION BY vol ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))"""


@query("w23_reconstruct", f"WITH {ACTS}, {_NEAR} SELECT vol, pos, CASE WHEN NOT clean AND nn - pn = np - pp THEN pn + pos - pp END AS filled FROM k")
def w23_reconstruct(spark, sf):
    return S.reconstruct(acts(spark, sf), ["vol"], "pos", "n", F.col("clean")).select("vol", "pos", "filled")


@query(
    "w24_five_tier",
    f"""WITH {ACTS}, {_NEAR}, c AS (SELECT *, pn + pos - pp AS up, nn - np + pos AS down FROM k WHERE NOT clean),
d AS (SELECT *, CASE WHEN pn IS NOT NULL AND nn IS NOT NULL AND nn <= pn THEN NULL WHEN pn IS NOT NULL THEN up WHEN nn IS NOT NULL THEN down END AS fill FROM c),
t AS (SELECT *, CASE
  WHEN nn > pn AND nn - pn = np - pp THEN 'AUTO' WHEN nn <= pn THEN 'REVIEW' WHEN pn IS NOT NULL AND nn IS NOT NULL AND up = read AND up < nn THEN 'CONFIRMED'
  WHEN pn < read AND read < nn THEN 'OCR_PLAUSIBLE' WHEN nn IS NULL AND up = read THEN 'CONFIRMED' WHEN nn IS NULL AND read > pn THEN 'OCR_PLAUSIBLE'
  WHEN pn IS NULL AND down > 0 AND down = read THEN 'CONFIRMED' WHEN pn IS NULL AND read > 0 AND read < nn THEN 'OCR_PLAUSIBLE'
  WHEN fill IS NOT NULL AND read <> fill AND list_contains([left(CAST(read AS VARCHAR), i - 1) || substr(CAST(read AS VARCHAR), i + 1) FOR i IN range(1, length(CAST(read AS VARCHAR)) + 1)], CAST(fill AS VARCHAR)) AND length(CAST(read AS VARCHAR)) > 1 THEN 'MODERN_DIGITFIX'
  ELSE 'REVIEW' END AS tier FROM d)
SELECT vol, pos, read, tier, CASE WHEN tier IN ('AUTO', 'MODERN_DIGITFIX') THEN fill WHEN tier <> 'REVIEW' THEN read END AS corrected FROM t""",
)
def w24_five_tier(spark, sf):
    # the neighbours' numbers are the true ones, the row's own the one that was read
    a = acts(spark, sf).select("vol", "pos", "clean", F.col("read").alias("n"), F.col("read").cast("string").alias("raw"))
    return S.five_tiers(a, ["vol"], "pos", "n", "raw", F.col("clean")).select("vol", "pos", F.col("n").alias("read"), "tier", "corrected")


@query(
    "w25_breaks",
    """WITH s AS (SELECT o_custkey, o_orderkey, o_orderkey - lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS step FROM orders),
m AS (SELECT o_custkey, list_sort(list(step))[len(list(step)) // 2 + 1] AS typical FROM s WHERE step IS NOT NULL AND step <> 0 GROUP BY o_custkey)
SELECT s.o_custkey, o_orderkey, step, coalesce(step > greatest(5 * typical, 30), false) AS is_break FROM s LEFT JOIN m USING (o_custkey)""",
)
def w25_breaks(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return S.breaks(o, "o_custkey", ["o_orderkey"], "o_orderkey").select("o_custkey", "o_orderkey", "step", "is_break")


@query("w26_later_duplicates", """SELECT l_orderkey, l_partkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_partkey % 10 ORDER BY l_linenumber, l_partkey, l_suppkey) > 1 AS later FROM lineitem""")
def w26_later_duplicates(spark, sf):
    by = Window.partitionBy("l_orderkey", F.col("l_partkey") % 10).orderBy("l_linenumber", "l_partkey", "l_suppkey")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", (F.row_number().over(by) > 1).alias("later"))


_STEPS = "s AS (SELECT k, n, n - lag(n) OVER (PARTITION BY k ORDER BY n) AS step FROM (SELECT DISTINCT k, n FROM numbers))"


@query("w27_contiguous_top", f"WITH {NUMBERS}, {_STEPS}, b AS (SELECT *, count(*) FILTER (step > 15) OVER (PARTITION BY k ORDER BY n) AS g FROM s) SELECT k, max(n) AS top FROM b WHERE g = 0 AND (step IS NULL OR step <= 5) GROUP BY k")
def w27_contiguous_top(spark, sf):
    return S.contiguous_top(numbers(spark, sf), "k", "n")


@query(
    "w28_primary_cluster",
    """WITH numbers AS (SELECT l_suppkey % 10 AS k, l_orderkey * (CASE WHEN l_orderkey % 11 = 0 THEN 40 ELSE 1 END) AS n FROM lineitem WHERE l_linenumber = 1),
s AS (SELECT k, n, n - lag(n) OVER (PARTITION BY k ORDER BY n) AS step FROM (SELECT DISTINCT k, n FROM numbers)),
c AS (SELECT *, count(*) FILTER (step > 1000) OVER (PARTITION BY k ORDER BY n) AS g FROM s),
z AS (SELECT k, g, min(n) AS lo, max(n) AS hi, count(*) AS size FROM c GROUP BY k, g),
b AS (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY k ORDER BY size DESC, lo) = 1)
SELECT b.k, b.lo, b.hi, b.size, count(*) FILTER (c.n > b.hi * 2.5) AS outliers FROM b JOIN c ON c.k = b.k GROUP BY ALL""",
)
def w28_primary_cluster(spark, sf):
    n = table(spark, sf, "lineitem").filter("l_linenumber = 1").select((F.col("l_suppkey") % 10).alias("k"), (F.col("l_orderkey") * F.when(F.col("l_orderkey") % 11 == 0, 40).otherwise(1)).alias("n"))
    return S.primary_cluster(n, "k", "n")


@query("w29_supported_ceiling", f"WITH {NUMBERS}, {_STEPS} SELECT k, coalesce(max(n) FILTER (step <= 2 OR n = 1), max(n)) AS ceiling FROM s GROUP BY k")
def w29_supported_ceiling(spark, sf):
    return S.supported_ceiling(numbers(spark, sf), "k", "n")


@query(
    "w31_sessions",
    """SELECT e.event_id, e.user_id, (SELECT max_by(b.event_type, b.event_id) FROM events b WHERE b.user_id = e.user_id AND b.event_id <= e.event_id AND b.event_id % 10 = 0) AS label
FROM events e WHERE e.event_id % 10 <> 0""",
)
def w31_sessions(spark, sf):
    e = table(spark, sf, "events")
    return S.sessions(e.filter("event_id % 10 <> 0").select("user_id", "event_id"), e.filter("event_id % 10 = 0").select("user_id", "event_id", F.col("event_type").alias("label")), "user_id", "event_id", "label")


@query(
    "w32_empty_windows",
    """WITH found AS (SELECT o_custkey AS k, (o_orderkey * 13) % 3000 AS page FROM orders WHERE o_orderpriority = '1-URGENT'),
w AS (SELECT k, s AS a, least(s + 75, 3000) - 1 AS b FROM (SELECT DISTINCT k FROM found), range(0, 3000, 37) r(s)),
e AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.k = w.k AND f.page BETWEEN w.a AND w.b)),
g AS (SELECT *, sum(CASE WHEN a <= lb + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY a) AS run FROM (SELECT *, lag(b) OVER (PARTITION BY k ORDER BY a) AS lb FROM e))
SELECT k, min(a) AS first_page, max(b) AS last_page FROM g GROUP BY k, run""",
)
def w32_empty_windows(spark, sf):
    f = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("k"), (F.col("o_orderkey") * 13 % 3000).alias("page"))
    return S.empty_windows(f, f.select("k").distinct().withColumn("length", F.lit(3000).cast("long")), "k", "page", "length")


@query(
    "w34_first_four",
    """WITH f AS (SELECT user_id, event_id, value > (SELECT 0.3 * median(value) FROM events) AS f FROM events),
s AS (SELECT *, sum(CAST(f AS INT)) OVER w AS on_, count(*) OVER w AS n FROM f WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING))
SELECT user_id, min(event_id) AS start FROM s WHERE on_ = 4 AND n = 4 GROUP BY user_id""",
)
def w34_first_four(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "value")
    limit = e.agg((0.3 * F.median("value")).alias("limit"))
    return S.first_run(e.crossJoin(F.broadcast(limit)), "user_id", ["event_id"], F.col("value") > F.col("limit"), 4, "event_id")


@query(
    "w04_segments",
    """WITH e AS (SELECT user_id, event_id, event_type, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS segment FROM events)
SELECT user_id, CAST(segment AS BIGINT) AS segment, min(event_id) AS first_event, count(*) AS n, string_agg(event_type, ' ' ORDER BY event_id) AS body FROM e WHERE segment > 0 GROUP BY ALL""",
)
def w04_segments(spark, sf):
    """A header opens a segment, which runs to the next header."""
    by = Window.partitionBy("user_id").orderBy("event_id")
    e = table(spark, sf, "events").withColumn("segment", F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).over(by)).filter("segment > 0")
    return e.groupBy("user_id", "segment").agg(
        F.min("event_id").alias("first_event"),
        F.count("*").alias("n"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda s: s["event_type"]), " ").alias("body"),
    )


@query("w05_lookahead", """SELECT user_id, event_id, list_aggregate(list(event_type) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING), 'string_agg', '|') AS ahead FROM events WHERE event_type <> 'view'""")
def w05_lookahead(spark, sf):
    by = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(1, 4)
    e = table(spark, sf, "events").filter("event_type <> 'view'")
    ahead = F.collect_list("event_type").over(by)
    return e.select("user_id", "event_id", F.when(F.size(ahead) > 0, F.array_join(ahead, "|")).alias("ahead"))


_STEP = """FROM r JOIN acts a ON a.vol = r.vol AND a.pos = r.pos + 1"""


@query("w06_min_gap", f"""WITH RECURSIVE {ACTS.replace("acts AS (", "acts AS MATERIALIZED (", 1)}, r AS (SELECT vol, pos, event_id AS "at", true AS kept, event_id AS last FROM acts WHERE pos = 0
UNION ALL SELECT a.vol, a.pos, a.event_id, a.event_id - r.last >= 200, CASE WHEN a.event_id - r.last >= 200 THEN a.event_id ELSE r.last END {_STEP}) SELECT vol, pos, "at", kept FROM r""")
def w06_min_gap(spark, sf):
    e = acts(spark, sf).withColumn("at", F.col("event_id"))
    return S.greedy(e, "vol", "pos", "at", "kept_by_gap", gap=200)


@query("w12_increasing_chain")
def w12_increasing_chain(spark, sf):
    return S.chosen(acts(spark, sf), "vol", "pos", "read", "increasing_chain")


@query("w14_robust_line")
def w14_robust_line(spark, sf):
    return S.chosen(acts(spark, sf), "vol", "pos", "read", "robust_line")


@query("w15_pruned_chain", f"""WITH RECURSIVE {ACTS.replace("acts AS (", "acts AS MATERIALIZED (", 1)}, r AS (SELECT vol, pos, CAST(read AS BIGINT) AS read, true AS kept, pos AS lp, CAST(read AS BIGINT) AS lv FROM acts WHERE pos = 0
UNION ALL SELECT vol, pos, read, kept, CASE WHEN kept THEN pos ELSE lp END, CASE WHEN kept THEN read ELSE lv END FROM (SELECT a.vol, a.pos, CAST(a.read AS BIGINT) AS read, a.read - r.lv <= a.pos - r.lp + 60 AS kept, r.lp, r.lv {_STEP})) SELECT vol, pos, read, kept FROM r""")
def w15_pruned_chain(spark, sf):
    return S.greedy(acts(spark, sf), "vol", "pos", "read", "pruned_chain", slack=60)


@query("w30_split_runs", f"""WITH RECURSIVE {ACTS.replace("acts AS (", "acts AS MATERIALIZED (", 1)}, r AS (SELECT vol, pos, pos % 23 + 1 AS m, CAST(0 AS BIGINT) AS run, pos % 23 + 1 AS top FROM acts WHERE pos = 0
UNION ALL SELECT vol, pos, m, CASE WHEN new THEN run + 1 ELSE run END, CASE WHEN new THEN m ELSE greatest(m, top) END FROM (SELECT a.vol, a.pos, a.pos % 23 + 1 AS m, a.pos % 23 + 1 <= 5 AND a.pos % 23 + 1 < r.top - 2 AS new, r.run, r.top {_STEP})) SELECT vol, pos, m, run FROM r""")
def w30_split_runs(spark, sf):
    return S.greedy(acts(spark, sf).withColumn("m", F.col("pos") % 23 + 1), "vol", "pos", "m", "split_runs")


_CHECKPOINTS = "c AS (SELECT vol, n AS filled, min(p) AS lo, max(p) AS hi FROM (SELECT vol, n, page + CASE WHEN event_id % 7 = 0 THEN 9 ELSE event_id % 3 END AS p FROM acts WHERE NOT clean AND event_id % 2 = 0) GROUP BY ALL)"


@query("w21_checkpoint_fill", f"""WITH {ACTS}, m AS (SELECT *, CASE WHEN clean THEN n END AS c, count(CASE WHEN clean THEN 1 END) OVER (PARTITION BY vol ORDER BY pos) AS gap FROM acts), {_CHECKPOINTS},
k AS (SELECT *, last_value(c IGNORE NULLS) OVER (PARTITION BY vol ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS a, first_value(c IGNORE NULLS) OVER (PARTITION BY vol ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS z, count(*) OVER (PARTITION BY vol, gap, clean) AS rows_, row_number() OVER (PARTITION BY vol, gap, clean ORDER BY pos) AS rank_ FROM m),
f AS (SELECT *, CASE WHEN clean THEN n WHEN z - coalesce(a, 0) - 1 = rows_ THEN coalesce(a, 0) + rank_ END AS fill FROM k),
h AS (SELECT f.vol, pos, gap, clean, fill, CASE WHEN NOT clean AND lo IS NOT NULL THEN page BETWEEN lo - 2 AND hi + 2 END AS holds FROM f LEFT JOIN c ON c.vol = f.vol AND c.filled = f.fill),
v AS (SELECT vol, gap, bool_and(holds) AS every_, count(holds) AS n_ FROM h WHERE NOT clean AND fill IS NOT NULL GROUP BY ALL)
SELECT h.vol, pos, CASE WHEN clean OR n_ = 0 OR every_ THEN CAST(fill AS BIGINT) END AS filled, CASE WHEN clean THEN 'anchor' WHEN fill IS NULL THEN 'ambiguous' WHEN n_ = 0 THEN 'loose' WHEN every_ THEN 'strict' ELSE 'rejected' END AS status FROM h LEFT JOIN v ON v.vol = h.vol AND v.gap = h.gap""")
def w21_checkpoint_fill(spark, sf):
    a = acts(spark, sf)
    placed = a.filter("NOT clean AND event_id % 2 = 0").select("vol", "n", (F.col("page") + F.when(F.col("event_id") % 7 == 0, 9).otherwise(F.col("event_id") % 3)).alias("page"))
    return S.checkpoint_fill(a, "vol", "pos", "n", "page", F.col("clean"), placed).select("vol", "pos", "filled", "status")
