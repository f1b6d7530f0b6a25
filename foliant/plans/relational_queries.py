"""Joins, aggregates, samples, set operations, predicates and constraints over the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import relational as R
from ..operators import sequence as S
from ..registry import query, table


# --- predicates ---------------------------------------------------------------------------------------


@query("p04_confident", "SELECT o_orderkey, o_totalprice > 1000 AND o_orderdate IS NOT NULL AND o_orderstatus <> 'P' AS confident FROM orders")
def p04_confident(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", ((F.col("o_totalprice") > 1000) & F.col("o_orderdate").isNotNull() & (F.col("o_orderstatus") != "P")).alias("confident"))


@query("p10_range_gate", """WITH t AS (SELECT n_nationkey, CASE WHEN n_nationkey % 5 <> 0 THEN n_nationkey * 40 END AS total FROM nation)
SELECT c_custkey, c_custkey >= 1 AND (total IS NULL OR c_custkey <= total) AS ok FROM customer JOIN t ON n_nationkey = c_nationkey""")
def p10_range_gate(spark, sf):
    t = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.when(F.col("n_nationkey") % 5 != 0, F.col("n_nationkey") * 40).alias("total"))
    ok = (F.col("c_custkey") >= 1) & (F.col("total").isNull() | (F.col("c_custkey") <= F.col("total")))
    return table(spark, sf, "customer").join(t, "c_nationkey").select("c_custkey", ok.alias("ok"))


@query("p15_witnesses_agree", "SELECT l_orderkey, count(DISTINCT l_returnflag) = 1 AS agree FROM lineitem GROUP BY l_orderkey")
def p15_witnesses_agree(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg((F.size(F.array_distinct(F.array_compact(F.collect_set("l_returnflag")))) == 1).alias("agree"))


@query("p16_stop_set", "SELECT event_id FROM events WHERE event_type NOT IN ('error', 'view')")
def p16_stop_set(spark, sf):
    return table(spark, sf, "events").filter(~F.col("event_type").isin("error", "view")).select("event_id")


@query("p17_page_monotonic", """WITH a AS (SELECT l_suppkey AS k, l_orderkey AS n, l_linenumber AS j, l_partkey % 400 AS page, l_returnflag = 'N' AS trusted FROM lineitem WHERE l_linenumber = 1),
b AS (SELECT *, max(CASE WHEN trusted THEN page END) OVER (PARTITION BY k ORDER BY n, page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lo, min(CASE WHEN trusted THEN page END) OVER (PARTITION BY k ORDER BY n, page ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS hi FROM a)
SELECT k, n, page FROM b WHERE NOT trusted AND (lo IS NULL OR page >= lo - 12) AND (hi IS NULL OR page <= hi + 12)""")
def p17_page_monotonic(spark, sf):
    a = table(spark, sf, "lineitem").filter("l_linenumber = 1").select(F.col("l_suppkey").alias("k"), F.col("l_orderkey").alias("n"), (F.col("l_partkey") % 400).alias("page"), (F.col("l_returnflag") == "N").alias("trusted"))
    by = Window.partitionBy("k").orderBy("n", "page")
    own = F.when(F.col("trusted"), F.col("page"))
    a = a.withColumns({"lo": F.max(own).over(by.rowsBetween(Window.unboundedPreceding, -1)), "hi": F.min(own).over(by.rowsBetween(1, Window.unboundedFollowing))})
    return a.filter("NOT trusted AND (lo IS NULL OR page >= lo - 12) AND (hi IS NULL OR page <= hi + 12)").select("k", "n", "page")


@query("p18_partial_unique", "SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1")
def p18_partial_unique(spark, sf):
    return table(spark, sf, "orders").filter("o_orderstatus = 'O' AND o_orderpriority IS NOT NULL").groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n > 1")


# --- joins --------------------------------------------------------------------------------------------


@query("j01_event_enactment", "SELECT l_orderkey, l_linenumber, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS enacted, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'")
def j01_event_enactment(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("enacted"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(o, "l_orderkey")


@query("j02_self_pairs", """SELECT a.o_custkey, a.o_orderkey AS a, b.o_orderkey AS b FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey
AND CAST(a.o_orderdate AS DATE) < CAST(b.o_orderdate AS DATE) + 10 AND CAST(b.o_orderdate AS DATE) < CAST(a.o_orderdate AS DATE) + 10""")
def j02_self_pairs(spark, sf):
    from ..operators.temporal import overlapping_pairs

    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("valid_from"))
    return overlapping_pairs(o.withColumn("valid_to", F.date_add("valid_from", 10)), "o_custkey", "o_orderkey")


@query("j03_orphans", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AND c_custkey NOT IN (SELECT user_id FROM events)")
def j03_orphans(spark, sf):
    return R.orphans(table(spark, sf, "customer").select("c_custkey"), "c_custkey", table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), table(spark, sf, "events").select(F.col("user_id").alias("c_custkey")))


@query("j04_semi", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def j04_semi(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(o, "l_orderkey", "left_semi")


@query("j05_delete_using", """SELECT l_orderkey, count(*) AS n FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey = l_orderkey AND c_mktsegment = 'BUILDING') GROUP BY l_orderkey""")
def j05_delete_using(spark, sf):
    c = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    gone = table(spark, sf, "orders").join(c, "o_custkey", "left_semi").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, sf, "lineitem").join(gone, "l_orderkey", "left_anti").groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("j06_insert_missing", """SELECT c_custkey AS k, c_nationkey AS nation FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, -1 FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 2 = 0""")
def j06_insert_missing(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nation"))
    return R.insert_missing(c.filter("k % 3 = 0"), c.filter("k % 2 = 0").withColumn("nation", F.lit(-1)), ["k"])


@query("j07_lookup_or_create", """WITH f AS (SELECT DISTINCT l_returnflag || l_linestatus AS code FROM lineitem)
SELECT code, code < 'N' AS is_new FROM f""")
def j07_lookup_or_create(spark, sf):
    f = table(spark, sf, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("code"))
    known = f.filter("code >= 'N'").distinct().select("code", F.lit(1).cast("long").alias("id"))
    return R.lookup_or_create(f, known, ["code"], "id").select("code", "is_new")


@query("j08_sieve", """WITH s AS (SELECT doc_id, CASE WHEN quality = 0 THEN 'LIST' ELSE 'TEXT' END AS shape FROM labels), r AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'BODY' WHEN 1 THEN 'NONBODY' ELSE 'AMBIGUOUS' END AS recon FROM documents WHERE doc_id % 4 = 0),
v AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'INDEX' ELSE 'BODY' END AS verdict FROM labels WHERE doc_id % 8 = 0),
j AS (SELECT d.doc_id, coalesce(shape, 'TEXT') AS shape, coalesce(recon, 'BODY') AS recon, verdict FROM documents d LEFT JOIN s USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN v USING (doc_id))
SELECT doc_id, CASE WHEN shape = 'TEXT' AND recon <> 'AMBIGUOUS' THEN 'SHAPE_BODY' WHEN recon = 'BODY' THEN 'RESCUED' WHEN recon = 'NONBODY' THEN 'CONFIRMED' WHEN verdict IS NULL THEN 'AMB_FAILED' WHEN verdict = 'INDEX' THEN 'AMB_REMOVED' ELSE 'AMB_BODY' END AS category FROM j""")
def j08_sieve(spark, sf):
    from .sieve import sieve

    d, l = table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels")
    shape = l.select("doc_id", F.when(F.col("quality") == 0, "LIST").otherwise("TEXT").alias("shape"))
    recon = d.filter("doc_id % 4 = 0").select("doc_id", F.when(F.col("doc_id") % 3 == 0, "BODY").when(F.col("doc_id") % 3 == 1, "NONBODY").otherwise("AMBIGUOUS").alias("recon"))
    verdict = l.filter("doc_id % 8 = 0").select("doc_id", F.when(F.col("toxic") == 1, "INDEX").otherwise("BODY").alias("verdict"))
    return sieve(d, shape, recon, verdict, ["doc_id"], nonbody=["LIST"], removing=["INDEX"]).select("doc_id", "category")


@query("j09_overlay", """SELECT d.doc_id, CASE WHEN l.doc_id % 2 = 0 AND l.doc_id IS NOT NULL THEN 'hand' WHEN l.toxic = 1 THEN 'model' WHEN l.doc_id IS NOT NULL THEN 'rule' ELSE lang END AS value FROM documents d LEFT JOIN labels l USING (doc_id)""")
def j09_overlay(spark, sf):
    l = table(spark, sf, "labels")
    layer = lambda df, v: df.select("doc_id", F.lit(v).alias("value"))
    return R.overlay(table(spark, sf, "documents").select("doc_id", F.col("lang").alias("value")), ["doc_id"], "value", [layer(l, "rule"), layer(l.filter("toxic = 1"), "model"), layer(l.filter("doc_id % 2 = 0"), "hand")])


@query("j10_span_join", """WITH s AS (SELECT o_orderkey, o_custkey AS k, o_orderkey % 50 AS a, o_orderkey % 50 + o_orderkey % 4 AS b FROM orders), p AS (SELECT DISTINCT c_custkey AS k, i AS page, (c_custkey * 7 + i) % 100 AS conf FROM customer, range(0, 60, 3) r(i))
SELECT o_orderkey, count(*) AS pages, CAST(sum(conf) AS BIGINT) AS conf FROM s JOIN p ON p.k = s.k AND page BETWEEN a AND b GROUP BY o_orderkey""")
def j10_span_join(spark, sf):
    s = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), (F.col("o_orderkey") % 50).alias("a"), (F.col("o_orderkey") % 50 + F.col("o_orderkey") % 4).alias("b"))
    p = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(57).cast("long"), F.lit(3).cast("long"))).alias("page"))
    p = p.withColumn("conf", (F.col("k") * 7 + F.col("page")) % 100)
    return R.pages_in_spans(s, p, "k", "a", "b", "page").groupBy("o_orderkey").agg(F.count("*").alias("pages"), F.sum("conf").alias("conf"))


@query("j12_reverse_map", "SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey")
def j12_reverse_map(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    return table(spark, sf, "customer").join(n, "c_nationkey", "left").select("c_custkey", "nation")


@query("j13_resolve_cascade", """SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'map' WHEN c_custkey % 5 = 0 THEN 'override' WHEN c_custkey % 3 = 0 THEN 'decode' ELSE 'S' || CAST(c_custkey % 10 AS VARCHAR) END AS canonical FROM customer""")
def j13_resolve_cascade(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    m = lambda k, v: (c.filter(f"c_custkey % {k} = 0").select("c_custkey", F.lit(v).alias("v")), "c_custkey", "v")
    return R.resolve(c, "c_custkey", [m(7, "map"), m(5, "override"), m(3, "decode")], F.concat(F.lit("S"), (F.col("c_custkey") % 10).cast("string")), "canonical")


@query("j17_cross_engine", """WITH e AS (SELECT conv_id, length(text) % 50 AS n, role AS engine FROM conversations) SELECT conv_id, n, count(DISTINCT engine) AS engines FROM e GROUP BY ALL HAVING count(DISTINCT engine) >= 2""")
def j17_cross_engine(spark, sf):
    e = table(spark, sf, "conversations").select("conv_id", (F.length("text") % 50).cast("long").alias("n"), F.col("role").alias("engine"))
    return e.groupBy("conv_id", "n").agg(F.countDistinct("engine").alias("engines")).filter("engines >= 2")


@query("j18_pairs", "SELECT a.l_orderkey, a.l_partkey AS a, b.l_partkey AS b FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey AND b.l_partkey - a.l_partkey <= 40")
def j18_pairs(spark, sf):
    l = table(spark, sf, "lineitem")
    side = lambda n: l.select("l_orderkey", F.col("l_partkey").alias(n))
    return side("a").join(side("b"), "l_orderkey").filter("a < b AND b - a <= 40")


@query("j19_verdicts", "SELECT a.quality AS one, b.toxic AS two, count(*) AS n FROM labels a JOIN labels b USING (doc_id) GROUP BY ALL")
def j19_verdicts(spark, sf):
    l = table(spark, sf, "labels")
    return R.confusion(l.select("doc_id", F.col("quality").alias("one")).join(l.select("doc_id", F.col("toxic").alias("two")), "doc_id"), "one", "two")


@query("j20_truth_join", """WITH t AS (SELECT doc_id FROM labels WHERE quality = 0), g AS (SELECT doc_id FROM documents WHERE regexp_matches(text, '[#$%&]{3}'))
SELECT CASE WHEN t.doc_id IS NULL THEN 'fp' WHEN g.doc_id IS NULL THEN 'fn' ELSE 'tp' END AS outcome, count(*) AS n FROM t FULL JOIN g ON t.doc_id = g.doc_id GROUP BY 1""")
def j20_truth_join(spark, sf):
    t = table(spark, sf, "labels").filter("quality = 0").select("doc_id", F.lit(True).alias("t"))
    g = table(spark, sf, "documents").filter(F.col("text").rlike("[#$%&]{3}")).select("doc_id", F.lit(True).alias("g"))
    return t.join(g, "doc_id", "full_outer").groupBy(F.when(F.col("t").isNull(), "fp").when(F.col("g").isNull(), "fn").otherwise("tp").alias("outcome")).agg(F.count("*").alias("n"))


# --- aggregates ---------------------------------------------------------------------------------------


@query("a01_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def a01_counts(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"))


@query("a02_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def a02_duplicates(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).filter("n > 1")


@query("a04_distribution", """SELECT user_id, round(avg(value), 6) AS mean, round(median(value), 6) AS median, count(*) FILTER (value > 20) AS high, count(*) FILTER (value > 5 AND value <= 20) AS mid, count(*) FILTER (value <= 5) AS low, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds FROM events GROUP BY user_id""")
def a04_distribution(spark, sf):
    n = lambda c: F.count_if(F.expr(c))
    return table(spark, sf, "events").groupBy("user_id").agg(F.round(F.avg("value"), 6).alias("mean"), F.round(F.median("value"), 6).alias("median"), n("value > 20").alias("high"), n("value > 5 AND value <= 20").alias("mid"), n("value <= 5").alias("low"), F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("kinds"))


@query("a05_quality_bucket", "SELECT user_id, CASE WHEN avg(value) IS NULL THEN 'unknown' WHEN avg(value) <= 9 THEN 'good' WHEN avg(value) <= 10 THEN 'fair' ELSE 'poor' END AS bucket FROM events GROUP BY user_id")
def a05_quality_bucket(spark, sf):
    m = F.avg("value")
    return table(spark, sf, "events").groupBy("user_id").agg(F.when(m.isNull(), "unknown").when(m <= 9, "good").when(m <= 10, "fair").otherwise("poor").alias("bucket"))


@query("a06_weighted_mean", "SELECT l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS mean FROM lineitem GROUP BY l_returnflag")
def a06_weighted_mean(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.round(F.sum(F.col("l_discount") * F.col("l_quantity")) / F.sum("l_quantity"), 6).alias("mean"))


@query("a07_unanimous", "SELECT l_orderkey, CASE WHEN count(DISTINCT l_linestatus) = 1 THEN min(l_linestatus) ELSE 'mixed' END AS status FROM lineitem GROUP BY l_orderkey")
def a07_unanimous(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.when(F.min("l_linestatus") == F.max("l_linestatus"), F.min("l_linestatus")).otherwise("mixed").alias("status"))


@query("a08_mode_first_seen", """WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS seen FROM events GROUP BY ALL)
SELECT user_id, event_type, n FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, seen) = 1""")
def a08_mode_first_seen(spark, sf):
    return R.mode_first_seen(table(spark, sf, "events"), ["user_id"], "event_type", ["event_id"])


@query("a09_first_fifty", """SELECT user_id, array_to_string(list(event_id ORDER BY event_id)[1:50], ',') AS first FROM events WHERE value < 10 GROUP BY user_id""")
def a09_first_fifty(spark, sf):
    e = table(spark, sf, "events").filter("value < 10").select("user_id", "event_id")
    return R.first_n(e, ["user_id"], ["event_id"], "event_id", 50, "first").select("user_id", F.array_join(F.transform("first", lambda x: x.cast("string")), ",").alias("first"))


@query("a10_era_tally", """SELECT CAST(year(o_orderdate) // 5 * 5 AS BIGINT) AS era, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) AS n, floor(count(*) FILTER (o_orderstatus = 'F') * 10000 / count(*)) / 100 AS f_percent FROM orders GROUP BY 1""")
def a10_era_tally(spark, sf):
    g = table(spark, sf, "orders").groupBy((F.floor(F.year("o_orderdate") / 5) * 5).cast("long").alias("era"))
    out = g.agg(F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.count_if(F.col("o_orderstatus") == "O").alias("o"), F.count("*").alias("n"))
    return out.withColumn("f_percent", R.floor_percent(F.col("f"), F.col("n")))


@query("a11_confusion", "SELECT quality, toxic, count(*) AS n FROM labels GROUP BY ALL")
def a11_confusion(spark, sf):
    return R.confusion(table(spark, sf, "labels"), "quality", "toxic")


@query("a12_prf", """WITH j AS (SELECT lang, quality = 0 AS t, regexp_matches(text, '[#$%&]{3}|[|]') AS g FROM documents JOIN labels USING (doc_id)),
c AS (SELECT lang, count(*) FILTER (t AND g) AS tp, count(*) FILTER (NOT t AND g) AS fp, count(*) FILTER (t AND NOT g) AS fn, count(*) FILTER (NOT t AND NOT g) AS tn FROM j GROUP BY lang)
SELECT lang, tp, fp, fn, tn, CASE WHEN tp + fp = 0 THEN 0 ELSE round(tp / (tp + fp), 6) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE round(tp / (tp + fn), 6) END AS recall,
CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE round(2 * tp / (2 * tp + fp + fn), 6) END AS f1, round((tp + tn) / (tp + fp + fn + tn), 6) AS agreement FROM c""")
def a12_prf(spark, sf):
    j = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return R.precision_recall(j, F.col("quality") == 0, F.col("text").rlike("[#$%&]{3}|[|]"), ["lang"])


_COMPLETE = """WITH h AS (SELECT o_custkey % 30 AS k, o_orderkey % 300 AS n FROM orders), t AS (SELECT k, CAST(100 + 20 * k AS BIGINT) AS total FROM (SELECT DISTINCT k FROM h)),
f AS (SELECT k, total, (SELECT count(DISTINCT n) FROM h WHERE h.k = t.k AND n BETWEEN 1 AND total) AS found FROM t)"""


@query("a13_completeness", f"{_COMPLETE} SELECT k, total, found, floor(found * 10000 / total) / 100 AS percent, CASE WHEN total = found THEN 'CLEAN' WHEN total - found <= 5 THEN 'SMALL' WHEN found * 2 >= total THEN 'LARGE' ELSE 'ANOMALY' END AS bucket FROM f")
def a13_completeness(spark, sf):
    h = table(spark, sf, "orders").select((F.col("o_custkey") % 30).alias("k"), (F.col("o_orderkey") % 300).alias("n"))
    return R.completeness(h, h.select("k").distinct().withColumn("total", 100 + 20 * F.col("k")), "k", "n", "total")


@query("a14_gap_adjusted", f"""{_COMPLETE}, g AS (SELECT k, i AS n FROM t, range(1, 40) r(i) WHERE i % 9 = 4), e AS (SELECT g.k, count(*) AS gaps FROM g WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.k = g.k AND h.n = g.n) GROUP BY g.k)
SELECT f.k, total - coalesce(gaps, 0) AS effective, found FROM f LEFT JOIN e USING (k)""")
def a14_gap_adjusted(spark, sf):
    h = table(spark, sf, "orders").select((F.col("o_custkey") % 30).alias("k"), (F.col("o_orderkey") % 300).alias("n"))
    totals = h.select("k").distinct().withColumn("total", 100 + 20 * F.col("k"))
    known = totals.select("k", F.explode(F.array(*(F.lit(i).cast("long") for i in range(4, 40, 9)))).alias("n"))
    gaps = known.join(h.distinct(), ["k", "n"], "left_anti").groupBy("k").agg(F.count("*").alias("gaps"))
    return R.completeness(h, totals, "k", "n", "total").join(gaps, "k", "left").select("k", (F.col("total") - F.coalesce("gaps", F.lit(0))).alias("effective"), "found")


@query("a15_recall_before_after", """WITH b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 2 = 0)
SELECT c_nationkey AS nation, count(*) AS n, count(b.k) AS before, count(coalesce(b.k, a.k)) AS after FROM customer LEFT JOIN b ON b.k = c_custkey LEFT JOIN a ON a.k = c_custkey GROUP BY 1""")
def a15_recall_before_after(spark, sf):
    o = table(spark, sf, "orders")
    tagged = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.bool_or(F.col("o_orderstatus") == "F").alias("b"), F.bool_or((F.col("o_orderstatus") == "F") | ((F.col("o_orderstatus") == "O") & (F.col("o_orderkey") % 2 == 0))).alias("a"))
    j = table(spark, sf, "customer").join(tagged, "c_custkey", "left")
    return j.groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("n"), F.count_if("b").alias("before"), F.count_if("a").alias("after"))


@query("a17_rule_tally", """SELECT CASE WHEN value > 50 THEN 'huge' WHEN value > 20 THEN 'large' WHEN event_type = 'error' THEN 'error' ELSE 'plain' END AS rule, count(*) AS n FROM events GROUP BY 1""")
def a17_rule_tally(spark, sf):
    v = F.col("value")
    return table(spark, sf, "events").groupBy(F.when(v > 50, "huge").when(v > 20, "large").when(F.col("event_type") == "error", "error").otherwise("plain").alias("rule")).agg(F.count("*").alias("n"))


@query("a19_top_clusters", """WITH c AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS bad, count(*) AS n FROM events GROUP BY user_id)
SELECT user_id, bad, round(bad / n, 6) AS density FROM c ORDER BY bad DESC, user_id LIMIT 20""")
def a19_top_clusters(spark, sf):
    c = table(spark, sf, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("bad"), F.count("*").alias("n"))
    return c.select("user_id", "bad", R.ratio(F.col("bad"), F.col("n")).alias("density")).orderBy(F.desc("bad"), "user_id").limit(20)


@query("a19_densest_clusters", """WITH c AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS bad, count(*) AS n FROM events GROUP BY user_id HAVING count(*) >= 5)
SELECT user_id, bad, round(bad / n, 6) AS density FROM c ORDER BY bad / n DESC, bad DESC, user_id LIMIT 20""")
def a19_densest_clusters(spark, sf):
    """Clusters of five or more, by the share of what is flagged in them."""
    c = table(spark, sf, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("bad"), F.count("*").alias("n")).filter("n >= 5")
    return c.select("user_id", "bad", R.ratio(F.col("bad"), F.col("n")).alias("density"), (F.col("bad") / F.col("n")).alias("d_")).orderBy(F.desc("d_"), F.desc("bad"), "user_id").limit(20).drop("d_")


@query("a20_sums", "SELECT lang, count(*) AS docs, CAST(sum(n_chars) AS BIGINT) AS chars, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS lines FROM documents GROUP BY lang")
def a20_sums(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("docs"), F.sum("n_chars").alias("chars"), F.sum(F.size(F.split("text", "\n"))).alias("lines"))


@query("a22_tier_matrix", """WITH c AS (SELECT o_custkey, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY ALL), t AS (SELECT CASE WHEN n = 1 THEN '1' WHEN n < 10 THEN '2-9' ELSE '10+' END AS tier, p, n FROM c)
SELECT tier, p, count(*) AS types, CAST(sum(n) AS BIGINT) AS occurrences FROM t GROUP BY CUBE (tier, p)""")
def a22_tier_matrix(spark, sf):
    c = table(spark, sf, "orders").groupBy("o_custkey", F.col("o_orderpriority").alias("p")).agg(F.count("*").alias("n"))
    tier = F.when(F.col("n") == 1, "1").when(F.col("n") < 10, "2-9").otherwise("10+")
    return c.withColumn("tier", tier).cube("tier", "p").agg(F.count("*").alias("types"), F.sum("n").alias("occurrences"))


@query("a23_stddev_pop", "SELECT user_id, round(stddev_pop(value), 6) AS sd FROM events GROUP BY user_id")
def a23_stddev_pop(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.round(F.stddev_pop("value"), 6).alias("sd"))


@query("a24_medians", "SELECT o_custkey, round(median(o_totalprice), 6) AS median, list_sort(list(o_totalprice))[len(list(o_totalprice)) // 2 + 1] AS upper_median FROM orders GROUP BY o_custkey")
def a24_medians(spark, sf):
    """A median between two values is their mean; the upper median is the later of the two."""
    o = table(spark, sf, "orders").select("o_custkey", "o_totalprice")
    median = o.groupBy("o_custkey").agg(F.round(F.median("o_totalprice"), 6).alias("median"))
    return median.join(S.upper_median(o, "o_custkey", "o_totalprice", "upper_median"), "o_custkey")


@query("a27_jaccard", """WITH w AS (SELECT conv_id, turn, list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) AS b, lag(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+'))) OVER (PARTITION BY conv_id ORDER BY turn) AS a FROM conversations)
SELECT conv_id, turn, CASE WHEN len(list_distinct(list_concat(a, b))) = 0 THEN 0.0 ELSE round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) END AS jaccard FROM w WHERE a IS NOT NULL""")
def a27_jaccard(spark, sf):
    """Each turn's words beside those of the turn before it."""
    w = table(spark, sf, "conversations").select("conv_id", "turn", F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z]+"), 0)).alias("b"))
    before = F.lag("b").over(Window.partitionBy("conv_id").orderBy("turn"))
    return w.withColumn("a", before).filter("a IS NOT NULL").select("conv_id", "turn", F.round(R.jaccard(F.col("a"), F.col("b")), 6).alias("jaccard"))


@query("a28_extremes", "SELECT o_orderpriority, min(o_totalprice) AS lo, max(o_totalprice) AS hi, round(avg(o_totalprice), 6) AS mean FROM orders GROUP BY 1")
def a28_extremes(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"), F.round(F.avg("o_totalprice"), 6).alias("mean"))


@query("a29_distinct", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def a29_distinct(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))


# --- sort, limit, sample ------------------------------------------------------------------------------


@query("o02_top_tokens", """SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents) GROUP BY token ORDER BY n DESC, token LIMIT 100""")
def o02_top_tokens(spark, sf):
    t = table(spark, sf, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), 0)).alias("token"))
    return t.groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token").limit(100)


@query("o03_oldest_claimable", "SELECT o_orderpriority, min_by(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders WHERE o_orderstatus = 'O' GROUP BY o_orderpriority")
def o03_oldest_claimable(spark, sf):
    return table(spark, sf, "orders").filter("o_orderstatus = 'O'").groupBy("o_orderpriority").agg(F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("o_orderkey"))


@query("o05_best_of", "SELECT l_orderkey, min_by(l_linenumber, (abs(l_quantity - 25), -l_extendedprice, l_linenumber)) AS best FROM lineitem GROUP BY l_orderkey")
def o05_best_of(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.min_by("l_linenumber", F.struct(F.abs(F.col("l_quantity") - 25), -F.col("l_extendedprice"), "l_linenumber")).alias("best"))


@query("o06_stratified", "SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5('7:' || doc_id), doc_id) <= 12")
def o06_stratified(spark, sf):
    return R.stratified_sample(table(spark, sf, "documents").select("doc_id", "lang"), ["lang"], "doc_id", 12, "7")


@query("o07_reservoir", "SELECT o_orderkey FROM orders ORDER BY md5('3:' || o_orderkey), o_orderkey LIMIT 50")
def o07_reservoir(spark, sf):
    return R.hash_sample(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 50, "3")


@query("o09_every_tenth", "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) % 10 = 1")
def o09_every_tenth(spark, sf):
    r = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    return table(spark, sf, "events").select("user_id", "event_id", r.alias("r")).filter("r % 10 = 1").drop("r")


@query("o10_numeric_order", """WITH k AS (SELECT CASE WHEN n_nationkey % 6 = 5 THEN 'x' ELSE '' END || CAST(n_nationkey AS VARCHAR) AS k FROM nation) SELECT k, CAST(row_number() OVER (ORDER BY try_cast(k AS INT) NULLS LAST, k) AS BIGINT) AS place FROM k""")
def o10_numeric_order(spark, sf):
    k = table(spark, sf, "nation").select(F.concat(F.when(F.col("n_nationkey") % 6 == 5, "x").otherwise(""), F.col("n_nationkey").cast("string")).alias("k"))
    by = Window.orderBy(F.expr("try_cast(k AS INT)").asc_nulls_last(), "k")  # one row for each of a volume's keys
    return k.select("k", F.row_number().over(by).cast("long").alias("place"))


# --- set operations -----------------------------------------------------------------------------------


@query("u03_diff", """SELECT coalesce(b.k, a.k) AS k, CASE WHEN b.k IS NULL THEN 'gained' ELSE 'lost' END AS side FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') b FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P') a ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL""")
def u03_diff(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "k")
    return R.gained_and_lost(o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus = 'P'"), ["k"])


@query("u04_field_diff", """WITH b AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_orderpriority AS p FROM orders WHERE o_orderkey % 10 <> 1), a AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN 'X' ELSE o_orderstatus END AS s, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders WHERE o_orderkey % 10 <> 2),
j AS (SELECT coalesce(b.k, a.k) AS k, CASE WHEN b.k IS NULL THEN 'added' WHEN a.k IS NULL THEN 'removed' WHEN b.s IS DISTINCT FROM a.s OR b.p IS DISTINCT FROM a.p THEN 'changed' END AS change, CASE WHEN b.k IS NULL OR a.k IS NULL THEN '' ELSE concat_ws(',', CASE WHEN b.s IS DISTINCT FROM a.s THEN 's' END, CASE WHEN b.p IS DISTINCT FROM a.p THEN 'p' END) END AS fields FROM b FULL JOIN a ON a.k = b.k)
SELECT k, change, fields FROM j WHERE change IS NOT NULL""")
def u04_field_diff(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"))
    a = o.filter("k % 10 <> 2").withColumns({"s": F.when(F.col("k") % 4 == 0, "X").otherwise(F.col("s")), "p": F.when(F.col("k") % 6 != 0, F.col("p"))})
    return R.field_diff(o.filter("k % 10 <> 1"), a, ["k"], ["s", "p"])


@query("u05_additive_merge", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 'NEW' FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 <> 0")
def u05_additive_merge(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return R.additive_merge(c.filter("c_custkey % 2 = 0"), c.filter("c_custkey % 3 = 0").withColumn("c_mktsegment", F.lit("NEW")), ["c_custkey"])


@query("u06_priority_merge", """WITH u AS (SELECT l_orderkey AS k, l_partkey AS v, 0 AS source_rank FROM lineitem WHERE l_returnflag = 'A' UNION ALL SELECT l_orderkey, l_partkey, 1 FROM lineitem WHERE l_returnflag = 'R')
SELECT k, v, source_rank FROM u QUALIFY row_number() OVER (PARTITION BY k ORDER BY source_rank, v) = 1""")
def u06_priority_merge(spark, sf):
    l = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("v"), "l_returnflag")
    return R.priority_merge([l.filter(f"l_returnflag = '{f}'").drop("l_returnflag") for f in "AR"], ["k"], ["v"])


@query("s04_best_source", """SELECT o_custkey AS k, min_by(o_orderkey, (CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 2 END, o_orderkey)) AS best FROM orders GROUP BY 1""")
def s04_best_source(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("best"), "o_orderpriority")
    parts = [o.filter("o_orderpriority = '1-URGENT'"), o.filter("o_orderpriority = '2-HIGH'"), o.filter("o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")]
    return R.priority_merge([p.drop("o_orderpriority") for p in parts], ["k"], ["best"]).drop("source_rank")


@query("u07_vocabulary_sets", """WITH v AS (SELECT lang, list_distinct(flatten(list(list_distinct(regexp_extract_all(lower(text), '[a-z]{5,}'))))) AS w FROM documents GROUP BY lang)
SELECT a.lang AS a, b.lang AS b, CAST(len(list_intersect(a.w, b.w)) AS BIGINT) AS common, CAST(len(list_distinct(list_concat(a.w, b.w))) AS BIGINT) AS either FROM v a JOIN v b ON a.lang < b.lang""")
def u07_vocabulary_sets(spark, sf):
    """Sizes of pairwise intersections and unions, from counts by word; no set is gathered in one row."""
    w = table(spark, sf, "documents").select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{5,}"), 0)).alias("w")).distinct()
    size = w.groupBy("lang").agg(F.count("*").alias("n"))
    langs = size.select(F.col("lang").alias("a"), F.col("n").alias("na")).join(size.select(F.col("lang").alias("b"), F.col("n").alias("nb")), F.col("a") < F.col("b"))
    both = w.select("w", F.col("lang").alias("a")).join(w.select("w", F.col("lang").alias("b")), "w").filter("a < b").groupBy("a", "b").agg(F.count("*").alias("common"))
    return langs.join(both, ["a", "b"], "left").select("a", "b", F.coalesce("common", F.lit(0)).alias("common"), (F.col("na") + F.col("nb") - F.coalesce("common", F.lit(0))).alias("either"))


# --- constraints --------------------------------------------------------------------------------------


@query("d03_duplicate_keys", "SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def d03_duplicate_keys(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.count("*").alias("n")).filter("n > 1")


@query("d04_unique_hash", "SELECT sha256(text) AS hash, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def d04_unique_hash(spark, sf):
    return table(spark, sf, "documents").filter("text IS NOT NULL").groupBy(F.sha2("text", 256).alias("hash")).agg(F.count("*").alias("n")).filter("n > 1")


@query("d05_one_per_hash", "WITH h AS (SELECT sha256(text) AS hash, count(*) AS n FROM documents GROUP BY 1) SELECT CASE WHEN n = 1 THEN 'one' ELSE 'several' END AS found, count(*) AS hashes FROM h GROUP BY 1")
def d05_one_per_hash(spark, sf):
    h = table(spark, sf, "documents").groupBy(F.sha2("text", 256).alias("hash")).agg(F.count("*").alias("n"))
    return h.groupBy(F.when(F.col("n") == 1, "one").otherwise("several").alias("found")).agg(F.count("*").alias("hashes"))


@query("d06_confident_numbers", """WITH a AS (SELECT o_custkey % 15 AS k, o_orderkey % 700 AS n FROM orders WHERE o_orderstatus = 'O'), c AS (SELECT k, n, count(*) AS m FROM a GROUP BY ALL)
SELECT k, count(*) FILTER (m > 1) AS shared, count(*) FILTER (n NOT BETWEEN 1 AND 600) AS outside FROM c GROUP BY k""")
def d06_confident_numbers(spark, sf):
    a = table(spark, sf, "orders").filter("o_orderstatus = 'O'").groupBy((F.col("o_custkey") % 15).alias("k"), (F.col("o_orderkey") % 700).alias("n")).agg(F.count("*").alias("m"))
    return a.groupBy("k").agg(F.count_if(F.col("m") > 1).alias("shared"), F.count_if(~F.col("n").between(1, 600)).alias("outside"))


@query("d07_d10_rules", """SELECT 'discount_in_range' AS rule, count(*) FILTER (NOT (l_discount BETWEEN 0 AND 0.08)) AS n FROM lineitem UNION ALL SELECT 'flag_domain', count(*) FILTER (NOT (l_returnflag IN ('A', 'N'))) FROM lineitem
UNION ALL SELECT 'filled_has_no_return', count(*) FILTER (l_linestatus = 'F' AND l_returnflag = 'N') FROM lineitem UNION ALL SELECT 'quantity_positive', count(*) FILTER (l_quantity <= 0) FROM lineitem""")
def d07_d10_rules(spark, sf):
    return R.violations(
        table(spark, sf, "lineitem"),
        {
            "discount_in_range": F.col("l_discount").between(0, 0.08),
            "flag_domain": F.col("l_returnflag").isin("A", "N"),
            "filled_has_no_return": ~((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "N")),
            "quantity_positive": F.col("l_quantity") > 0,
        },
    )


@query("d09_foreign_keys", """SELECT 'orders.customer' AS "constraint", count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 9 <> 0)
UNION ALL SELECT 'lineitem.order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'customer.nation', count(*) FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)
UNION ALL SELECT 'events.customer', count(*) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'labels.document', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""")
def d09_foreign_keys(spark, sf):
    t = lambda n: table(spark, sf, n)
    parts = [
        R.dangling(t("orders"), "o_custkey", t("customer").filter("c_custkey % 9 <> 0"), "c_custkey", "orders.customer"),
        R.dangling(t("lineitem"), "l_orderkey", t("orders"), "o_orderkey", "lineitem.order"),
        R.dangling(t("customer"), "c_nationkey", t("nation"), "n_nationkey", "customer.nation"),
        R.dangling(t("events"), "user_id", t("customer"), "c_custkey", "events.customer"),
        R.dangling(t("labels"), "doc_id", t("documents"), "doc_id", "labels.document"),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("d11_alias_injective", "SELECT alias, count(DISTINCT n_nationkey) AS n FROM (SELECT n_nationkey, 'S' || CAST(n_nationkey % 20 AS VARCHAR) AS alias FROM nation) GROUP BY alias HAVING count(DISTINCT n_nationkey) > 1")
def d11_alias_injective(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey", F.concat(F.lit("S"), (F.col("n_nationkey") % 20).cast("string")).alias("alias"))
    return n.groupBy("alias").agg(F.countDistinct("n_nationkey").alias("n")).filter("n > 1")


@query("d12_golden_master", """WITH g AS (SELECT event_type AS k, count(*) AS n FROM events GROUP BY 1), w AS (SELECT event_type AS k, CAST(sum(c) AS BIGINT) AS n FROM (SELECT event_type, user_id, count(*) AS c FROM events WHERE user_id <> 3 GROUP BY ALL) GROUP BY 1)
SELECT g.k, g.n AS want, coalesce(w.n, 0) AS got, g.n = coalesce(w.n, 0) AS same FROM g LEFT JOIN w USING (k)""")
def d12_golden_master(spark, sf):
    e = table(spark, sf, "events").withColumnRenamed("event_type", "k")
    got = e.filter("user_id <> 3").groupBy("k").agg(F.count("*").alias("got"))
    out = e.groupBy("k").agg(F.count("*").alias("want")).join(got, "k", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    return out.withColumn("same", F.col("want") == F.col("got"))


@query("d13_year_mismatch", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE year(l_shipdate) - year(o_orderdate) NOT BETWEEN 0 AND 3")
def d13_year_mismatch(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").alias("y"))
    return table(spark, sf, "lineitem").join(o, "l_orderkey").filter(~(F.year("l_shipdate") - F.col("y")).between(0, 3)).select("l_orderkey", "l_linenumber", "l_partkey")


# --- work queues as audits ------------------------------------------------------------------------------


@query("r04_failure_transition", """WITH a AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS attempts FROM events GROUP BY user_id) SELECT user_id, attempts, CASE WHEN attempts = 0 THEN 'done' WHEN attempts >= 5 THEN 'held' ELSE 'pending' END AS state FROM a""")
def r04_failure_transition(spark, sf):
    a = table(spark, sf, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("attempts"))
    n = F.col("attempts")
    return a.withColumn("state", F.when(n == 0, "done").when(n >= 5, "held").otherwise("pending"))


@query("r06_stale_claims", "SELECT user_id, max(ts) < TIMESTAMP '2024-01-30 12:00:00' AS stale FROM events GROUP BY user_id")
def r06_stale_claims(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg((F.max("ts") < F.expr("timestamp_ntz '2024-01-30 12:00:00'")).alias("stale"))


@query("r07_pass_gates", "SELECT user_id, count(DISTINCT event_type) FILTER (event_type IN ('click', 'view', 'purchase')) = 3 AS ready FROM events WHERE event_id % 3 = 0 GROUP BY user_id")
def r07_pass_gates(spark, sf):
    e = table(spark, sf, "events").filter("event_id % 3 = 0")
    return e.groupBy("user_id").agg(F.bool_or(F.col("event_type") == "click").alias("a"), F.bool_or(F.col("event_type") == "view").alias("b"), F.bool_or(F.col("event_type") == "purchase").alias("c")).select("user_id", F.expr("a AND b AND c").alias("ready"))


@query("r08_resume", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def r08_resume(spark, sf):
    done = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey").join(done, "o_orderkey", "left_anti")


@query("c22_throughput", """WITH w AS (SELECT user_id, min(ts) AS a, max(ts) AS b, count(*) AS n FROM events GROUP BY user_id) SELECT user_id, n, round(n / (epoch_us(b) - epoch_us(a)) * 3600000000.0, 6) AS per_hour FROM w""")
def c22_throughput(spark, sf):
    w = table(spark, sf, "events").groupBy("user_id").agg(F.min(F.col("ts").cast("timestamp")).alias("a"), F.max(F.col("ts").cast("timestamp")).alias("b"), F.count("*").alias("n"))
    return w.select("user_id", "n", F.round(F.col("n") / (F.unix_micros("b") - F.unix_micros("a")) * 3600000000.0, 6).alias("per_hour"))
