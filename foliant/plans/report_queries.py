"""Reports, gates and checks that put several operators together.

Roles: ``orders`` are acts (session: customer, ordinal: key within it), ``documents`` pages of text, ``labels`` verdicts
on them, ``events`` a log, ``lineitem`` the acts of an enactment.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import relational, sequence, temporal, tokens
from ..registry import query, table

# --- aggregates ----------------------------------------------------------------------------------------


@query(
    "a16_stage_rates",
    """WITH t AS (SELECT lower(unnest(regexp_extract_all(text, '[A-Za-z]+'))) AS tok FROM documents),
m AS (SELECT unnest(['1 all', '2 long', '3 odd']) AS stage, unnest([true, length(tok) > 9, length(tok) > 9 AND NOT regexp_matches(tok, '[aeiouy]')]) AS flagged FROM t)
SELECT stage, count(*) FILTER (flagged) AS flagged, count(*) AS total, floor(10000.0 * count(*) FILTER (flagged) / count(*)) / 100 AS percent FROM m GROUP BY stage""",
)
def a16_stage_rates(spark, sf):
    toks = table(spark, sf, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("tok")).select(F.lower("tok").alias("tok"))
    long = F.length("tok") > 9
    rules = {"1 all": F.lit(True), "2 long": long, "3 odd": long & ~F.col("tok").rlike("[aeiouy]")}
    # one pass: a conditional count for each stage, turned into rows at the end
    counts = toks.agg(F.count("*").alias("total"), *(F.count_if(c).alias(s) for s, c in rules.items()))
    rows = counts.select("total", F.explode(F.array(*(F.struct(F.lit(s).alias("stage"), F.col(s).alias("flagged")) for s in rules))).alias("r"))
    return rows.select("r.stage", "r.flagged", "total", relational.floor_percent(F.col("r.flagged"), F.col("total")).alias("percent"))


@query(
    "a18_pages_touched",
    """WITH t AS (SELECT doc_id, lower(unnest(regexp_extract_all(text, '[A-Za-z]+'))) AS tok FROM documents)
SELECT tok, count(DISTINCT doc_id) AS pages, count(*) AS n FROM t WHERE length(tok) >= 12 GROUP BY tok""",
)
def a18_pages_touched(spark, sf):
    t = table(spark, sf, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("tok"))
    long = t.filter(F.length("tok") >= 12).groupBy(F.lower("tok").alias("tok"), "doc_id").agg(F.count("*").alias("n"))
    return long.groupBy("tok").agg(F.count("*").alias("pages"), F.sum("n").alias("n"))


@query(
    "a25_upper_median",
    "SELECT l_orderkey, list_sort(list(l_partkey))[count(*) // 2 + 1] AS upper_median FROM lineitem GROUP BY l_orderkey",
)
def a25_upper_median(spark, sf):
    """By rank, so that a key's values are sorted by Spark and never held as one list."""
    w = Window.partitionBy("l_orderkey")
    ranked = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", F.row_number().over(w.orderBy("l_partkey")).alias("k"), F.count("*").over(w).alias("n"))
    return ranked.filter(F.expr("k = n div 2 + 1")).select("l_orderkey", F.col("l_partkey").alias("upper_median"))


@query(
    "o04_most_flagged",
    "SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS flagged FROM lineitem GROUP BY l_suppkey ORDER BY flagged DESC, l_suppkey LIMIT 20",
)
def o04_most_flagged(spark, sf):
    """A top-k report: the twenty suppliers with most returns."""
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("flagged")).orderBy(F.desc("flagged"), "l_suppkey").limit(20)


@query(
    "o08_first_in_context",
    """WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS tok, generate_subscripts(w, 1) AS pos FROM t),
f AS (SELECT tok, min(doc_id * 1000000 + pos) AS at_ FROM p GROUP BY tok HAVING count(*) = 1)
SELECT tok, at_ // 1000000 AS doc_id, array_to_string(w[greatest(1, at_ % 1000000 - 2) : at_ % 1000000 + 2], ' ') AS context FROM f JOIN t ON doc_id = at_ // 1000000""",
)
def o08_first_in_context(spark, sf):
    """Words that stand in the corpus once, with two words on each side."""
    docs = table(spark, sf, "documents").select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)).alias("w"))
    places = docs.select("doc_id", F.posexplode("w").alias("pos", "tok"), "w")
    around = F.array_join(F.slice("w", F.greatest(F.lit(1), F.col("pos") - 1), F.col("pos") + 3 - F.greatest(F.lit(0), F.col("pos") - 2)), " ")
    once = places.select("doc_id", "pos", "tok").groupBy("tok").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "pos")).alias("at")).filter("n = 1")
    return once.select("tok", "at.doc_id", "at.pos").join(docs, "doc_id").select("tok", "doc_id", around.alias("context"))


@query(
    "u08_dictionaries",
    "SELECT DISTINCT lower(w) AS word FROM (SELECT n_name AS w FROM nation UNION ALL SELECT r_name FROM region UNION ALL SELECT unnest(regexp_extract_all(text, '[A-Za-z]+')) FROM benchmark)",
)
def u08_dictionaries(spark, sf):
    words = table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("w"))
    parts = [table(spark, sf, "nation").select(F.col("n_name").alias("w")), table(spark, sf, "region").select(F.col("r_name").alias("w")), words]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select(F.lower("w").alias("word")).distinct()


# --- functions -----------------------------------------------------------------------------------------


@query("f53_caps", "SELECT doc_id, substr(coalesce(text, ''), 1, 500) AS title, length(substr(text, 1, 6000)) AS n FROM documents")
def f53_caps(spark, sf):
    """Display fields have a length; what is stored has none."""
    return table(spark, sf, "documents").select("doc_id", F.substring(F.coalesce("text", F.lit("")), 1, 500).alias("title"), F.length(F.substring("text", 1, 6000)).cast("long").alias("n"))


@query(
    "f54_provenance",
    "SELECT o_orderkey, '{\"source\":\"' || o_orderpriority || '\",\"page\":' || (o_orderkey % 400) || ',\"trusted\":' || CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END || '}' AS provenance FROM orders",
)
def f54_provenance(spark, sf):
    one = F.struct(F.col("o_orderpriority").alias("source"), (F.col("o_orderkey") % 400).alias("page"), (F.col("o_orderstatus") == "F").alias("trusted"))
    return table(spark, sf, "orders").select("o_orderkey", F.to_json(one).alias("provenance"))


@query(
    "f55_time_ordered_ids",
    """WITH h AS (SELECT event_id, md5(CAST(event_id AS VARCHAR)) AS h, printf('%012x', epoch_us(ts) // 1000) AS t FROM events)
SELECT event_id, t[1:8] || '-' || t[9:12] || '-7' || h[1:3] || '-8' || h[4:6] || '-' || h[7:18] AS id FROM h""",
)
def f55_time_ordered_ids(spark, sf):
    """Identifiers with 48 bits of the time first, the rest from a hash of the key: the same in each run."""
    e = table(spark, sf, "events").select("event_id", F.lower(F.lpad(F.hex(F.unix_millis(F.col("ts").cast("timestamp"))), 12, "0")).alias("t"), F.md5(F.col("event_id").cast("string")).alias("h"))
    part = F.substring
    return e.select("event_id", F.concat(part("t", 1, 8), F.lit("-"), part("t", 9, 4), F.lit("-7"), part("h", 1, 3), F.lit("-8"), part("h", 4, 3), F.lit("-"), part("h", 7, 12)).alias("id"))


# --- constraints and ingest ----------------------------------------------------------------------------


@query(
    "d05_i02_one_document",
    "SELECT md5(coalesce(text, '')) AS hash, count(*) AS n, min(doc_id) AS doc_id, CASE WHEN count(*) = 1 THEN 'resolved' ELSE 'ambiguous' END AS verdict FROM documents GROUP BY 1",
)
def d05_i02_one_document(spark, sf):
    d = table(spark, sf, "documents").groupBy(F.md5(F.coalesce("text", F.lit(""))).alias("hash")).agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"))
    return d.select("hash", "n", "doc_id", F.when(F.col("n") == 1, "resolved").otherwise("ambiguous").alias("verdict"))


@query("d08_domains", "SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('click', 'view', 'purchase') GROUP BY event_type")
def d08_domains(spark, sf):
    """Values out of their domain, by value."""
    domain = spark.createDataFrame([("click",), ("view",), ("purchase",)], "event_type string")
    return table(spark, sf, "events").filter("event_type IS NOT NULL").join(F.broadcast(domain), "event_type", "left_anti").groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "i03_feed",
    """WITH feed AS (SELECT l_orderkey AS chapter, l_linenumber AS bill_order, CASE WHEN l_returnflag = 'R' THEN 'repeal' ELSE 'amend' END AS action FROM lineitem),
seen AS (SELECT o_orderkey AS chapter FROM orders WHERE o_orderkey % 3 = 0)
SELECT chapter, CAST(bill_order - 1 AS INT) AS in_act_order, action, CASE WHEN action = 'repeal' THEN 'repealed' ELSE 'active' END AS status FROM feed WHERE chapter NOT IN (SELECT chapter FROM seen)""",
)
def i03_feed(spark, sf):
    """New chapters of a feed; those with events already are left as they are."""
    line = table(spark, sf, "lineitem")
    feed = line.select(F.col("l_orderkey").alias("chapter"), (F.col("l_linenumber") - 1).cast("int").alias("in_act_order"), F.when(F.col("l_returnflag") == "R", "repeal").otherwise("amend").alias("action"))
    seen = table(spark, sf, "orders").select(F.col("o_orderkey").alias("chapter")).filter("chapter % 3 = 0")
    return feed.join(seen, "chapter", "left_anti").withColumn("status", F.when(F.col("action") == "repeal", "repealed").otherwise("active"))


@query(
    "i03_orphan_purge",
    """WITH doc AS (SELECT c_custkey AS id FROM customer WHERE c_custkey % 5 <> 0),
act AS (SELECT o_orderkey AS id FROM orders WHERE o_custkey IN (SELECT id FROM doc)),
ev AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT id FROM act))
SELECT 'event' AS kind, count(*) AS kept, (SELECT count(*) FROM lineitem) - count(*) AS purged FROM ev UNION ALL
SELECT 'act', count(*), (SELECT count(*) FROM orders) - count(*) FROM act""",
)
def i03_orphan_purge(spark, sf):
    """Customers as documents, orders as their acts, lines as the acts' events: a fifth of the documents are withdrawn."""
    documents = table(spark, sf, "customer").filter("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("id"))
    acts = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("document"))
    events = table(spark, sf, "lineitem").select(F.concat_ws("/", "l_orderkey", "l_linenumber").alias("id"), F.col("l_orderkey").alias("act"))
    left = relational.purged(documents, [("act", acts, "document"), ("event", events, "act")])
    whole = {"act": acts, "event": events}
    counts = [rows.agg(F.count("*").alias("kept")).crossJoin(whole[k].agg(F.count("*").alias("n_"))).select(F.lit(k).alias("kind"), "kept", (F.col("n_") - F.col("kept")).alias("purged")) for k, rows in left.items()]
    return counts[0].unionByName(counts[1])


@query(
    "i03_status",
    """WITH v AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC NULLS LAST, event_id DESC) AS k FROM events)
SELECT user_id, CASE WHEN event_type = 'error' THEN 'repealed' ELSE 'active' END AS status FROM v WHERE k = 1""",
)
def i03_status(spark, sf):
    """A provision's status is that of its last version, in whatever order the feed came."""
    e = table(spark, sf, "events")
    last = e.groupBy("user_id").agg(F.max_by("event_type", F.struct(F.col("ts").cast("date"), "event_id")).alias("last"))
    return last.select("user_id", F.when(F.col("last") == "error", "repealed").otherwise("active").alias("status"))


# --- completeness --------------------------------------------------------------------------------------

_SESSION = """have AS (SELECT DISTINCT o_custkey AS s, o_orderkey % 40 + 1 AS n FROM orders WHERE o_orderkey % 11 <> 0),
top AS (SELECT s, max(n) AS total FROM have GROUP BY s)"""


def _session(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderkey % 11 <> 0")
    have = o.select(F.col("o_custkey").alias("s"), (F.col("o_orderkey") % 40 + 1).alias("n")).distinct()
    return have, have.groupBy("s").agg(F.max("n").alias("total"))


@query(
    "c11_buckets",
    f"""WITH {_SESSION}, c AS (SELECT s, count(*) AS have, max(n) AS total FROM have GROUP BY s)
SELECT s, have, total, total - have AS missing, CASE WHEN have < 0.7 * total AND total > 30 THEN 'ANOMALY' WHEN have = total THEN 'CLEAN' WHEN total - have <= 5 THEN 'SMALL_GAP' ELSE 'LARGE_GAP' END AS bucket FROM c""",
)
def c11_buckets(spark, sf):
    have, _ = _session(spark, sf)
    c = have.groupBy("s").agg(F.count("*").alias("have"), F.max("n").alias("total")).withColumn("missing", F.col("total") - F.col("have"))
    odd = (F.col("have") < 0.7 * F.col("total")) & (F.col("total") > 30)
    bucket = F.when(odd, "ANOMALY").when(F.col("missing") == 0, "CLEAN").when(F.col("missing") <= 5, "SMALL_GAP").otherwise("LARGE_GAP")
    return c.withColumn("bucket", bucket)


@query(
    "c12_manifest",
    f"""WITH {_SESSION}, m AS (SELECT s, n FROM (SELECT s, unnest(generate_series(1, total)) AS n FROM top) EXCEPT SELECT s, n FROM have),
i AS (SELECT s, n, n - row_number() OVER (PARTITION BY s ORDER BY n) AS g FROM m)
SELECT s, min(n) AS first_missing, max(n) AS last_missing, count(*) AS run_length FROM i GROUP BY s, g""",
)
def c12_manifest(spark, sf):
    """Runs of missing ordinals of each session."""
    have, top = _session(spark, sf)
    lost = sequence.missing(have, top, "s", "n", "total")
    run = F.col("n") - F.row_number().over(Window.partitionBy("s").orderBy("n"))
    return lost.select("s", "n", run.alias("g")).groupBy("s", "g").agg(F.min("n").alias("first_missing"), F.max("n").alias("last_missing"), F.count("*").alias("run_length")).drop("g")


@query(
    "c08_volume_verdict",
    f"""WITH {_SESSION}, c AS (SELECT s, count(*) AS have, max(n) AS total, min(n) AS low FROM have GROUP BY s),
d AS (SELECT o_custkey AS s, count(*) - count(DISTINCT o_orderkey % 40) AS dups FROM orders WHERE o_orderkey % 11 <> 0 GROUP BY 1)
SELECT s, CASE WHEN have < 3 THEN 'TOO_FEW' WHEN low > 5 THEN 'STARTS_LATE' WHEN have < 0.5 * total THEN 'INCOMPLETE' WHEN dups > 0 THEN 'DUPLICATES' WHEN have = total THEN 'COMPLETE' ELSE 'GAPS' END AS verdict FROM c JOIN d USING (s)""",
)
def c08_volume_verdict(spark, sf):
    """A ladder over one aggregated row for each volume; the first rung that holds is the verdict."""
    o = table(spark, sf, "orders").filter("o_orderkey % 11 <> 0").select(F.col("o_custkey").alias("s"), (F.col("o_orderkey") % 40 + 1).alias("n"))
    per = o.groupBy("s", "n").agg(F.count("*").alias("k")).groupBy("s").agg(F.count("*").alias("have"), F.max("n").alias("total"), F.min("n").alias("low"), F.sum(F.col("k") - 1).alias("dups"))
    ladder = (
        F.when(F.col("have") < 3, "TOO_FEW").when(F.col("low") > 5, "STARTS_LATE").when(F.col("have") < 0.5 * F.col("total"), "INCOMPLETE").when(F.col("dups") > 0, "DUPLICATES").when(F.col("have") == F.col("total"), "COMPLETE").otherwise("GAPS")
    )
    return per.select("s", ladder.alias("verdict"))


@query(
    "c10_index_verdict",
    """WITH c AS (SELECT o_custkey AS s, max(o_orderkey % 40 + 1) AS top, count(DISTINCT o_orderkey % 40) AS have, max(o_orderkey % 37 + 1) AS oracle FROM orders GROUP BY 1)
SELECT s, CASE WHEN 4 * have < 3 * top THEN 'NO_INDEX' WHEN abs(top - oracle) <= 1 THEN 'MATCH' WHEN oracle < top THEN 'ORACLE_LOW' ELSE 'ORACLE_HIGH' END AS verdict FROM c""",
)
def c10_index_verdict(spark, sf):
    """A session's derived total against the known one, where three quarters of its ordinals were read."""
    o = table(spark, sf, "orders")
    c = o.groupBy(F.col("o_custkey").alias("s")).agg(F.max(F.col("o_orderkey") % 40 + 1).alias("top"), F.count_distinct(F.col("o_orderkey") % 40).alias("have"), F.max(F.col("o_orderkey") % 37 + 1).alias("oracle"))
    verdict = F.when(4 * F.col("have") < 3 * F.col("top"), "NO_INDEX").when(F.abs(F.col("top") - F.col("oracle")) <= 1, "MATCH").when(F.col("oracle") < F.col("top"), "ORACLE_LOW").otherwise("ORACLE_HIGH")
    return c.select("s", verdict.alias("verdict"))


@query(
    "c16_sieve_by_source",
    """SELECT source, count(*) AS pages, count(quality) AS judged, count(*) FILTER (quality = 0) AS failed, floor(10000.0 * count(*) FILTER (quality = 0) / count(*)) / 100 AS percent
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""",
)
def c16_sieve_by_source(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    c = d.groupBy("source").agg(F.count("*").alias("pages"), F.count("quality").alias("judged"), F.count_if(F.col("quality") == 0).alias("failed"))
    return c.withColumn("percent", relational.floor_percent(F.col("failed"), F.col("pages")))


@query(
    "c17_key_triage",
    """WITH t AS (SELECT l_suppkey % 5 AS vol, l_partkey AS n, l_orderkey AS page, substr(regexp_replace(lower(l_returnflag || l_linestatus || (l_orderkey % 3)), '[^a-z0-9]', '', 'g'), 1, 50) AS title FROM lineitem),
p AS (SELECT vol, n, page, min(title) AS title FROM t GROUP BY ALL),
k AS (SELECT vol, n, count(*) AS pages, count(*) FILTER (title <> '') AS titled, count(DISTINCT substr(title, 1, 20)) AS kinds FROM p GROUP BY ALL HAVING count(*) > 1)
SELECT vol, n, pages, CASE WHEN titled <= 1 THEN 'MULTI' WHEN kinds = 1 THEN 'SAME-ACT' ELSE 'COLLISION' END AS kind FROM k""",
)
def c17_key_triage(spark, sf):
    """Numbers that several pages of a volume claim: one act, or different acts under one number."""
    title = F.substring(F.regexp_replace(F.lower(F.concat("l_returnflag", "l_linestatus", (F.col("l_orderkey") % 3).cast("string"))), "[^a-z0-9]", ""), 1, 50)
    t = table(spark, sf, "lineitem").select((F.col("l_suppkey") % 5).alias("vol"), F.col("l_partkey").alias("n"), F.col("l_orderkey").alias("page"), title.alias("title"))
    # dealt out once, by number, into a given number of parts: a part is sorted once, and both groupings go by that order
    t = t.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "vol", "n")
    p = t.groupBy("vol", "n", "page").agg(F.min("title").alias("title")).withColumn("kind", F.substring("title", 1, 20))
    one = F.when(F.min("kind") == F.max("kind"), 1).otherwise(2)
    k = p.groupBy("vol", "n").agg(F.count("*").alias("pages"), F.count_if(F.col("title") != "").alias("titled"), one.alias("kinds")).filter("pages > 1")
    return k.select("vol", "n", "pages", F.when(F.col("titled") <= 1, "MULTI").when(F.col("kinds") == 1, "SAME-ACT").otherwise("COLLISION").alias("kind"))


@query(
    "c19_reparse_diff",
    """WITH b AS (SELECT o_custkey AS s, o_orderkey AS n, o_orderstatus AS v FROM orders WHERE o_orderkey % 10 <> 3),
a AS (SELECT o_custkey AS s, o_orderkey AS n, CASE WHEN o_orderkey % 4 = 0 THEN 'X' ELSE o_orderstatus END AS v FROM orders WHERE o_orderkey % 10 <> 4)
SELECT coalesce(a.s, b.s) AS s, count(*) FILTER (b.n IS NULL) AS gained, count(*) FILTER (a.n IS NULL) AS lost, count(*) FILTER (a.v IS DISTINCT FROM b.v AND a.n IS NOT NULL AND b.n IS NOT NULL) AS changed
FROM a FULL JOIN b ON a.s = b.s AND a.n = b.n GROUP BY 1""",
)
def c19_reparse_diff(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("s"), F.col("o_orderkey").alias("n"), F.col("o_orderstatus").alias("v"))
    b = o.filter("n % 10 <> 3").select("s", "n", F.col("v").alias("before"), F.lit(1).alias("in_b"))
    a = o.filter("n % 10 <> 4").select("s", "n", F.when(F.col("n") % 4 == 0, "X").otherwise(F.col("v")).alias("after"), F.lit(1).alias("in_a"))
    both = a.join(b, ["s", "n"], "full_outer")
    changed = F.col("in_a").isNotNull() & F.col("in_b").isNotNull() & ~F.col("before").eqNullSafe(F.col("after"))
    return both.groupBy("s").agg(F.count_if(F.col("in_b").isNull()).alias("gained"), F.count_if(F.col("in_a").isNull()).alias("lost"), F.count_if(changed).alias("changed"))


@query(
    "c20_worklist",
    """WITH t AS (SELECT doc_id, lower(unnest(regexp_extract_all(text, '\\p{L}+'))) AS tok FROM documents),
v AS (SELECT tok, count(*) AS n, count(DISTINCT doc_id) AS docs FROM t GROUP BY tok)
SELECT tok, n, docs, CASE WHEN n = 1 THEN 'singleton' WHEN n < 10 THEN 'few' ELSE 'many' END AS tier FROM v WHERE docs < 3 AND length(tok) >= 4""",
)
def c20_worklist(spark, sf):
    """Unknown words that are worth a look, by how often they stand."""
    t = table(spark, sf, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))).alias("tok"))
    v = t.groupBy(F.lower("tok").alias("tok"), "doc_id").agg(F.count("*").alias("n")).groupBy("tok").agg(F.sum("n").alias("n"), F.count("*").alias("docs"))
    return v.filter((F.col("docs") < 3) & (F.length("tok") >= 4)).withColumn("tier", F.when(F.col("n") == 1, "singleton").when(F.col("n") < 10, "few").otherwise("many"))


@query(
    "c09_integrity",
    """WITH o AS (SELECT o_custkey AS s, o_orderkey % 97 AS n, o_orderkey AS k, year(o_orderdate) AS y FROM orders),
f AS (SELECT 'range' AS rule, count(*) FILTER (n NOT BETWEEN 1 AND 90) AS n FROM o
 UNION ALL SELECT 'year', count(*) FILTER (abs(y - 1995) > 3) FROM o
 UNION ALL SELECT 'duplicate', count(*) FROM (SELECT row_number() OVER (PARTITION BY s, n ORDER BY k) AS r FROM o) WHERE r > 1)
SELECT rule, n FROM f""",
)
def c09_integrity(spark, sf):
    """Flags of several checks, counted in one pass each."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("s"), (F.col("o_orderkey") % 97).alias("n"), F.year("o_orderdate").alias("y"))
    simple = o.agg(F.count_if(~F.col("n").between(1, 90)).alias("range"), F.count_if(F.abs(F.col("y") - 1995) > 3).alias("year"))
    simple = simple.select(F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("n")) for r in ("range", "year")))).alias("r")).select("r.*")
    twice = o.groupBy("s", "n").agg((F.count("*") - 1).alias("more")).agg(F.lit("duplicate").alias("rule"), F.sum("more").alias("n"))
    return simple.unionByName(twice.select(F.col("rule"), F.col("n")))


@query(
    "g02_version_counts",
    "WITH v AS (SELECT user_id, CAST(ts AS DATE) AS d, lead(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) NULLS LAST, event_id) AS e FROM events) SELECT user_id, count(*) AS versions, count(*) FILTER (d = e) AS empty, count(*) FILTER (e IS NULL) AS open FROM v GROUP BY user_id",
)
def g02_version_counts(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("d"))
    v = temporal.version_fold(e, ["user_id"], "d", ["event_id"])
    return v.groupBy("user_id").agg(F.count("*").alias("versions"), F.count_if("is_empty").alias("empty"), F.count_if(F.col("valid_to").isNull()).alias("open"))


@query(
    "a26_counts_by_file",
    "SELECT tok, count(*) AS n FROM (SELECT lower(unnest(regexp_extract_all(text, '\\p{L}+'))) AS tok FROM benchmark) GROUP BY tok",
)
def a26_counts_by_file(spark, sf):
    """Counts that tasks make of their own rows and a shuffle adds up."""
    return tokens.token_stream(table(spark, sf, "benchmark"), "item_id").groupBy("tok").agg(F.count("*").alias("n"))
