"""Acts parsed, planned and merged, and the gates of the parser, over pages made of orders and documents.

A volume is a customer's number modulo 40; each of its orders has two pages, an act's heading and its body. By the
order's number modulo 8 an act has an early, a modern or a lapsed date (0 to 2), no enacting clause (3), next to no text
(4), is a resolution (5), has a year far off (6), or its heading opens no act (7).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import acts as A
from ..functions import numerals as N
from ..operators import acts as O
from ..registry import query, table

YEAR = 1997
_CLAUSE = "The People of the State of California, represented in Senate and Assembly, do enact as follows:"


def placed(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("d"), (F.col("o_custkey") % 40).alias("volume"), (F.col("o_orderkey") % 8).alias("kind"))
    return o.withColumn("r", F.row_number().over(Window.partitionBy("volume").orderBy("o_orderkey")) - 1)


def act_pages(spark, sf):
    o = placed(spark, sf)
    kind, roman = F.col("kind"), N.int_to_roman(F.col("r") % 87 + 1)
    day = lambda end, year=F.year("d"): F.concat(F.date_format("d", "MMMM d"), F.lit(end), year.cast("string"))
    date = (
        F.when(kind == 0, F.concat(F.lit("[Approved "), day("d, "), F.lit(".]")))
        .when(kind == 1, F.concat(F.lit("Approved by Governor "), day(", "), F.lit(".")))
        .when(kind == 2, F.concat(F.lit("[Became a law without the Governor's name, "), day(", "), F.lit(".]")))
        .when(kind == 6, F.concat(F.lit("[Passed "), day(", ", F.year("d") - 40), F.lit(".]")))
        .otherwise(F.concat(F.lit("[Approved hy Govcrnor "), day(", "), F.lit(".]")))
    )
    title = F.concat(F.lit("An Act to provide for customer "), F.col("o_custkey").cast("string"), F.lit("."))
    heading = F.concat(F.lit("CHAPTER "), F.when(kind == 1, F.replace(roman, F.lit("I"), F.lit("l"))).otherwise(roman), F.lit("."))
    clause = F.when(kind == 3, F.lit("It has no clause of the kind that acts have, yet is long enough to be one.")).otherwise(F.lit(_CLAUSE))
    first = (
        F.when(kind == 4, F.concat_ws("\n", heading, F.lit("An Act.")))
        .when(kind == 5, F.concat_ws("\n", heading, F.lit("Senate Concurrent Resolution No. 4--Relative to taxes."), title, date, clause))
        .when(kind == 7, F.concat_ws("\n", heading, F.lit("Of this."), F.lit("That."), F.lit("And."), F.lit("More.")))
        .otherwise(F.concat_ws("\n", F.lit(""), heading, F.lit(" "), title, date, clause))
    )
    body = F.when(kind.isin(4, 7), F.lit("")).otherwise(F.concat(F.lit("Section 1. The sum of "), F.col("o_orderkey").cast("string"), F.lit(" dollars is\nappropriated.")))
    each = o.select("volume", F.explode(F.array(F.struct((2 * F.col("r")).alias("page"), first.alias("text")), F.struct((2 * F.col("r") + 1).alias("page"), body.alias("text")))).alias("p"))
    return each.select("volume", "p.*")


def years(pages):
    return pages.select("volume").distinct().withColumn("year", F.lit(YEAR))


ORDERS = """o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d, o_custkey % 40 AS volume, o_orderkey % 8 AS kind, row_number() OVER (PARTITION BY o_custkey % 40 ORDER BY o_orderkey) - 1 AS r FROM orders),
acts AS (SELECT *, row_number() OVER (PARTITION BY volume ORDER BY r) - 1 AS in_act_order, CAST(r % 87 + 1 AS INTEGER) AS chapter, CASE WHEN kind = 4 THEN 'An Act.' ELSE 'An Act to provide for customer ' || o_custkey || '.' END AS title,
  kind <> 4 AND kind <> 6 AND abs(year(d) - 1997) <= 3 AS dated, CASE WHEN kind = 6 THEN year(d) - 40 WHEN kind <> 4 AND abs(year(d) - 1997) > 3 THEN year(d) END AS rejected_year FROM o WHERE kind <> 7)"""


@query("c04_parsed_acts", f"""WITH {ORDERS} SELECT volume, in_act_order, chapter, title, CASE WHEN dated THEN strftime(d, '%Y-%m-%d') END AS approved, CASE WHEN kind = 2 THEN 'unsigned_lapse' ELSE 'approved' END AS path, 2 * r + 1 AS source_page,
rejected_year, rejected_year IS NOT NULL AS date_needs_review, dated AND kind < 4 AS confident, kind IN (3, 4) AS rejected FROM acts""")
def c04_parsed_acts(spark, sf):
    p = act_pages(spark, sf)
    a = O.parsed_acts(p, years(p))
    return a.select(
        "volume", F.col("in_act_order").cast("long").alias("in_act_order"), "chapter", "title", F.date_format("approved", "yyyy-MM-dd").alias("approved"), "path", F.col("source_page").cast("long").alias("source_page"),
        F.get("rejected_years", F.lit(0)).cast("long").alias("rejected_year"), "date_needs_review", "confident", F.col("reject").isNotNull().alias("rejected"),
    )


@query("c05_planned_acts", f"""WITH {ORDERS}, real AS (SELECT *, 2 * r AS start_page FROM acts WHERE kind < 3 AND dated), s AS (SELECT *, coalesce(lead(start_page) OVER (PARTITION BY volume ORDER BY in_act_order), (SELECT 2 * max(r) + 1 FROM o WHERE o.volume = real.volume)) AS end_page FROM real),
q AS (SELECT volume, in_act_order, count(*) AS pages_read, round(sum((p % 10) / 10.0::DOUBLE * (p % 7 + 1)) / sum(p % 7 + 1), 4) AS quality FROM (SELECT volume, in_act_order, unnest(range(start_page, end_page + 1)) AS p FROM s) GROUP BY ALL)
SELECT volume, in_act_order, chapter, strftime(d, '%Y-%m-%d') AS approved, start_page, end_page, pages_read, quality, o_orderkey % 3 <> 0 AS confident_number FROM s JOIN q USING (volume, in_act_order)""")
def c05_planned_acts(spark, sf):
    p = act_pages(spark, sf)
    acts = O.parsed_acts(p, years(p))
    quality = p.select("volume", "page", (F.col("page") % 10 / 10).alias("confidence"), (F.col("page") % 7 + 1).alias("tokens"))
    o = placed(spark, sf).filter("kind <> 7").withColumn("in_act_order", F.row_number().over(Window.partitionBy("volume").orderBy("r")) - 1)
    n = F.col("r") % 87 + 1
    said = F.when(F.col("o_orderkey") % 3 == 0, F.array(n, n + 1)).otherwise(F.array(n, n))
    a = O.planned_acts(acts, quality, o.select("volume", "in_act_order", F.explode(said.cast("array<int>")).alias("numeral")))
    return a.select("volume", F.col("in_act_order").cast("long").alias("in_act_order"), "chapter", F.date_format("approved", "yyyy-MM-dd").alias("approved"), F.col("start_page").cast("long").alias("start_page"), F.col("end_page").cast("long").alias("end_page"), "pages_read", "quality", "confident_number")


@query("c07_merged_acts", """WITH a AS (SELECT conv_id, turn // 4 AS page, turn, length(coalesce(text, '')) AS n, turn % 5 = 0 AS anchored, list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) AS b, list_distinct(regexp_extract_all(lower(role), '[a-z]+')) AS t FROM conversations),
p AS (SELECT x.conv_id, x.turn, y.turn AS other, y.anchored AS ya, y.n AS yn, CASE WHEN len(x.b) >= 15 AND len(y.b) >= 15 THEN len(list_intersect(x.b, y.b)) / (len(x.b) + len(y.b) - len(list_intersect(x.b, y.b))) END AS part, len(x.b) < 15 AND len(x.t) > 0 AND len(list_intersect(x.t, y.t)) = len(x.t) AS stub
FROM a x JOIN a y ON x.conv_id = y.conv_id AND x.page = y.page AND x.turn <> y.turn AND (x.anchored, x.n, -x.turn) < (y.anchored, y.n, -y.turn)),
k AS (SELECT *, CASE WHEN part >= 0.6 THEN 1 WHEN stub THEN 2 WHEN part >= 0.3 THEN 3 END AS k FROM p), g AS (SELECT conv_id, turn, min(k) AS k FROM k WHERE k IS NOT NULL GROUP BY ALL),
w AS (SELECT k.conv_id, k.turn, k.other FROM k JOIN g ON g.conv_id = k.conv_id AND g.turn = k.turn AND g.k = k.k QUALIFY row_number() OVER (PARTITION BY k.conv_id, k.turn ORDER BY ya DESC, yn DESC, other) = 1)
SELECT a.conv_id, a.turn, CASE g.k WHEN 1 THEN 'same' WHEN 2 THEN 'stub' WHEN 3 THEN 'weak' ELSE 'own' END AS verdict, CASE WHEN g.k < 3 THEN w.other END AS keeper FROM a LEFT JOIN g ON g.conv_id = a.conv_id AND g.turn = a.turn LEFT JOIN w ON w.conv_id = a.conv_id AND w.turn = a.turn""")
def c07_merged_acts(spark, sf):
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("volume"), F.floor(F.col("turn") / 4).alias("page"), F.col("turn").alias("id"), F.col("turn").alias("chapter"), F.col("role").alias("title"), F.coalesce("text", F.lit("")).alias("text"))
    anchors = c.filter("chapter % 5 = 0").select("volume", "chapter")
    return O.merged_acts(c, anchors).select(F.col("volume").alias("conv_id"), F.col("id").alias("turn"), "verdict", "keeper")


# --- the gates ----------------------------------------------------------------------------------------

_HEADS = (
    "An Act to provide.",
    "CHAPTER XII.\nSenate Joint Resolution No. 3--On taxes.",
    "The Prople af the State of California do enact as follows:",
    "An aet concerning roads.\ndu enact an fellows",
    "WHEREAS, By an act entitled an act",
    'entitled "An Act to x"; chapter 12 of the laws',
)
_LABELLED = "t AS (SELECT doc_id, CASE doc_id % 6 " + " ".join(f"WHEN {k} THEN '" + h.replace("\n", "' || chr(10) || '") + "'" for k, h in enumerate(_HEADS)) + " END || chr(10) || coalesce(text, '') AS t, doc_id % 4 <> 0 AS dated FROM documents)"
_RES, _ENACT, _AN_ACT = (p.replace("'", "''") for p in (A.RESOLUTION, A.ENACTING, A.AN_ACT))


def labelled(spark, sf):
    heads = F.array(*(F.lit(h) for h in _HEADS))
    return table(spark, sf, "documents").select("doc_id", F.concat(F.element_at(heads, (F.col("doc_id") % 6 + 1).cast("int")), F.lit("\n"), F.coalesce("text", F.lit(""))).alias("t"), (F.col("doc_id") % 4 != 0).alias("dated"))


@query("p06_real_act", f"WITH {_LABELLED} SELECT doc_id, length(trim(t)) >= 200 AND (regexp_matches(t, '{_ENACT}') OR regexp_matches(t, '(?i)^\\s*An\\s+act\\b') AND dated) AS is_real FROM t")
def p06_real_act(spark, sf):
    t = labelled(spark, sf)
    return t.select("doc_id", A.is_real(F.col("t"), F.col("t"), F.when(F.col("dated"), F.lit(1))).alias("is_real"))


@query("p07_confident_gate", f"WITH {_LABELLED}, o AS (SELECT *, CASE WHEN doc_id % 6 = 1 THEN string_split(t, chr(10))[2] ELSE string_split(t, chr(10))[1] END AS opening FROM t) SELECT doc_id, NOT regexp_matches(opening, '{_RES}') AND (regexp_matches(left(t, 2000), '{_AN_ACT}') OR regexp_matches(left(t, 2000), '{_ENACT}')) AND dated AND length(trim(t)) >= 100 AS ok FROM o")
def p07_confident_gate(spark, sf):
    return labelled(spark, sf).select("doc_id", A.is_confident(F.col("t"), F.when(F.col("dated"), F.lit(1))).alias("ok"))


@query("p08_flush_rejects", f"WITH {_LABELLED} SELECT doc_id, CASE WHEN length(trim(t)) < 60 THEN 'short' WHEN doc_id % 10 = 0 THEN 'header' WHEN NOT regexp_matches(t, '{_ENACT}') THEN 'no_clause' END AS reason FROM t")
def p08_flush_rejects(spark, sf):
    header = F.when(F.col("doc_id") % 10 == 0, "CHAPTER X. [Approved May 1]").otherwise("CHAPTER X.")
    return labelled(spark, sf).select("doc_id", A.flush_reject(header, F.col("t")).alias("reason"))


@query("p09_year_clamp", """WITH y AS (SELECT o_orderkey, year(o_orderdate) AS y, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS d FROM orders)
SELECT o_orderkey, CASE WHEN abs(y - 1995 - o_orderkey % 7) <= 3 THEN d END AS approved, CASE WHEN abs(y - 1995 - o_orderkey % 7) > 3 THEN [y - 40, y] ELSE [y - 40] END AS rejected FROM y""")
def p09_year_clamp(spark, sf):
    """The first date of two is always far off; the second is near the volume's year or not."""
    o = table(spark, sf, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    text = F.concat(F.lit("Passed "), F.date_format("d", "MMMM"), F.lit(" 1st, "), (F.year("d") - 40).cast("string"), F.lit(". Approved "), F.date_format("d", "MMM d"), F.lit(", "), F.year("d").cast("string"), F.lit("."))
    found = o.select("o_orderkey", A.act_date(text, (1995 + F.col("o_orderkey") % 7).cast("int")).alias("f"))
    return found.select("o_orderkey", F.date_format("f.date", "yyyy-MM-dd").alias("approved"), F.col("f.rejected").cast("array<long>").alias("rejected"))


@query("p12_opening_line", f"WITH {_LABELLED} SELECT doc_id, CASE WHEN doc_id % 6 = 1 THEN string_split(t, chr(10))[2] ELSE string_split(t, chr(10))[1] END AS opening, doc_id % 6 IN (1, 4) AS is_resolution FROM t")
def p12_opening_line(spark, sf):
    return labelled(spark, sf).select("doc_id", A.opening_line(F.col("t")).alias("opening"), A.is_resolution(F.col("t")).alias("is_resolution"))


@query("p13_quoted_guard", f"WITH {_LABELLED}, l AS (SELECT doc_id, string_split(t, chr(10))[1] AS line FROM t) SELECT doc_id, doc_id % 6 IN (4, 5) AS quoted, doc_id % 6 = 5 AS reference, doc_id % 5 = 0 AS marginal FROM l")
def p13_quoted_guard(spark, sf):
    line = F.get(F.split("t", "\n"), F.lit(0))
    marginal = F.when(F.col("doc_id") % 5 == 0, "Section two | Chap. 4").otherwise("Chapter 4")
    return labelled(spark, sf).select("doc_id", A.quotes_title(line).alias("quoted"), A.refers_to_chapter(line).alias("reference"), A.is_marginal(marginal).alias("marginal"))


@query("p14_spill_over", f"WITH {ORDERS} SELECT volume, in_act_order, coalesce(kind <> 7 AND n.k = 7, false) AS spills FROM (SELECT acts.*, (SELECT kind FROM o WHERE o.volume = acts.volume AND o.r = acts.r + 1) AS k FROM acts) n")
def p14_spill_over(spark, sf):
    """An act whose next heading opens none has that heading in its body."""
    b = O.bodies(act_pages(spark, sf))
    return b.select("volume", F.col("in_act_order").cast("long").alias("in_act_order"), A.spills_over(F.array_join("lines", "\n")).alias("spills"))
