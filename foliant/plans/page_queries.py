"""Signals of pages, misread headings and numerals, spelled dates and alignments, over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import alignment as A
from ..functions import dates as D
from ..functions import pages as P
from ..functions import text as X
from ..operators import headings as H
from ..operators import tokens as T
from ..registry import query, table
from ..sources.paths import stored
from .token_queries import VOCAB, docs, rare, stream, vocab_known

_ASCII = r"regexp_replace(text, '[^\x00-\x7F]', '', 'g')"


def listed(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def chosen(key, texts):
    """The text at ``key`` modulo their count."""
    return F.element_at(F.array(*map(F.lit, texts)), (key % len(texts) + 1).cast("int"))


def chosen_sql(key: str, texts) -> str:
    quoted = ", ".join("'" + t.replace("'", "''") + "'" for t in texts)
    return f"[{quoted}][CAST({key} % {len(texts)} + 1 AS INT)]"


def expected(pairs, kind: str) -> str:
    """The second of each pair as an SQL list."""
    return "[" + ", ".join("NULL" if v is None else f"CAST('{v}' AS {kind})" for _, v in pairs) + "]"


# --- pages ------------------------------------------------------------------------------------------------

LEADS = ("be it enacted", "forty thousand dollars appropriated", "chapter one sec two", "index of titles", "a title of act", "the people of the state", "dollars", "whereas the code shall", "")
_PAGES = rf"""pg AS (SELECT doc_id, regexp_extract_all(lower({chosen_sql('doc_id', LEADS)} || ' ' || text), '\p{{L}}+') AS toks FROM documents),
e AS (SELECT doc_id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS k FROM pg)"""


def page_tokens(spark, sf, leads):
    return table(spark, sf, "documents").select("doc_id", X.words(F.concat(chosen(F.col("doc_id"), leads), F.lit(" "), "text")).alias("toks"))


@query("f42_page_decision", f"""WITH {_PAGES}, c AS (SELECT doc_id, coalesce(bool_or(tok = 'enacted'), false) AS enacted, count(*) FILTER (tok IN {listed(P.MONEY_WORDS)}) AS money, bool_or(tok = 'dollars') AS dollars, bool_or(tok = 'appropriated') AS grant_,
bool_or(tok IN ('chapter', 'chap')) AND bool_or(tok IN ('section', 'sec', 'sections')) AS numbered, bool_or(k <= 16 AND tok IN {listed(P.INDEX_WORDS)}) AS heading, string_agg(tok, ' ' ORDER BY k) AS whole, string_agg(tok, ' ' ORDER BY k) FILTER (k <= 30) AS head FROM e GROUP BY doc_id),
w AS (SELECT pg.doc_id, CASE WHEN c.doc_id IS NULL THEN 'no_text' WHEN enacted OR contains(' ' || whole || ' ', ' people of the state ') THEN 'rescued:enacting' WHEN dollars AND (money >= 2 OR grant_) THEN 'rescued:approp' WHEN numbered THEN 'rescued:chapsec' WHEN heading OR contains(' ' || head || ' ', ' title of act ') THEN 'confirmed' ELSE 'no_signal' END AS why FROM pg LEFT JOIN c USING (doc_id))
SELECT doc_id, CASE WHEN starts_with(why, 'rescued') THEN 'BODY' WHEN why = 'confirmed' THEN 'NONBODY' ELSE 'AMBIGUOUS' END AS decision, why FROM w""")
def f42_page_decision(spark, sf):
    return page_tokens(spark, sf, LEADS).select("doc_id", P.page_decision(F.col("toks")).alias("d")).select("doc_id", "d.*")


ROSTERS = ("members of the senate", "title of act an act an act an act an act an act", "an act", "section one of the act", "")
_ROSTER = _PAGES.replace(chosen_sql("doc_id", LEADS), chosen_sql("doc_id", ROSTERS))


@query("f43_roster_rule", f"""WITH {_ROSTER}, s AS (SELECT *, lead(tok) OVER w AS t1, lead(tok, 2) OVER w AS t2 FROM e WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
c AS (SELECT doc_id, count(*) AS n, count(DISTINCT tok) FILTER (k <= 40 AND tok IN {listed(P.ROSTER_WORDS)}) AS markers, count(*) FILTER (tok IN {listed(P.ROSTER_STATUTE_WORDS)}) / count(*) AS st, count(*) FILTER (tok = 'an' AND t1 = 'act') AS entries,
coalesce(bool_or(tok = 'title' AND (k <= 19 AND t1 IN ('act', 'acts') OR k <= 18 AND t2 IN ('act', 'acts'))), false) AS titled, doc_id % 11 / 20 AS names, doc_id % 7 / 20 AS garbled, doc_id % 3 / 100 AS places FROM s GROUP BY doc_id)
SELECT pg.doc_id, CASE WHEN markers >= 2 AND st < 0.008 THEN 'R1_marker' WHEN names > 0.35 AND st < 0.003 THEN 'R2_names' WHEN garbled >= 0.15 AND names >= 0.18 AND places >= 0.012 AND st < 0.005 THEN 'R3_fingerprint' WHEN entries >= 5 AND titled AND k1 THEN 'R4_titles' END AS rule
FROM pg LEFT JOIN (SELECT *, true AS k1 FROM c) c USING (doc_id)""")
def f43_roster_rule(spark, sf):
    k = F.col("doc_id")
    return page_tokens(spark, sf, ROSTERS).select("doc_id", P.roster_rule(F.col("toks"), k % 7 / 20, k % 11 / 20, k % 3 / 100).alias("rule"))


#: Parts of places' names that say nothing.
PLACE_PARTS = ("san", "santa", "los", "del", "contra", "lake", "orange", "luis", "new", "el")


@query("f43_roster_shares", rf"""WITH names AS (SELECT string_agg(n_name, ' ' ORDER BY n_nationkey) AS g FROM nation),
pg AS (SELECT doc_id, regexp_extract_all(lower({chosen_sql('doc_id', ROSTERS)} || ' ' || repeat(g || ' ', doc_id % 10) || coalesce(text, '')), '\p{{L}}+') AS toks FROM documents, names),
e AS (SELECT doc_id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS k FROM pg),
gaz AS (SELECT DISTINCT tok FROM (SELECT unnest(string_split(lower(n_name), ' ')) AS tok FROM nation UNION ALL SELECT unnest(string_split(lower(r_name), ' ')) FROM region) WHERE length(tok) >= 3 AND regexp_full_match(tok, '\p{{L}}+')),
plc AS (SELECT DISTINCT tok FROM (SELECT unnest(string_split(lower(r_name), ' ')) AS tok FROM region UNION ALL SELECT unnest(string_split(lower(n_name), ' ')) FROM nation WHERE n_regionkey < 2) WHERE length(tok) >= 4 AND tok NOT IN {PLACE_PARTS}),
bad AS (SELECT tok FROM e GROUP BY tok HAVING count(DISTINCT doc_id) = 1 AND length(tok) >= 6),
s AS (SELECT e.*, lead(e.tok) OVER w AS t1, lead(e.tok, 2) OVER w AS t2, gaz.tok IS NOT NULL AS is_name, plc.tok IS NOT NULL AS is_place, bad.tok IS NOT NULL AS is_bad
  FROM e LEFT JOIN gaz ON gaz.tok = e.tok LEFT JOIN plc ON plc.tok = e.tok LEFT JOIN bad ON bad.tok = e.tok WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
c AS (SELECT doc_id, count(*) AS n, count(DISTINCT tok) FILTER (k <= 40 AND tok IN {listed(P.ROSTER_WORDS)}) AS markers, count(*) FILTER (tok IN {listed(P.ROSTER_STATUTE_WORDS)}) / count(*) AS st, count(*) FILTER (tok = 'an' AND t1 = 'act') AS entries,
coalesce(bool_or(tok = 'title' AND (k <= 19 AND t1 IN ('act', 'acts') OR k <= 18 AND t2 IN ('act', 'acts'))), false) AS titled, count(*) FILTER (is_name) / count(*) AS names, count(*) FILTER (is_bad) / count(*) AS garbled, count(*) FILTER (is_place) / count(*) AS places FROM s GROUP BY doc_id)
SELECT pg.doc_id, round(names, 6) AS names, round(places, 6) AS places, round(garbled, 6) AS garbled, CASE WHEN markers >= 2 AND st < 0.008 THEN 'R1_marker' WHEN names > 0.35 AND st < 0.003 THEN 'R2_names' WHEN garbled >= 0.15 AND names >= 0.18 AND places >= 0.012 AND st < 0.005 THEN 'R3_fingerprint' WHEN entries >= 5 AND titled THEN 'R4_titles' END AS rule
FROM pg LEFT JOIN c USING (doc_id)""")
def f43_roster_shares(spark, sf):
    """Shares counted from the pages' words: nations and regions as the gazetteer, words that one page alone has as
    garbled ones. Pages are documents behind up to nine lists of nations."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    listing = nation.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"]), " ").alias("g"))  # 25 rows
    docs_ = table(spark, sf, "documents").crossJoin(F.broadcast(listing))
    text = F.concat(chosen(F.col("doc_id"), ROSTERS), F.lit(" "), F.expr("repeat(concat(g, ' '), CAST(doc_id % 10 AS INT))"), F.coalesce("text", F.lit("")))
    texts = docs_.select("doc_id", text.alias("text"))
    pages = stored(texts.select("doc_id", X.words(F.col("text")).alias("toks")), "pages")
    own = T.words_of_one(texts).filter("length(tok) >= 6").groupBy("doc_id").agg(F.sum("freq").alias("n"))
    names = H.listed_words(nation.select(F.col("n_name").alias("x")).unionByName(region.select(F.col("r_name").alias("x"))), ["x"], 3)
    places = H.listed_words(region.select(F.col("r_name").alias("x")).unionByName(nation.filter("n_regionkey < 2").select(F.col("n_name").alias("x"))), ["x"], 4, PLACE_PARTS)
    found = H.shares(pages, "doc_id", "toks", T.vocabulary(texts), {"garbled": own}, names=names, places=places)
    found = pages.select("doc_id", P.roster_signs(F.col("toks")).alias("signs")).join(found, "doc_id", "left")
    rule = P.rule_of_signs(F.col("signs"), F.col("garbled"), F.col("names"), F.col("places")).alias("rule")
    return found.select("doc_id", *(F.round(c, 6).alias(c) for c in ("names", "places", "garbled")), rule)


# --- headings and numerals --------------------------------------------------------------------------------

HEADINGS = (("CHAPTER 12.", 12), ("-- UHAPTER 1O2 An Act", 102), ("CIIAPTER l7.", 17), ("chapter 877 of the statutes", None), ("CHAPTER II.", None), ("SECTION 12", None), ("CHAPTER 12345", None), ("Chaptcr 9 . OF", None), ("see CHAPTER 4", None), ("CHAPTERS 31, 32", 31))


@query("f45_misread_heading", f"SELECT o_orderkey, {expected(HEADINGS, 'INTEGER')}[CAST(o_orderkey % {len(HEADINGS)} + 1 AS INT)] AS number FROM orders")
def f45_misread_heading(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", P.misread_heading(chosen(F.col("o_orderkey"), [h for h, _ in HEADINGS])).alias("number"))


NUMBERED = (" 8xo2 in 1st 3817c7 l5b7", " o123 and 12a", " a1 ab12 123o", " 19x66 3rd", "")
_NUMBERED = f"t AS (SELECT doc_id, {_ASCII} || {chosen_sql('doc_id', NUMBERED)} AS t FROM documents)"


@query("f47_damaged_numbers", rf"""WITH {_NUMBERED}, x AS (SELECT doc_id, t, regexp_extract_all(t, '\b[A-Za-z0-9]{{3,10}}\b') AS w FROM t)
SELECT doc_id, CAST(len(list_filter(w, lambda x: regexp_matches(x, '[0-9]') AND regexp_matches(x, '[A-Za-z]') AND NOT regexp_matches(x, '^[0-9]+(st|nd|rd|th|ST|ND|RD|TH)$') AND NOT regexp_matches(x, '^[0-9]+[a-zA-Z]{{1,2}}$') AND NOT regexp_matches(x, '^[A-Za-z]{{1,3}}[0-9]+$'))) AS INTEGER) AS n,
regexp_matches(t, '\b\d+[a-wyzA-WYZ]\d+\b|\b[oOlI][0-9]{{3,}}\b|\b\d{{3,}}[oOlI]\b') AS sure FROM x""")
def f47_damaged_numbers(spark, sf):
    t = F.concat(F.regexp_replace("text", r"[^\x00-\x7F]", ""), chosen(F.col("doc_id"), NUMBERED))
    return table(spark, sf, "documents").select("doc_id", P.damaged_numbers(t).alias("n"), P.surely_damaged(t).alias("sure"))


SECTIONS = (("12.", False), ("l2", True), ("12a", False), ("3.5", False), ("o", True), ("4l7b", True), ("I.", True), ("A", False), ("", False), ("1,2,3", False))


@query("f47_damaged_sections", f"SELECT o_orderkey, {expected(SECTIONS, 'BOOLEAN')}[CAST(o_orderkey % {len(SECTIONS)} + 1 AS INT)] AS damaged FROM orders")
def f47_damaged_sections(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", P.damaged_section(chosen(F.col("o_orderkey"), [s for s, _ in SECTIONS])).alias("damaged"))


GARBLED = (("CHAPIER 3\nAn act", "chapter"), ("SECTION 1. Approved", ""), ("\n  SEcTION 4", "section"), ("Appioved May 1", "approval"), ("Fuled with  Secretary; chapten", "approval"), ("CHAPT. 4\nSECTON 2 [Approyed", "chapter section approval"), ("appropriation of CHAPTERS", ""), (" chapten", ""))


@query("f49_misread_keywords", f"SELECT o_orderkey, {expected(GARBLED, 'VARCHAR')}[CAST(o_orderkey % {len(GARBLED)} + 1 AS INT)] AS kinds FROM orders")
def f49_misread_keywords(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(P.misread_keywords(chosen(F.col("o_orderkey"), [g for g, _ in GARBLED])), " ").alias("kinds"))


LAWS = (
    ("[Approved May 3, 1866.]", "approved", None),
    ("it has become a law this twenty-seventh day of February, A. D. eighteen hundred and sixty-six.", "unsigned_lapse", "1866-02-27"),
    ("became a law by operation of the Constitution, February 27, 1866", "unsigned_lapse", "1866-02-27"),
    ("became a law by operation of the Constitution, 380 | An Act approved March 30, 1866", "unsigned_lapse", None),
    ("became law effective May 1, 1866", "approved", None),
    ("Passed the Assembly notwithstanding the veto of the Governor; became a law March 18, 1876", "veto_override", "1876-03-18"),
    ("becomes a law this thirty-fifth day of May, eighteen hundred and sixty-six.", "unsigned_lapse", None),
    ("become a law this first day of June, one thousand nine hundred and four;", "unsigned_lapse", "1904-06-01"),
)


@query("f21_f22_lapses", f"SELECT o_orderkey, {expected([(a, b) for a, b, _ in LAWS], 'VARCHAR')}[CAST(o_orderkey % {len(LAWS)} + 1 AS INT)] AS path, {expected([(a, c) for a, _, c in LAWS], 'VARCHAR')}[CAST(o_orderkey % {len(LAWS)} + 1 AS INT)] AS day FROM orders")
def f21_f22_lapses(spark, sf):
    t = chosen(F.col("o_orderkey"), [law for law, _, _ in LAWS])
    return table(spark, sf, "orders").select("o_orderkey", P.enactment_path(t).alias("path"), F.date_format(D.lapse_date(t), "yyyy-MM-dd").alias("day"))


@query("f51_index_entries", r"""WITH o AS (SELECT o_custkey, o_orderkey AS line_no, CAST(o_orderkey % 4999 + 1 AS VARCHAR) AS c, CAST(o_orderkey % 700 AS VARCHAR) AS p FROM orders),
l AS (SELECT *, CASE o_n % 4 WHEN 0 THEN true ELSE false END AS starts FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY line_no) - 1 AS o_n FROM o)),
g AS (SELECT *, o_n // 4 AS entry FROM l)
SELECT o_custkey, min(line_no) AS line_no, CAST(max(CASE WHEN starts THEN c END) AS INTEGER) AS chapter, CAST(nullif(CAST(max(CASE WHEN o_n % 4 = 2 THEN p END) AS INTEGER), 0) AS INTEGER) AS page FROM g GROUP BY o_custkey, entry""")
def f51_index_entries(spark, sf):
    by = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    o = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("line_no"), ((F.row_number().over(by) - 1) % 4).alias("k"))
    c, p = (F.col("line_no") % 4999 + 1).cast("string"), (F.col("line_no") % 700).cast("string")
    line = F.when(F.col("k") == 0, F.concat(c, F.lit(" | An Act to amend"))).when(F.col("k") == 1, "an act, A. B. 122").when(F.col("k") == 2, F.concat(F.lit("relating to roads, S. B. 9 "), p)).otherwise("continued")
    return H.index_entries(o.withColumn("line", line), "o_custkey")


_BROKEN = (" | An Act to amend", "an act, A.", "B. 122 and others, S.", "B. C. ", ". R", "", ". 9 relating to roads ", "continued B. R.", "77")


@query("f51_broken_bills", rf"""WITH o AS (SELECT o_custkey, o_orderkey AS line_no, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS k FROM orders),
l AS (SELECT o_custkey, line_no, k // 9 AS entry, CAST(line_no % 4999 + 1 AS VARCHAR) AS c,
  CASE k % 9 {' '.join(f"WHEN {k} THEN '{t}'" for k, t in enumerate(_BROKEN))} END || CASE WHEN k % 9 = 6 THEN CAST(line_no % 700 + 1 AS VARCHAR) ELSE '' END AS t, k % 9 = 0 AS begins FROM o),
e AS (SELECT o_custkey, min(line_no) AS line_no, CAST(max(c) FILTER (begins) AS INTEGER) AS chapter, string_agg(CASE WHEN begins THEN c ELSE '' END || t, ' ' ORDER BY line_no) AS block FROM l GROUP BY o_custkey, entry),
n AS (SELECT *, regexp_extract_all(regexp_replace(block, '(?i)[ASB]\s*\.?\s*[ABCJR]\s*\.?\s*(?:R\s*\.?\s*)?[0-9]{{1,4}}', ' ', 'g'), '[0-9]{{1,4}}') AS v FROM e)
SELECT o_custkey, line_no, chapter, CASE WHEN NOT (len(v) = 1 AND CAST(v[1] AS INTEGER) = chapter) THEN CAST(v[-1] AS INTEGER) END AS page FROM n""")
def f51_broken_bills(spark, sf):
    """Bills' numbers broken over up to five lines, an empty one among them; the oracle joins each entry's lines."""
    by = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    o = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("line_no"), ((F.row_number().over(by) - 1) % 9).alias("k"))
    text = chosen(F.col("k"), _BROKEN)
    line = F.when(F.col("k") == 0, F.concat((F.col("line_no") % 4999 + 1).cast("string"), text)).when(F.col("k") == 6, F.concat(text, (F.col("line_no") % 700 + 1).cast("string"))).otherwise(text)
    return H.index_entries(o.withColumn("line", line), "o_custkey")


# --- tokens -----------------------------------------------------------------------------------------------


@query("f50_composed_tokens", r"""WITH t AS (SELECT doc_id, regexp_replace(nfc_normalize(replace(text, 'é', 'e' || chr(769)) || ' Well-to-do x'), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]', ' ', 'g') AS t FROM documents),
w AS (SELECT doc_id, unnest(regexp_extract_all(t, '[A-Za-zÀ-ÿ]+(?:-[A-Za-zÀ-ÿ]+)*')) AS w FROM t), p AS (SELECT doc_id, lower(w) AS w FROM w UNION ALL SELECT doc_id, unnest(string_split(lower(w), '-')) FROM w WHERE contains(w, '-') AND length(w) >= 2)
SELECT doc_id, w AS tok, count(*) AS n FROM p WHERE length(w) >= 2 GROUP BY ALL""")
def f50_composed_tokens(spark, sf):
    t = F.concat(F.replace("text", F.lit("\u00e9"), F.lit("e\u0301")), F.lit(" Well-to-do x"))
    return T.index_counts(table(spark, sf, "documents").select("doc_id", t.alias("text")))


_TURNS = r"""c AS (SELECT conv_id, turn, coalesce(text, '') AS new, coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '') AS old FROM conversations),
k AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(old, '\s+'), lambda x: x <> '') AS a, list_filter(regexp_split_to_array(new, '\s+'), lambda x: x <> '') AS b FROM c)"""


def turns(spark, sf):
    text = F.coalesce("text", F.lit(""))
    old = F.coalesce(F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn")), F.lit(""))
    return table(spark, sf, "conversations").select("conv_id", "turn", X.tokens(old).alias("a"), X.tokens(text).alias("b"))


@query("f56_token_diff", f"WITH {_TURNS} SELECT conv_id, turn, array_to_string(a, ' ') AS old, array_to_string(b, ' ') AS new FROM k")
def f56_token_diff(spark, sf):
    """Each turn's diff to the one before it, put together again to both."""
    d = turns(spark, sf).select("conv_id", "turn", A.token_diff("a", "b").alias("d"))
    side = lambda but: F.array_join(F.flatten(F.transform(F.filter("d", lambda x: x["op"] != but), lambda x: x["tokens"])), " ")
    return d.select("conv_id", "turn", side("insert").alias("old"), side("delete").alias("new"))


@query("f08_token_errors", r"""WITH k AS (SELECT item_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS a FROM benchmark) SELECT item_id, list_filter(range(len(a)), lambda i: i % 5 = 2) AS wrong FROM k""")
def f08_token_errors(spark, sf):
    gold = table(spark, sf, "benchmark").select("item_id", X.tokens(F.col("text")).alias("a"))
    read = F.transform("a", lambda t, k: F.when(k % 5 == 2, F.concat(F.lit("#"), k.cast("string"))).otherwise(F.concat(t, F.lit(","))))
    return gold.select("item_id", A.token_errors(F.col("a"), read).cast("array<long>").alias("wrong"))


@query("f07_best_span", """SELECT item_id, CAST(8 AS INTEGER) AS start, CAST(length(text) // 37 AS INTEGER) AS distance, length(text) + 5 + length(text) // 37 AS n FROM benchmark""")
def f07_best_span(spark, sf):
    """A text within a longer one, a strange character after each 37 of it; other damage is tested against brute force."""
    t = table(spark, sf, "benchmark").select("item_id", F.concat("text", F.lit("zzzzz")).alias("t"), F.regexp_replace("text", "(?s)(.{37})", "$1%").alias("d"))
    found = t.select("item_id", A.best_span("t", F.concat(F.lit("#0#1#2#3"), F.col("d"), F.lit("zzzzz%%%% and more"))).alias("s"))
    return found.select("item_id", F.col("s.start").alias("start"), F.col("s.distance").alias("distance"), F.length("s.span").cast("long").alias("n"))


@query("f09_garbles", r"""WITH k AS (SELECT item_id, list_filter(list_distinct(regexp_split_to_array(lower(text), '[^a-z]+')), lambda x: length(x) >= 6) AS a FROM benchmark)
SELECT item_id, CAST(len(list_filter(range(len(a)), lambda i: i % 4 = 1)) AS INTEGER) AS splits, CAST(len(list_filter(range(len(a)), lambda i: i % 4 = 3)) AS INTEGER) AS doubles FROM k""")
def f09_garbles(spark, sf):
    """Of each four long words the second is broken in two, the fourth stands twice."""
    words = F.filter(F.array_distinct(F.split(F.lower("text"), "[^a-z]+")), lambda x: F.length(x) >= 6)
    gold = table(spark, sf, "benchmark").select("item_id", words.alias("a"))
    # a mark of its own ends each word, so that no broken piece is a part of another
    marked = F.transform("a", lambda t, k: F.concat(t, F.lit("0"), k.cast("string")))
    whole = lambda t, k: F.concat(t, F.lit("0"), k.cast("string"))
    read = F.flatten(F.transform("a", lambda t, k: F.when(k % 4 == 1, F.array(F.concat(t, F.lit("0")), k.cast("string"))).when(k % 4 == 3, F.array(whole(t, k), whole(t, k))).otherwise(F.array(whole(t, k)))))
    g = A.with_garbles(gold, marked, read, "g")
    return g.select("item_id", "g.splits", "g.doubles")


@query("f48_date_damage", """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN [] WHEN 1 THEN ['field_year:' || (y + 20)] WHEN 2 THEN ['text_year:' || (y + 30)] WHEN 3 THEN ['year_symbol:' || left(CAST(y AS VARCHAR), 3) || '%'] WHEN 4 THEN ['five_digits:' || y || '7'] ELSE ['day:38'] END AS damage FROM (SELECT o_orderkey, 1900 + o_orderkey % 70 AS y FROM orders)""")
def f48_date_damage(spark, sf):
    k, y = F.col("o_orderkey") % 6, (1900 + F.col("o_orderkey") % 70).cast("int")
    line = lambda year: F.concat(F.lit("An act amended by Statutes of 1871. [Approved by Governor March 3, "), year, F.lit(".]"))
    year = y.cast("string")
    text = (
        F.when(k == 2, line((y + 30).cast("string")))
        .when(k == 3, line(F.concat(F.substring(year, 1, 3), F.lit("%"))))
        .when(k == 4, line(F.concat(year, F.lit("7"))))
        .when(k == 5, F.concat(line(year), F.lit(" It ends on May 38.")))
        .otherwise(line(year))
    )
    approved = F.when(k == 1, F.concat(F.lit("Approved March 3, "), (y + 20).cast("string"))).otherwise(F.concat(F.lit("Approved March 3, "), year))
    return table(spark, sf, "orders").select("o_orderkey", D.date_damage(text, approved, y).alias("damage"))


@query("c18_two_readings", r"""WITH k AS (SELECT item_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS n FROM benchmark), i AS (SELECT item_id, unnest(range(n)) AS i FROM k)
SELECT item_id, count(*) AS n_tokens, count(*) FILTER (i % 5 = 2) AS wrong_one, count(*) FILTER (i % 7 = 2) AS wrong_both, count(*) FILTER (i % 5 = 2 AND i % 7 <> 2) AS fixed, count(*) FILTER (i % 7 = 2 AND i % 5 <> 2) AS regressed FROM i GROUP BY item_id""")
def c18_two_readings(spark, sf):
    """One reader's page and a consensus beside the true text."""
    gold = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("gold"), X.tokens(F.col("text")).alias("a"))
    read = lambda m: F.array_join(F.transform("a", lambda t, k: F.when(k % m == 2, F.concat(F.lit("#"), k.cast("string"))).otherwise(t)), " ")
    rows = H.two_readings(gold.withColumns({"one": read(5), "both": read(7)}), "gold", "one", "both")
    return rows.select("item_id", "n_tokens", "wrong_one", "wrong_both", "fixed", "regressed")


@query("c14_singletons")
def c14_singletons(spark, sf):
    """Tested against brute force, since DuckDB's distance lets a place be edited twice."""
    v, known = vocab_known(spark, sf)
    ones = T.join_words(T.places(docs(spark, sf)), stored(rare(v), "rare"), v, "left_semi")
    return H.singleton_classes(stored(ones.select("tok", "prev", "next"), "singletons"), known)


@query("c15_recoverable", f"""WITH {VOCAB}, u AS (SELECT tok, freq, length(regexp_replace(tok, '[\\x00-\\x7F]', '', 'g')) AS odd, regexp_matches(tok, '[bcdfghjklmnpqrstvwxz]{{5,}}') AS clump, NOT regexp_matches(tok, '[aeiouy]') AND length(tok) >= 5 AS bare FROM vocab WHERE doc_freq < 25 AND length(tok) >= 2 AND NOT regexp_matches(tok, '^[ivxlcdm]{{2,}}$')),
r AS (SELECT tok, freq FROM u WHERE odd = 1 AND length(tok) <= 16 OR odd = 0 AND NOT clump AND NOT bare AND length(tok) < 25 AND NOT regexp_matches(tok, '{"|".join(c + "{4}" for c in T.ALPHABET)}')),
k AS (SELECT tok, CAST(unnest(range(5, length(tok) - 1)) AS INT) AS k FROM known WHERE length(tok) >= 7), part AS (SELECT DISTINCT left(tok, k) AS part FROM k UNION SELECT right(tok, k) FROM k), names AS (SELECT lower(n_name) AS name FROM nation)
SELECT CASE WHEN regexp_matches(tok, '[^\\x00-\\x7F]') THEN 'MOJIBAKE' WHEN length(tok) <= 4 THEN 'SHORT' WHEN tok IN (SELECT part FROM part) THEN 'FRAGMENT' WHEN tok IN (SELECT name FROM names) THEN 'NAMELIKE' ELSE 'HARD' END AS bucket,
CASE WHEN freq >= 10 THEN '10+' WHEN freq >= 2 THEN '2-9' ELSE 'singleton' END AS tier, count(*) AS types, CAST(sum(freq) AS BIGINT) AS occurrences FROM r GROUP BY ALL""")
def c15_recoverable(spark, sf):
    v, known = vocab_known(spark, sf)
    names = table(spark, sf, "nation").select(F.lower("n_name").alias("tok"))
    return H.recoverable_buckets(v.filter("doc_freq < 25"), known, names)


@query("f02_swap_distance")
def f02_swap_distance(spark, sf):
    """Neighbouring words of a line, at most three edits apart."""
    pairs = T.pair_counts(docs(spark, sf)).select(F.col("prev").alias("tok"), "next")
    # a swap is two plain edits at the most, and where one is enough there is none
    plain = F.levenshtein("tok", "next", 6)
    near = stored(pairs.filter(F.abs(F.length("tok") - F.length("next")) <= 3).withColumn("d", plain).filter("d >= 0"), "near-pairs")
    far = near.filter("d > 1").withColumn("d", A.swap_distance("tok", "next", F.lit(3))).filter("d <= 3")
    return near.filter("d <= 1").unionByName(far)


@query("a18_page_cover", f"""WITH {VOCAB}, p AS (SELECT DISTINCT doc_id, s.tok FROM stream s JOIN vocab v ON v.tok = s.tok WHERE doc_freq BETWEEN 2 AND 24 AND length(s.tok) >= 6),
n AS (SELECT doc_id, count(*) AS n_tokens FROM p GROUP BY doc_id), o AS (SELECT doc_id, n_tokens, row_number() OVER (ORDER BY n_tokens DESC, doc_id) AS k FROM n)
SELECT a.doc_id, a.n_tokens, count(*) AS n_new FROM o a JOIN p ON p.doc_id = a.doc_id WHERE NOT EXISTS (SELECT 1 FROM p q JOIN o b ON b.doc_id = q.doc_id WHERE q.tok = p.tok AND b.k < a.k) GROUP BY ALL""")
def a18_page_cover(spark, sf):
    v, _ = vocab_known(spark, sf)
    wanted = v.filter((F.col("doc_freq").between(2, 24)) & (F.length("tok") >= 6)).select("tok")
    return H.page_cover(T.join_words(stream(spark, sf), stored(wanted, "wanted"), v, "left_semi"), "doc_id", "tok")


@query("j21_paired_headings", """WITH h AS (SELECT o_custkey, o_orderkey AS id, o_orderstatus = 'O' AS kept, dayofyear(o_orderdate) / 366 AS pos FROM orders),
a AS (SELECT * FROM h WHERE kept), b AS (SELECT * FROM h WHERE NOT kept), near AS (SELECT a.*, (SELECT b.id FROM b WHERE b.o_custkey = a.o_custkey ORDER BY abs(a.pos - b.pos), b.id LIMIT 1) AS other FROM a)
SELECT n.o_custkey, n.id, n.other FROM near n JOIN b ON b.id = n.other WHERE abs(n.pos - b.pos) <= 0.18::DOUBLE
AND NOT EXISTS (SELECT 1 FROM b c WHERE c.o_custkey = n.o_custkey AND c.id <> n.other AND abs(n.pos - c.pos) <= 0.18::DOUBLE AND abs(n.pos - c.pos) - abs(n.pos - b.pos) < 0.04::DOUBLE)
AND n.id = (SELECT a.id FROM a WHERE a.o_custkey = b.o_custkey ORDER BY abs(a.pos - b.pos), a.id LIMIT 1)""")
def j21_paired_headings(spark, sf):
    h = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "O").alias("kept"), (F.dayofyear("o_orderdate") / 366).alias("pos"))
    return H.paired_headings(h.filter("kept"), h.filter("NOT kept"), "o_custkey")
