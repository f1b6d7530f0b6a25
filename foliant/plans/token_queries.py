"""Functions of text, numerals and dates, and the token operators, over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numerals as N
from ..functions import text as X
from ..operators import tokens as T
from ..registry import query, table
from ..sources.paths import stored

STREAM = r"""lines AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents),
stream AS (SELECT doc_id, line_no, generate_subscripts(regexp_extract_all(lower(line), '\p{L}+'), 1) - 1 AS tok_no, unnest(regexp_extract_all(lower(line), '\p{L}+')) AS tok FROM lines)"""
VOCAB = f"""{STREAM}, vocab AS (SELECT tok, count(*) AS freq, count(DISTINCT doc_id) AS doc_freq, min(doc_id) AS example FROM stream GROUP BY tok),
known AS (SELECT tok, freq FROM vocab WHERE doc_freq >= 25)"""
#: Words seen once that the vocabulary doesn't hold.
RARE = f"{VOCAB}, rare AS (SELECT tok FROM vocab WHERE freq = 1)"


def stream(spark, sf):
    return T.token_stream(table(spark, sf, "documents"))


def docs(spark, sf):
    return table(spark, sf, "documents")


def vocab_known(spark, sf):
    """The vocabulary, counted once and written, and its words of 25 documents or more."""
    v = stored(T.vocabulary(docs(spark, sf)), "vocabulary")
    return v, T.known_words(v, 25)


def rare(v):
    return v.filter("freq = 1").select("tok")


# --- sources of lines and tokens ------------------------------------------------------------------------


@query("s03_lines", f"WITH {STREAM} SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM lines")
def s03_lines(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


@query("f11_tokens", r"SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS BIGINT) AS n, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')[1] AS first FROM documents")
def f11_tokens(spark, sf):
    t = X.tokens(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.size(t).cast("long").alias("n"), F.get(t, F.lit(0)).alias("first"))


@query("f12_vote_key", """WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')[3] AS tok FROM documents) SELECT doc_id, lower(trim(tok, E' \\t\\n\\r.,;:!?"''`()[]{}')) AS key FROM t""")
def f12_vote_key(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.vote_key(F.get(X.tokens(F.col("text")), F.lit(2))).alias("key"))


@query("f10_dehyphenate", r"SELECT doc_id, sha256(regexp_replace(replace(text, 'th', '-' || chr(10)), '(\p{L})-\n(\p{L})', '\1\2', 'g')) AS digest FROM documents")
def f10_dehyphenate(spark, sf):
    broken = F.replace("text", F.lit("th"), F.lit("-\n"))
    return table(spark, sf, "documents").select("doc_id", F.sha2(X.dehyphenated(broken), 256).alias("digest"))


#: DuckDB counts a distance in bytes: letters of two bytes become control characters, each its own.
_LETTERS = "ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöüÀâôûî"
_CODES = "||".join(f"chr({k})" for k in [*range(1, 9), *range(14, 32)])


#: All pairs are made by pairs of this number of blocks: a text is sent to so many of them on each side.
TEXT_BLOCKS = 16


def bytewise(sql: str) -> str:
    return f"translate({sql}, '{_LETTERS}', {_CODES})"


@query("f04_levenshtein", f"SELECT a.item_id AS a, b.item_id AS b, CAST(levenshtein({bytewise('a.text')}, {bytewise('b.text')}) AS INTEGER) AS d FROM benchmark a JOIN benchmark b ON a.item_id < b.item_id")
def f04_levenshtein(spark, sf):
    """All pairs of whole texts: quadratic by nature, so both sides are dealt into blocks and each pair of blocks is a
    key of the join; no side is held whole in one place."""
    t = table(spark, sf, "benchmark").select("item_id", "text").filter("item_id IS NOT NULL")
    block, every = F.pmod(F.xxhash64("item_id", "text"), F.lit(TEXT_BLOCKS)), F.explode(F.sequence(F.lit(0), F.lit(TEXT_BLOCKS - 1)))
    side = lambda n, own, other: t.select(F.col("item_id").alias(n), F.col("text").alias(f"t{n}"), block.cast("int").alias(own), every.alias(other))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a given number: few bytes make many pairs
    dealt = lambda df: df.repartition(n, "x_", "y_")
    both = dealt(side("a", "x_", "y_")).hint("shuffle_merge").join(dealt(side("b", "y_", "x_")), ["x_", "y_"]).filter("a < b")
    return both.select("a", "b", F.levenshtein("ta", "tb").alias("d"))


_RATE = rf"""n AS (SELECT item_id, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS a FROM benchmark),
m AS (SELECT item_id, a, CASE WHEN item_id % 7 = 0 THEN NULL WHEN item_id % 3 = 0 THEN a WHEN item_id % 3 = 1 THEN replace(a, 'the', 'tbe') ELSE reverse(a) END AS b, item_id % 5 <> 4 AS found FROM n),
r AS (SELECT *, CASE WHEN length(a) = 0 THEN 1.0 ELSE levenshtein({bytewise('a')}, {bytewise('b')}) / length(a) END AS rate FROM m)"""


def pairs(spark, sf):
    a = X.normalised(F.col("text"))
    t = table(spark, sf, "benchmark").select("item_id", a.alias("a"))
    b = F.when(F.col("item_id") % 7 == 0, F.lit(None)).when(F.col("item_id") % 3 == 0, F.col("a")).when(F.col("item_id") % 3 == 1, F.replace("a", F.lit("the"), F.lit("tbe"))).otherwise(F.reverse("a"))
    return t.withColumns({"b": b, "found": F.col("item_id") % 5 != 4})


@query("f05_error_rate", f"WITH {_RATE} SELECT item_id, round(rate, 6) AS rate FROM r")
def f05_error_rate(spark, sf):
    return pairs(spark, sf).select("item_id", F.round(X.error_rate(F.col("a"), F.col("b")), 6).alias("rate"))


@query("f06_match_category", f"WITH {_RATE} SELECT item_id, CASE WHEN NOT found THEN 'NO_VERSION' WHEN b IS NULL THEN 'NULL_TEXT' WHEN rate = 0 THEN 'EXACT' WHEN rate < 0.05 THEN 'NEAR' WHEN rate < 0.3 THEN 'PARTIAL' ELSE 'MISMATCH' END AS category FROM r")
def f06_match_category(spark, sf):
    return pairs(spark, sf).select("item_id", X.match_category(F.col("a"), F.col("b"), F.col("found")).alias("category"))


@query("f03_deletes", f"WITH {VOCAB}, w AS (SELECT tok FROM known) SELECT DISTINCT tok, unnest(list_concat([tok], [left(tok, CAST(i AS INT) - 1) || substr(tok, CAST(i AS INT) + 1) FOR i IN range(1, length(tok) + 1)])) AS key FROM w")
def f03_deletes(spark, sf):
    _, known = vocab_known(spark, sf)
    return known.select("tok", F.explode(X.deletes(F.col("tok"))).alias("key"))


# --- numerals and dates ---------------------------------------------------------------------------------

_ROMAN_SQL = """roman AS (SELECT i AS n,
  ['', 'M', 'MM', 'MMM'][CAST(i // 1000 + 1 AS INT)] || ['', 'C', 'CC', 'CCC', 'CD', 'D', 'DC', 'DCC', 'DCCC', 'CM'][CAST(i // 100 % 10 + 1 AS INT)]
  || ['', 'X', 'XX', 'XXX', 'XL', 'L', 'LX', 'LXX', 'LXXX', 'XC'][CAST(i // 10 % 10 + 1 AS INT)] || ['', 'I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX'][CAST(i % 10 + 1 AS INT)] AS r FROM range(1, 4000) t(i))"""


@query("f13_f15_roman", f"WITH {_ROMAN_SQL} SELECT c_custkey, r AS roman, c_custkey AS back FROM customer JOIN roman ON n = c_custkey")
def f13_f15_roman(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", N.int_to_roman(F.col("c_custkey")).alias("roman")).filter("roman IS NOT NULL")
    return c.withColumn("back", N.roman_to_int(F.col("roman")).cast("long"))


@query("f14_canonical", f"WITH {_ROMAN_SQL}, w AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN r WHEN 1 THEN r || 'I' ELSE r || 'Q' END AS raw FROM customer JOIN roman ON n = c_custkey) SELECT c_custkey, raw, CAST(b.n AS INTEGER) AS value FROM w LEFT JOIN roman b ON b.r = raw")
def f14_canonical(spark, sf):
    r = N.int_to_roman(F.col("c_custkey"))
    raw = F.when(F.col("c_custkey") % 3 == 0, r).when(F.col("c_custkey") % 3 == 1, F.concat(r, F.lit("I"))).otherwise(F.concat(r, F.lit("Q")))
    return table(spark, sf, "customer").filter("c_custkey BETWEEN 1 AND 3999").select("c_custkey", raw.alias("raw")).withColumn("value", N.canonical_roman(F.col("raw")))


@query("f16_misread_numeral", """SELECT n_nationkey, raw, CAST(value AS INTEGER) AS value FROM nation JOIN (VALUES (0, 'XIl', 12), (1, 'VJI', 7), (2, '14', 14), (3, 'XX!', 21), (4, 'LXXIL', 72), (5, '9999', 0), (6, 'abc', 0), (7, 'CXT.', 111), (8, '1V', 4), (9, 'XL|', 41), (10, '', 0)) v(k, raw, value) ON k = n_nationkey""")
def f16_misread_numeral(spark, sf):
    raws = ["XIl", "VJI", "14", "XX!", "LXXIL", "9999", "abc", "CXT.", "1V", "XL|", ""]
    raw = F.get(F.array(*map(F.lit, raws)), F.col("n_nationkey"))
    return table(spark, sf, "nation").filter(F.col("n_nationkey") < len(raws)).select("n_nationkey", raw.alias("raw")).withColumn("value", N.misread_numeral(F.col("raw")).cast("int"))


@query("p05_p11_numerals", f"""WITH {_ROMAN_SQL}, w AS (SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN r WHEN 1 THEN CAST(c_custkey AS VARCHAR) WHEN 2 THEN CAST(c_custkey * 10 AS VARCHAR) ELSE r || 'IIIII' END AS raw FROM customer JOIN roman ON n = c_custkey)
SELECT k, raw, k % 4 IN (0, 1) AS clean, CASE k % 4 WHEN 0 THEN true WHEN 1 THEN k <= 5000 WHEN 2 THEN k * 10 <= 5000 ELSE false END AS plausible FROM w""")
def p05_p11_numerals(spark, sf):
    k = F.col("k")
    r = N.int_to_roman(k)
    raw = F.when(k % 4 == 0, r).when(k % 4 == 1, k.cast("string")).when(k % 4 == 2, (k * 10).cast("string")).otherwise(F.concat(r, F.lit("IIIII")))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k")).filter("k BETWEEN 1 AND 3999").withColumn("raw", raw)
    return c.select("k", "raw", N.clean(F.col("raw"), k).alias("clean"), N.plausible(F.col("raw")).alias("plausible"))


@query("f46_extra_digit", "SELECT o_orderkey, list_contains([left(r, CAST(i AS INT) - 1) || substr(r, CAST(i AS INT) + 1) FOR i IN range(1, length(r) + 1)], CAST(o_custkey AS VARCHAR)) AS hit FROM (SELECT o_orderkey, o_custkey, CAST(o_custkey AS VARCHAR) || CASE WHEN o_orderkey % 2 = 0 THEN '7' ELSE '73' END AS r FROM orders)")
def f46_extra_digit(spark, sf):
    r = F.concat(F.col("o_custkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, "7").otherwise("73"))
    return table(spark, sf, "orders").select("o_orderkey", N.one_digit_too_many(r, F.col("o_custkey")).alias("hit"))


@query("f18_f20_approved_dates", """WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL WHEN 2 THEN strftime(d + INTERVAL 0 DAY, '%Y-%m-%d') ELSE strftime(d, '%Y-%m-%d') END AS approved FROM o""")
def f18_f20_approved_dates(spark, sf):
    d = F.col("o_orderdate").cast("date")
    plain = F.concat(F.lit("Approved "), F.date_format(d, "MMMM d"), F.lit(", "), F.year(d).cast("string"), F.lit("."))
    kind = F.col("o_orderkey") % 4
    text = (
        F.when(kind == 0, plain)
        .when(kind == 1, F.concat(F.lit("Passed June 31st, 1871 and approved "), F.date_format(d, "MMM"), F.lit(". "), F.dayofmonth(d).cast("string"), F.lit("th, "), F.year(d).cast("string")))
        .when(kind == 2, F.concat(F.lit("June 3, 1850. "), plain))
        .otherwise("no date, June 3 1997")
    )
    return table(spark, sf, "orders").select("o_orderkey", F.date_format(D.approved_date(text, F.year(d)), "yyyy-MM-dd").alias("approved"))


@query("f24_f30_sessions", """WITH o AS (SELECT o_orderkey, year(o_orderdate) AS y, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, CAST(y - CASE WHEN y % 2 = 0 THEN 1 ELSE 0 END AS VARCHAR) || '-' || CAST(y - CASE WHEN y % 2 = 0 THEN 1 ELSE 0 END + 1 AS VARCHAR) AS session,
strftime(CASE WHEN o_orderkey % 3 = 0 THEN d ELSE make_date(y + 1, 1, 1) END, '%Y-%m-%d') AS operative, CASE WHEN o_orderkey % 2 = 0 THEN '[' || strftime(d, '%Y-%m-%d') ELSE '(' END || ',)' AS span,
CASE WHEN y < 2000 THEN '1950-1999' ELSE 'from 2000' END AS era, CAST(2500 AS INTEGER) AS ceiling FROM o""")
def f24_f30_sessions(spark, sf):
    d = F.col("o_orderdate").cast("date")
    y = F.year(d)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        D.session_label(y).alias("session"),
        F.date_format(D.operative_date(d, F.col("o_orderkey") % 3 == 0), "yyyy-MM-dd").alias("operative"),
        D.range_literal(F.when(F.col("o_orderkey") % 2 == 0, d), F.lit(None).cast("date")).alias("span"),
        D.era(y).alias("era"),
        D.ceiling(y).alias("ceiling"),
    )


@query("f27_label_years", """SELECT n_nationkey, label, CAST(y AS INTEGER) AS y, kind FROM nation JOIN (VALUES (0, '1900-01', 1901, 'biennium'), (1, '1863-64', 1863, 'biennium'), (2, '1927-vol1-26chapters', 1926, 'regular'), (3, '1907', 1907, 'regular'), (4, '1911-extra', 1911, 'extra'), (5, 'unknown', NULL, 'regular')) v(k, label, y, kind) ON k = n_nationkey""")
def f27_label_years(spark, sf):
    labels = ["1900-01", "1863-64", "1927-vol1-26chapters", "1907", "1911-extra", "unknown"]
    n = table(spark, sf, "nation").filter(F.col("n_nationkey") < len(labels)).select("n_nationkey", F.get(F.array(*map(F.lit, labels)), F.col("n_nationkey")).alias("label"))
    return n.select("n_nationkey", "label", D.label_year(F.col("label")).alias("y"), D.session_kind(F.col("label")).alias("kind"))


@query("f30_ordinals", """SELECT n_nationkey, phrase, CAST(n AS INTEGER) AS n FROM nation JOIN (VALUES (0, 'First', 1), (1, 'twenty-third', 23), (2, 'Fortieth', 40), (3, 'thirty ninth', 39), (4, 'nineteenth', 19), (5, 'ninety-ninth', 99), (6, 'zeroth', NULL), (7, 'twenty-tenth', NULL)) v(k, phrase, n) ON k = n_nationkey""")
def f30_ordinals(spark, sf):
    words = ["First", "twenty-third", "Fortieth", "thirty ninth", "nineteenth", "ninety-ninth", "zeroth", "twenty-tenth"]
    n = table(spark, sf, "nation").filter(F.col("n_nationkey") < len(words)).select("n_nationkey", F.get(F.array(*map(F.lit, words)), F.col("n_nationkey")).alias("phrase"))
    return n.withColumn("n", D.ordinal_number(F.col("phrase")))


@query("f52_ratings", """SELECT conv_id, turn, CASE WHEN length(text) % 4 = 0 THEN 'clean' WHEN length(text) % 4 = 1 THEN 'noisy_but_coherent' WHEN length(text) % 4 = 2 THEN 'garbage' ELSE 'unknown' END AS rating FROM conversations""")
def f52_ratings(spark, sf):
    k = F.length("text") % 4
    raw = F.when(k == 0, " Clean ").when(k == 1, "I'd say noisy, not clean").when(k == 2, "mostly GARBAGE").otherwise("?")
    return table(spark, sf, "conversations").select("conv_id", "turn", X.rating(raw).alias("rating"))


@query("s10_links", r"""SELECT page_id, url, nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1), '') AS page, url LIKE '%?%' AS has_query FROM pages""")
def s10_links(spark, sf):
    url = F.col("url")
    coded = X.parse_link(F.replace(url, F.lit("page="), F.lit("lawCode%3D")))
    return table(spark, sf, "pages").select("page_id", "url", coded["code"].alias("page"), url.contains("?").alias("has_query"))


# --- vocabularies -----------------------------------------------------------------------------------------


@query("a03_vocab", f"WITH {VOCAB} SELECT tok, freq, doc_freq, example FROM vocab")
def a03_vocab(spark, sf):
    return T.vocabulary(docs(spark, sf))


@query("c13_vocab_diff", f"WITH {VOCAB}, b AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS tok FROM benchmark) SELECT tok, freq, doc_freq, example FROM vocab WHERE tok NOT IN (SELECT tok FROM b) AND doc_freq >= 2")
def c13_vocab_diff(spark, sf):
    b = table(spark, sf, "benchmark").select(F.explode(X.words(F.col("text"))).alias("tok"))
    return T.vocabulary(docs(spark, sf)).join(b, "tok", "left_anti").filter("doc_freq >= 2")


@query("a21_frequency_tiers", f"WITH {VOCAB} SELECT CASE WHEN freq = 1 THEN 'singleton' WHEN freq < 10 THEN '2-9' ELSE '10+' END AS tier, count(*) AS types, CAST(sum(freq) AS BIGINT) AS occurrences FROM vocab GROUP BY 1")
def a21_frequency_tiers(spark, sf):
    tier = F.when(F.col("freq") == 1, "singleton").when(F.col("freq") < 10, "2-9").otherwise("10+")
    return T.vocabulary(docs(spark, sf)).groupBy(tier.alias("tier")).agg(F.count("*").alias("types"), F.sum("freq").alias("occurrences"))


@query("j14_known_flag", f"WITH {VOCAB} SELECT doc_id, count(*) AS n, count(k.tok) AS known FROM stream s LEFT JOIN known k ON k.tok = s.tok GROUP BY doc_id")
def j14_known_flag(spark, sf):
    v, known = vocab_known(spark, sf)
    flagged = T.join_words(stream(spark, sf), known.select("tok", F.lit(1).alias("k")), v, "left")
    return flagged.groupBy("doc_id").agg(F.count("*").alias("n"), F.count("k").alias("known"))


#: Pairs of words that have a form with one letter taken out in common.
_EDIT = """del_(tok, key) AS (SELECT DISTINCT tok, unnest(list_concat([tok], [left(tok, CAST(i AS INT) - 1) || substr(tok, CAST(i AS INT) + 1) FOR i IN range(1, length(tok) + 1)])) FROM {words}),
kdel(tok, key) AS (SELECT DISTINCT tok, unnest(list_concat([tok], [left(tok, CAST(i AS INT) - 1) || substr(tok, CAST(i AS INT) + 1) FOR i IN range(1, length(tok) + 1)])) FROM known WHERE regexp_matches(tok, '^[a-z]+$')),
e1 AS (SELECT DISTINCT d.tok, k.tok AS candidate FROM del_ d JOIN kdel k USING (key) WHERE d.tok <> k.tok AND abs(length(d.tok) - length(k.tok)) <= 1 AND damerau_levenshtein(d.tok, k.tok) = 1),
edit1 AS (SELECT e1.tok, candidate, freq FROM e1 JOIN known ON known.tok = candidate)"""
_RARE_EDIT = f"{RARE}, az AS (SELECT tok FROM rare WHERE regexp_matches(tok, '^[a-z]+$')), {_EDIT.format(words='az')}"


def az(words):
    return words.filter(F.col("tok").rlike("^[a-z]+$"))


@query("j15_within_one_edit", f"WITH {_RARE_EDIT} SELECT tok, candidate, freq FROM edit1")
def j15_within_one_edit(spark, sf):
    v, known = vocab_known(spark, sf)
    return T.within_one_edit(az(rare(v)), az(known))


@query("j15_within_two_edits")
def j15_within_two_edits(spark, sf):
    """Tested against brute force: DuckDB's distance lets a place be edited twice."""
    v, known = vocab_known(spark, sf)
    return T.symmetric_lookup(az(rare(v)), az(known))


@query("f01_edit_neighbours", """WITH w AS (SELECT DISTINCT lower(n_name) AS tok FROM nation WHERE regexp_matches(n_name, '^[A-Za-z]+$')), l AS (SELECT unnest(string_split('a b c d e f g h i j k l m n o p q r s t u v w x y z', ' ')) AS c), i AS (SELECT tok, CAST(unnest(range(0, length(tok) + 1)) AS INT) AS i FROM w),
n AS (SELECT tok, left(tok, i) || substr(tok, i + 2) AS candidate FROM i WHERE i < length(tok) UNION SELECT tok, left(tok, i) || substr(tok, i + 2, 1) || substr(tok, i + 1, 1) || substr(tok, i + 3) FROM i WHERE i < length(tok) - 1
UNION SELECT tok, left(tok, i) || c || substr(tok, i + 2) FROM i, l WHERE i < length(tok) UNION SELECT tok, left(tok, i) || c || substr(tok, i + 1) FROM i, l) SELECT * FROM n WHERE candidate <> tok""")
def f01_edit_neighbours(spark, sf):
    return T.edit_neighbours(az(table(spark, sf, "nation").select(F.lower("n_name").alias("tok")).distinct()))


@query("f40_best_correction", f"WITH {_RARE_EDIT}, z AS (SELECT tok, candidate, log10(freq * (1e9 / (SELECT sum(freq) FROM vocab))) AS z FROM edit1), r AS (SELECT *, row_number() OVER w AS k, coalesce(lead(z) OVER w, 0) AS nxt FROM z WINDOW w AS (PARTITION BY tok ORDER BY z DESC, candidate)) SELECT tok, candidate AS fix FROM r WHERE k = 1 AND z >= 3.3 AND z - nxt >= 0.5")
def f40_best_correction(spark, sf):
    v, known = vocab_known(spark, sf)
    return T.best_correction(az(rare(v)), az(known), v.agg(F.sum("freq")).first()[0])


_SPLITS = f"""{RARE}, cut AS (SELECT tok, CAST(i AS INT) AS at_, left(tok, CAST(i AS INT)) AS l, substr(tok, CAST(i AS INT) + 1) AS r FROM rare, range(3, 40) t(i) WHERE i <= length(tok) - 3),
both_ AS (SELECT c.*, least(a.freq, b.freq) AS least_ FROM cut c JOIN known a ON a.tok = c.l JOIN known b ON b.tok = c.r)"""


@query("f35_best_split", f'WITH {_SPLITS} SELECT tok, l AS "left", r AS "right" FROM both_ WHERE length(l) >= 4 AND length(r) >= 4 QUALIFY row_number() OVER (PARTITION BY tok ORDER BY least_ DESC, at_) = 1')
def f35_best_split(spark, sf):
    v, known = vocab_known(spark, sf)
    return T.best_split(rare(v), known)


@query("f36_only_split", f"""WITH {RARE}, fit AS (SELECT tok, tok IN {T.STOPWORDS} AS stop FROM known WHERE length(tok) >= 4 OR tok IN {T.STOPWORDS}), w AS (SELECT tok, CAST(unnest(range(2, length(tok) - 1)) AS INT) AS i FROM rare WHERE length(tok) >= 4),
two AS (SELECT w.tok, i, a.tok AS l, b.tok AS r, a.stop OR b.stop AS stop FROM w JOIN fit a ON a.tok = left(w.tok, i) JOIN fit b ON b.tok = substr(w.tok, i + 1)),
c AS (SELECT tok, count(*) AS n, count(*) FILTER (stop) AS s, arg_min(l || ' ' || r, CASE WHEN stop THEN 0 ELSE 1000 END + i) AS pieces FROM two GROUP BY tok),
h AS (SELECT w.tok, i, a.tok AS l, substr(w.tok, i + 1) AS rest FROM w JOIN fit a ON a.tok = left(w.tok, i) WHERE length(w.tok) >= 8 AND w.tok NOT IN (SELECT tok FROM c)),
g AS (SELECT *, CAST(unnest(range(2, length(rest) - 1)) AS INT) AS j FROM h WHERE length(rest) >= 4),
three AS (SELECT g.tok, i, j, l || ' ' || m.tok || ' ' || z.tok AS pieces FROM g JOIN fit m ON m.tok = left(rest, j) JOIN fit z ON z.tok = substr(rest, j + 1))
SELECT tok, pieces FROM c WHERE n = 1 OR s = 1 UNION ALL SELECT tok, arg_min(pieces, i * 1000 + j) FROM three GROUP BY tok""")
def f36_only_split(spark, sf):
    v, known = vocab_known(spark, sf)
    return T.only_split(rare(v), known).select("tok", F.array_join("pieces", " ").alias("pieces"))


@query("f37_decompositions", f"""WITH RECURSIVE {RARE}, w AS (SELECT tok FROM rare WHERE length(tok) >= 12),
g AS (SELECT tok, 1 AS at_, CAST('' AS VARCHAR) AS pieces, 0 AS n FROM w UNION ALL
  SELECT g.tok, at_ + length(p.piece), g.pieces || CASE WHEN n = 0 THEN '' ELSE ' ' END || p.piece, n + 1 FROM g, LATERAL (SELECT k.tok AS piece FROM known k WHERE length(k.tok) BETWEEN 3 AND 15 AND substr(g.tok, g.at_, length(k.tok)) = k.tok ORDER BY length(k.tok) DESC LIMIT 1) p WHERE at_ <= length(g.tok))
SELECT tok, pieces FROM g WHERE at_ = length(tok) + 1 AND n >= 2""")
def f37_decompositions(spark, sf):
    v, known = vocab_known(spark, sf)
    return T.decompositions(rare(v).filter("length(tok) >= 12"), known).select("tok", F.array_join("pieces", " ").alias("pieces"))


_TWICE = "tok"
for _c in T.ALPHABET:
    _TWICE = f"regexp_replace({_TWICE}, '{_c}{{3,}}', '{_c}{_c}', 'g')"


@query("f31_garbage_rules", f"""WITH {VOCAB}, u AS (SELECT tok FROM vocab WHERE doc_freq < 25), o AS (SELECT tok, length(regexp_replace(tok, '[\\x00-\\x7F]', '', 'g')) AS odd, regexp_matches(tok, '[bcdfghjklmnpqrstvwxz]{{5,}}') AS clump, NOT regexp_matches(tok, '[aeiouy]') AND length(tok) >= 5 AS bare,
list_max([len(x) FOR x IN regexp_extract_all(tok, '{"|".join(c + "{3,}" for c in T.ALPHABET)}')]) AS run FROM u),
az AS (SELECT tok FROM o WHERE run >= 3), {_EDIT.format(words='az').replace("WHERE regexp_matches(tok, '^[a-z]+$')", "")}, saved AS (SELECT tok FROM az WHERE {_TWICE} IN (SELECT tok FROM known) UNION SELECT tok FROM edit1)
SELECT rule, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(tok, '^[ivxlcdm]{{2,}}$') THEN 'roman' WHEN odd > 1 OR odd = 1 AND length(tok) > 16 THEN 'garbage_mojibake' WHEN odd = 1 THEN 'recoverable' WHEN run >= 4 THEN 'garbage_repeat4' WHEN run >= 3 THEN CASE WHEN (clump OR bare) AND tok NOT IN (SELECT tok FROM saved) THEN 'garbage_repeat3' ELSE 'recoverable' END
WHEN clump THEN 'garbage_cons5' WHEN bare THEN 'garbage_novowel' WHEN length(tok) >= 25 THEN 'garbage_toolong' ELSE 'recoverable' END AS rule FROM o) GROUP BY rule""")
def f31_garbage_rules(spark, sf):
    v, known = vocab_known(spark, sf)
    return T.residual_classes(v.filter("doc_freq < 25"), known).groupBy("rule").agg(F.count("*").alias("n"))


@query("f33_shapes", f"WITH {VOCAB} SELECT tok, round(length(regexp_replace(tok, '[^aeiou]', '', 'g')) / length(tok), 6) AS vowels, CAST(list_max([len(x) FOR x IN regexp_extract_all(tok, '{'|'.join(c + '+' for c in T.ALPHABET)}')]) AS INTEGER) AS run FROM known WHERE regexp_matches(tok, '^[a-z]+$')")
def f33_shapes(spark, sf):
    _, known = vocab_known(spark, sf)
    return known.filter(F.col("tok").rlike("^[a-z]+$")).select("tok", F.round(X.vowel_ratio(F.col("tok")), 6).alias("vowels"), X.longest_run(F.col("tok")).alias("run"))


@query("f34_fragments", f"""WITH {RARE}, k AS (SELECT tok, CAST(unnest(range(3, length(tok) - 1)) AS INT) AS k FROM known WHERE length(tok) >= 5), heads AS (SELECT DISTINCT left(tok, k) AS part FROM k), tails AS (SELECT DISTINCT right(tok, k) AS part FROM k)
SELECT tok, h.part IS NOT NULL AS is_head, t.part IS NOT NULL AS is_tail FROM rare LEFT JOIN heads h ON h.part = tok LEFT JOIN tails t ON t.part = tok""")
def f34_fragments(spark, sf):
    v, known = vocab_known(spark, sf)
    return T.fragments(rare(v), known)


@query("f38_mojibake", f"""WITH {VOCAB}, one AS (SELECT tok, regexp_extract(tok, '^([a-z]*)', 1) AS pre, regexp_extract(tok, '([a-z]*)$', 1) AS post FROM vocab WHERE doc_freq < 25 AND regexp_matches(tok, '^[a-z]*[^a-z]{{1,2}}[a-z]*$') AND length(regexp_replace(tok, '[\\x00-\\x7F]', '', 'g')) BETWEEN 1 AND 2),
hit AS (SELECT o.tok, k.tok AS candidate, k.freq, CASE WHEN length(k.tok) - length(pre) - length(post) <= 1 THEN 1 ELSE 2 END AS tier FROM one o JOIN known k ON length(k.tok) - length(pre) - length(post) BETWEEN 0 AND 2 AND starts_with(k.tok, pre) AND ends_with(k.tok, post) AND regexp_matches(k.tok, '^[a-z]+$')),
b AS (SELECT * FROM hit QUALIFY tier = min(tier) OVER (PARTITION BY tok)), r AS (SELECT *, row_number() OVER w AS k, lead(freq) OVER w AS nxt FROM b WINDOW w AS (PARTITION BY tok ORDER BY freq DESC, candidate))
SELECT tok, candidate AS fix FROM r WHERE k = 1 AND (nxt IS NULL OR freq >= 4 * nxt)""")
def f38_mojibake(spark, sf):
    v, known = vocab_known(spark, sf)
    return T.mojibake_fixes(v.filter("doc_freq < 25"), known)


@query("f40_dominant", f"WITH {_RARE_EDIT}, ranked AS (SELECT *, row_number() OVER w AS k, lead(freq) OVER w AS nxt FROM edit1 WINDOW w AS (PARTITION BY tok ORDER BY freq DESC, candidate)) SELECT tok, candidate AS fix FROM ranked WHERE k = 1 AND freq >= 50 AND (nxt IS NULL OR freq >= 3 * nxt)")
def f40_dominant(spark, sf):
    v, known = vocab_known(spark, sf)
    return T.dominant(T.within_one_edit(az(rare(v)), az(known)), 3.0, 50)


_NEIGHBOURS = """nb AS (SELECT doc_id, line_no, tok_no, tok, lag(tok) OVER w AS prev, lead(tok) OVER w AS next FROM stream WINDOW w AS (PARTITION BY doc_id, line_no ORDER BY tok_no)),
bg AS (SELECT tok AS prev, next, count(*) AS n FROM nb WHERE tok IN (SELECT tok FROM known) AND next IN (SELECT tok FROM known) GROUP BY ALL)"""


@query("w35_bigrams", f"WITH {VOCAB}, {_NEIGHBOURS} SELECT * FROM bg")
def w35_bigrams(spark, sf):
    _, known = vocab_known(spark, sf)
    return T.bigrams(docs(spark, sf), known)


@query("w36_context_window", f"""WITH {STREAM} SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(tok_no AS INTEGER) AS tok_no, string_agg(tok, ' ') OVER (PARTITION BY doc_id, line_no ORDER BY tok_no ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) AS context FROM stream""")
def w36_context_window(spark, sf):
    return T.context_windows(docs(spark, sf))


@query("f41_context", f"""WITH {_RARE_EDIT}, {_NEIGHBOURS},
s AS (SELECT nb.tok AS place, candidate, ln(1 + coalesce(a.n, 0)) + ln(1 + coalesce(b.n, 0)) AS score FROM nb JOIN edit1 c ON c.tok = nb.tok LEFT JOIN bg a ON a.prev = nb.prev AND a.next = candidate LEFT JOIN bg b ON b.prev = candidate AND b.next = nb.next),
r AS (SELECT *, row_number() OVER w AS k, coalesce(lead(score) OVER w, 0) AS second FROM s WINDOW w AS (PARTITION BY place ORDER BY score DESC, candidate))
SELECT place, CASE WHEN score > 0 AND score - second >= 1.0 THEN candidate END AS pick, CASE WHEN score = 0 THEN 'no_ctx' WHEN score - second >= 1.0 THEN 'resolved' ELSE 'tie' END AS status FROM r WHERE k = 1""")
def f41_context(spark, sf):
    """Words seen once, so a word is its place."""
    v, known = vocab_known(spark, sf)
    words = stored(az(rare(v)), "rare")
    c = T.within_one_edit(words, az(known))
    at = T.single_places(docs(spark, sf), az(v.filter("freq = 1")))
    return T.context_choice(at.select(F.col("tok").alias("place"), "tok", "prev", "next"), c, stored(T.bigrams(docs(spark, sf), known), "bigrams"), "place")


def broken(spark, sf, by):
    """The documents with words of six letters or more broken after the third."""
    return table(spark, sf, "documents").select("doc_id", F.regexp_replace("text", r"(\p{L}{3})(\p{L}{3,})", f"$1{by}$2").alias("text"))


_BROKEN = r"regexp_replace(text, '(\p{L}{3})(\p{L}{3,})', '\1' || chr(10) || '\2', 'g')"


@query("c02a_rejoined")
def c02a_rejoined(spark, sf):
    v, known = vocab_known(spark, sf)
    return T.rejoined(T.token_lines(broken(spark, sf, " ")), known, v)


@query("c02b_over_line_ends", f"""WITH {VOCAB}, {STREAM.replace('lines', 'lines2').replace('stream', 'stream2').replace('string_split(text,', "string_split(" + _BROKEN + ",")},
e AS (SELECT doc_id, line_no, max_by(tok, tok_no) AS head, min_by(tok, tok_no) AS first FROM stream2 GROUP BY ALL), p AS (SELECT *, lead(first) OVER w AS tail, lead(line_no) OVER w AS at_ FROM e WINDOW w AS (PARTITION BY doc_id ORDER BY line_no))
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, head, tail, head || tail AS joined FROM p WHERE at_ - line_no <= 6 AND length(head) >= 3 AND head NOT IN (SELECT tok FROM known) AND head || tail IN (SELECT tok FROM known)""")
def c02b_over_line_ends(spark, sf):
    v, known = vocab_known(spark, sf)
    return T.over_line_ends(broken(spark, sf, "\n"), known, v)


@query("f32_triage")
def f32_triage(spark, sf):
    v, known = vocab_known(spark, sf)
    return T.triage(rare(v), known)
