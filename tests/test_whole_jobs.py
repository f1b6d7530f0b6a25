"""Queries on small tables of their own: whole jobs, and rows that the test tables lack."""

from compare import differences
from pyspark.sql import functions as F

from foliant.queries import ORACLES, QUERIES


def written(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).toPandas().to_parquet(f"{folder}/{name}.parquet")
    return str(folder)


def agrees(spark, name, folder):
    return differences(QUERIES[name](spark, folder), ORACLES[name], folder)


def test_distances_of_all_pairs(spark, tmp_path):
    rows = [(k, "abc" * (k % 4) + "é" * (k % 3)) for k in (1, 2, 3, 9, 40, 41, 77, 77, 100)] + [(5, None)]
    folder = written(spark, tmp_path, benchmark=(rows, "item_id long, text string"))
    got = QUERIES["f04_levenshtein"](spark, folder)
    assert got.count() == 10 * 9 // 2 - 1
    assert agrees(spark, "f04_levenshtein", folder) == ""


def test_spans_with_damage_at_their_end(spark, tmp_path):
    """Texts of 37 characters or twice that: the last strange character stands just before the text's end marks."""
    rows = [(k, ("the quick brown fox jumps over a dog, " * 4)[:n]) for k, n in enumerate((36, 37, 38, 74, 75, 111))]
    folder = written(spark, tmp_path, benchmark=(rows, "item_id long, text string"))
    assert agrees(spark, "f07_best_span", folder) == ""


def test_no_third_piece_of_one_letter(spark, tmp_path):
    rows = [(k, "something is a") for k in range(25)] + [(99, "somethingisa somethingisis")]
    folder = written(spark, tmp_path, documents=(rows, "doc_id long, text string"))
    assert [tuple(r) for r in QUERIES["f36_only_split"](spark, folder).collect()] == [("somethingisis", "something is is")]
    assert agrees(spark, "f36_only_split", folder) == ""


def test_garbage_by_shape_alone_is_not_recoverable(spark, tmp_path):
    """A letter three times in a row among five consonants, though a known word is one edit away."""
    rows = [(k, "abstttract") for k in range(1)] + [(k, "absttract") for k in range(1, 26)] + [(99, "plain")]
    folder = written(spark, tmp_path, documents=(rows, "doc_id long, text string"), nation=([("plain",)], "n_name string"))
    assert agrees(spark, "c15_recoverable", folder) == ""


def test_odd_letters_between_known_ends(spark, tmp_path):
    """One or two odd characters at a word's beginning, middle and end; repeated letters, for which a gap may lie anywhere."""
    known = ["balloon", "bal", "ba", "b", "oon", "book", "bok"]
    rows = [(k, " ".join(known)) for k in range(25)] + [(99, "b balloon balloon ballñon ñalloon ballooñ bañ ñb ñ ñü balñüoon boñk ñüoon xñy")]
    folder = written(spark, tmp_path, documents=(rows, "doc_id long, text string"))
    assert QUERIES["f38_mojibake"](spark, folder).count() > 3
    assert agrees(spark, "f38_mojibake", folder) == ""


def planned(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def test_dates_are_searched_once(spark):
    from foliant.functions import acts as A

    text = spark.createDataFrame([("Passed May 1st, 1860. Approved June 3, 1999.", 1999)], "t string, y int")
    found = text.select(A.act_date(F.col("t"), F.col("y")).alias("f"))
    assert planned(found.select("f.date", "f.rejected"))[0].count("regexp_extract_all(") == 2
    assert [tuple(r) for r in found.select(F.col("f.date").cast("string"), "f.rejected").collect()] == [("1999-06-03", [1860])]


def test_forms_and_pages_are_not_broadcast(spark, tmp_path):
    """Tables in small files, which Spark would broadcast."""
    from foliant.operators import acts, headings, relational
    from foliant.operators import tokens as T

    tables = {
        "words": ([("word", 3), ("ward", 4)], "tok string, freq long"),
        "places": ([("word", "a", "b")], "tok string, prev string, next string"),
        "pages": ([(1, 1, "CHAPTER I.\nAn Act.")], "volume int, page int, text string"),
        "spans": ([(1, 1, 2)], "k int, a int, b int"),
    }
    folder = written(spark, tmp_path, **tables)
    words, places, pages, spans = (spark.read.parquet(f"{folder}/{t}.parquet") for t in tables)
    for df in (
        T.within_two_edits(words, words),
        T.fragments(words, words),
        relational.pages_in_spans(spans, spans.select("k", F.col("a").alias("page")), "k", "a", "b", "page"),
    ):
        assert "BroadcastHashJoin" not in planned(df)[1]
    counts = [planned(df)[1].count("BroadcastHashJoin") for df in (acts.bodies(pages), headings.singleton_classes(places, words))]
    assert counts[0] <= 1 and counts[1] <= 5, counts  # of known words


def test_each_search_of_an_act_is_computed_once(spark):
    """An expression that is named twice in an array's function is computed twice, and its cost is the query's."""
    from foliant.functions import dates, pages

    damage = str(dates.date_damage(F.col("text"), F.col("approved"), F.col("year")))
    assert [damage.count(x) for x in ("Pussed", "atory", "January", "{0,120}")] == [1, 1, 1, 2]
    months = "January February March April May June July August September October November December jan FEB mar apr jun jul aug sept sep oct nov dec".split()
    rows = [(f"so. {m} 45, and", "day:45") for m in months] + [(f"{w} May 3, 1950.", "text_year:1950") for w in ("Approved", "APPROVED", "Filed with Secr", "Passed", "pussed", "APry")]
    rows += [("Approved May 3, 1950; amended in 1950", None), ("Approved May 3, 18912.", "five_digits:18912"), ("Filed with Secretary 189*", "year_symbol:189*"), ("Statutes of 1950. Passed 1950", None), ("", None)]
    got = spark.createDataFrame(rows, "text string, want string").select("want", dates.date_damage(F.col("text"), F.lit("May 3, 1890"), F.lit(1890)).alias("got")).collect()
    assert [r.got for r in got] == [[] if r.want is None else [r.want] for r in got]
    words = ["Approwees", "Appioved", "appiaved", "LAppix", "Apyi", "JApproved", "Approyed", "Fuled with Secretary", "Wiled  with Secretary", "Puled with Secretary", "fy governor", "Secreiary", "Secrelary"]
    found = spark.createDataFrame([(w,) for w in words], "t string").select(pages.misread_keywords(F.col("t")).alias("k")).collect()
    assert all(r.k == ["approval"] for r in found)
    assert spark.createDataFrame([("12x4 1st ab12 a1b abc 12345678901x2 x12345678l0 l23o",)], "t string").select(pages.damaged_numbers(F.col("t")).alias("n")).first().n == 3
