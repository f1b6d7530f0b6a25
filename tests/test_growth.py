"""Steps whose cost once grew faster than the input, on small tables."""

from foliant.operators import lineage
from foliant.operators import tokens as T


def test_line_ends_meet_within_their_own_text(spark):
    """Two texts with the same id don't mix, and no line is shuffled to find the next one."""
    docs = spark.createDataFrame([(1, "the sta\n-\ntute of"), (1, "x\nother"), (2, None), (3, "sta\n\n\n\n\n\n\ntute"), (4, "Sta — \n “tute”")], "doc_id long, text string")
    known = spark.createDataFrame([("statute", 30)], "tok string, freq long")
    vocab = spark.createDataFrame([("statute", 30)], "tok string, freq long")
    found = T.over_line_ends(docs, known, vocab)
    assert sorted(map(tuple, found.collect())) == [(1, 0, "sta", "tute", "statute"), (4, 0, "sta", "tute", "statute")]
    assert "Exchange" not in T._line_ends(docs, "doc_id", "text", 6)._jdf.queryExecution().executedPlan().toString()


def test_single_words_are_looked_for_in_their_own_text(spark):
    docs = spark.createDataFrame([(1, "one two\nthree — four"), (None, "Five"), (1, "six seven"), (2, None)], "doc_id long, text string")
    singles = spark.createDataFrame([("two", 1), ("four", 1), ("five", None), ("six", 1)], "tok string, example long")
    rows = sorted(map(tuple, T.single_places(docs, singles).collect()), key=repr)
    assert rows == [(1, "four", "three", None), (1, "six", None, "seven"), (1, "two", "one", None), (None, "five", None, None)]


def test_pairs_of_known_words_with_and_without_a_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b a b c\nb a"), (2, "a b")], "doc_id long, text string")
    known = spark.createDataFrame([("a", 30), ("b", 30)], "tok string, freq long")
    want = [("a", "b", 3), ("b", "a", 2)]
    assert sorted(map(tuple, T.bigrams(docs, known).collect())) == want
    assert "BroadcastHashJoin" in T.bigrams(docs, known)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(T, "BROADCAST_WORDS", 1)
    assert sorted(map(tuple, T.bigrams(docs, known).collect())) == want


def test_no_pair_over_a_line_end_in_a_batch_without_blanks(spark):
    docs = spark.createDataFrame([(1, "a b\nc d")], "doc_id long, text string")
    assert sorted(map(tuple, T.pair_counts(docs).collect())) == [("a", "b", 1), ("c", "d", 1)]


def test_both_ways_by_one_walk_as_by_two(spark):
    """Branches, a diamond, two edges between the same nodes and a cycle; rows are shuffled once for each start."""
    from pyspark.sql import functions as F

    pairs = [(1, 2), (1, 3), (2, 4), (3, 4), (3, 4), (4, 5), (5, 6), (6, 4), (6, 7), (4, None)]
    edges = spark.createDataFrame([(k, a, b, "xy"[k % 2]) for k, (a, b) in enumerate(pairs)], "edge_id long, from_id long, to_id long, edge_type string")
    start = spark.createDataFrame([(k,) for k in [*range(1, 9), None]], "id long")
    one, two = lineage.both_ways(edges, start, every=True), lineage.both_ways(edges, start)
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(start")
    assert shuffles(one) == 1 and shuffles(one.groupBy("start").agg(F.count("*"))) == 1
    assert one.columns == two.columns and one.dtypes == two.dtypes
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(one) == rows(two) and len(rows(one)) > 60


def test_windows_stay_in_their_line(spark, monkeypatch):
    monkeypatch.setattr(T, "WINDOWS", 2)
    docs = spark.createDataFrame([(1, "\na b c\n\nd"), (2, None), (1, "e f"), (3, "\n")], "doc_id long, text string").coalesce(1)
    want = [(1, 0, 0, "e f"), (1, 0, 1, "e f"), (1, 1, 0, "a b"), (1, 1, 1, "a b c"), (1, 1, 2, "b c"), (1, 3, 0, "d")]
    assert sorted(map(tuple, T.context_windows(docs, 1).collect())) == want


def test_pages_of_a_language_are_not_sent_to_one_task(spark):
    from conftest import DATA

    from foliant.queries import QUERIES

    plan = QUERIES["s01_s02_page_json"](spark, f"{DATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(label" not in plan.split("BroadcastExchange")[0]


def test_numbers_are_dealt_out_once(spark):
    from conftest import DATA

    from foliant.queries import QUERIES

    plan = QUERIES["c17_key_triage"](spark, f"{DATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_pages_are_made_in_batches_as_by_patterns(spark):
    """As Python's patterns find words and hyphens, line by line; no function is applied row by row for it."""
    import re

    from foliant.operators import cascade as C

    texts = ["Legis-\nlature—x\n\n12\nAB- \t\r\nof", None, "", "\n", "x-\nabK-\nŸab-\nÉtÉ-\nab- \na-b -\nİab-", "-\nABẞ-\n中文-", "A\rb-\rc-\r"]
    letters = "[^\\W\\d_]+"
    want = []
    for t in texts:
        lines = [(re.findall(letters, x.lower()), re.search("([A-Za-zÀ-ÿ]{2,})-[ \\t\\r]*[\x85  ]?$", x)) for x in (t or "").split("\n")]
        want.append(([a for a, _ in lines if a], [h and h[1].lower() for a, h in lines if a]))
    df = C.pages_of(spark.createDataFrame([(1, k, t) for k, t in enumerate(texts)], "volume long, page long, text string"), "volume", "page")
    assert [(r.lines, r.hyphens) for r in df.orderBy("page").collect()] == want
    assert "regexp_extract_all" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_put_together_by_places_not_by_look_up(spark):
    """Places beyond a page's words are let pass; the first place of an edit takes the whole word, the others go."""
    from foliant.operators import cascade as C

    pages = spark.createDataFrame([(1, 1, ["a"], [[("sta", 1), ("tute", 1), ("of", 0)], [("x", 1)]]), (1, 2, [None], [])], "volume long, page long, hyphens array<string>, lines array<array<struct<tok:string,m:int>>>")
    edits = [(1, 1, [0, 1], "statute"), (1, 1, [C.LINE], ""), (1, 1, [C.LINE * 5, 2], "beyond"), (1, 2, [0, 1], "none")]
    out = C._put_together(pages, spark.createDataFrame(edits, "volume long, page long, places array<long>, after string"))
    assert [r.lines for r in out.orderBy("page").collect()] == [[[("statute", 0)], []], []]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "map_from_entries" not in plan and "try_element_at" not in plan


def test_words_of_one_id_and_shares_by_pages(spark):
    """Repeated ids, null ones and null texts; a page's words are not shuffled."""
    from foliant.operators import headings as H

    docs = spark.createDataFrame([(1, "one two\nboth"), (1, "one three"), (2, "both four four"), (None, "two five"), (3, None), (4, "—")], "doc_id long, text string")
    rows = sorted(map(tuple, T.words_of_one(docs).collect()))
    assert rows == [("four", 2, 2), ("one", 1, 2), ("three", 1, 1), ("two", 1, 1)]
    pages = spark.createDataFrame([(1, ["a", "b", "a"]), (1, ["c"]), (2, ["b"]), (3, []), (4, None)], "doc_id long, toks array<string>")
    a, ab = (spark.createDataFrame([(w,) for w in x], "tok string") for x in ("a", "ab"))
    got = H.shares(pages, "doc_id", "toks", docs, {"own": spark.createDataFrame([(2, 1)], "doc_id long, n long")}, first=a, both=ab)
    assert sorted(map(tuple, got.collect())) == [(1, 0.5, 0.75, 0.0), (2, 0.0, 1.0, 1.0)]
    assert "tok" not in "".join(x for x in got._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in x)


def test_index_counts_as_by_patterns(spark):
    """As the row by row functions have it; words are counted before they are taken apart."""
    from pyspark.sql import functions as F

    from foliant.functions import alignment as A
    from foliant.functions import text as X

    texts = ["Well-to-do x-y a--b -cd- É-é éé", None, "", "a×b÷c ×÷ —ok no\x85yes \x01two\x7fthree", "Kab ÅŸ İstanbul ẞa-ßb ŒUVRE œuvre", "中文ab Σας ab1cd", "same same Same-same"]
    docs = spark.createDataFrame([(k // 2, t) for k, t in enumerate(texts)], "doc_id long, text string")
    want = docs.select("doc_id", F.explode(X.index_tokens(A.composed(F.col("text")))).alias("tok")).groupBy("doc_id", "tok").agg(F.count("*").alias("n"))
    got = T.index_counts(docs)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 25
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()


def test_a_batch_is_counted_in_slices_of_a_megabyte():
    """A worker holds what one slice takes, some twenty times its bytes, however many rows a batch has."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array(["some words of a text " * 160] * 4000)], names=["doc_id", "text"])
    slices = list(T._sliced(batch))
    assert max(b.nbytes for b in slices) <= 1 << 20
    assert pa.Table.from_batches(slices).column("doc_id").to_pylist() == list(range(4000))
