"""Words looked up and compared for a batch at once: hashes, flat pages, edits; what no shuffle may hold."""

import itertools
import pickle
import random

import numpy as np
import pyarrow as pa
import pytest
from test_cascade import WORDS, distance

from foliant.operators import cascade as C
from foliant.operators import edits as E
from foliant.operators import tokens as T
from foliant.operators.lookup import Held


def planned(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def shuffled(df):
    """The lines of the plan that deal rows out by their columns."""
    return [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in x]


def test_words_are_found_by_their_hash_and_text():
    words = ["ab", "abc", "é", "legislature", "x", "legis", "lature", ""]
    table = pickle.loads(pickle.dumps(Held(pa.table({"tok": words, "n": range(8)}))))
    asked = pa.array(["-", "x", "zz", "legislature", "é", "", "abc"]).slice(1)
    at = table.find(asked)
    assert [None if k < 0 else table.columns["n"][k].as_py() for k in at] == [4, None, 3, 2, 7, 1]
    hashed, size = table.hashes.of(pa.array(["legis", "lature"]))
    assert table.at(table.hashes.joined(hashed[:1], size[:1], hashed[1:])).tolist() == table.find(pa.array(["legislature"])).tolist()
    # the hash alone doesn't make a word another one
    assert table.find(pa.array(["other"]), table.sorted[:1]).tolist() == [-1]
    assert Held(pa.table({"tok": pa.array([], pa.string())})).find(asked).tolist() == [-1] * 6
    with pytest.raises(ValueError, match="twice"):
        Held(pa.table({"tok": ["a", "a"]}))


def test_flat_pages_come_back_as_they_were():
    pages = ["a b \n c", None, "", "\n", "\n b \n  \n c c", "d"]
    w = C._read(pa.array(pages))
    assert C._written(w).to_pylist() == ["a b \n c", None, "", "\n", "\n b \n \n c c", "d"]
    assert w.place(np.arange(len(w.code))).tolist() == [0, 1, C.LINE, C.LINE, 3 * C.LINE, 3 * C.LINE + 1, 0]
    at = w.at(np.array([0, 0, 4, 4, 1, 2, 5]), np.array([C.LINE, 2, 3 * C.LINE + 1, C.LINE, 0, 0, C.LINE]), pa.array(["c", "c", "c", "x", "a", "a", "d"]))
    assert at.tolist() == [2, -1, 5, -1, -1, -1, -1]
    assert C._written(w.edited(np.array([0, 5]), pa.array(["ab", "cc"]), np.array([1, 3]))).to_pylist() == ["ab \n c", None, "", "\n", "\n \n \n c cc", "d"]


def test_edits_as_by_brute_force():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(0, 6)))
    a, b = ([word() for _ in range(3000)] + ["x" * 5000, "y"] for _ in range(2))
    form = lambda w, n: {k for _, keys in E.forms(pa.array([w]), n) for k in keys.tolist()}
    for most in (1, 2):
        want = [min(distance(x, y) if len(x) < 9 else 0, most + 1) for x, y in zip(a, b)]
        assert E.distances(pa.array(a), pa.array(b), most).tolist() == want
        assert all(form(x, most) & form(y, most) for x, y, d in itertools.islice(zip(a, b, want), 2000) if d <= most)


def test_pages_are_neither_shuffled_nor_changed_row_by_row(spark, monkeypatch):
    """Also with more known words than are broadcast to be joined."""
    monkeypatch.setattr(T, "BROADCAST_WORDS", 1)
    known = spark.createDataFrame(list(WORDS.items()), "tok string, freq long")
    words = C.Lexicon.of(known, known)
    texts = ["the legis lature of the state\nschooldistrict", "the rigbt of sup-\nervisors", None]
    pages = C.pages_of(spark.createDataFrame([(1, k, t) for k, t in enumerate(texts)], "volume long, page long, text string"), "volume", "page")
    assert not shuffled(C.measured(pages, words, "raw")) and C.measured(pages, words, "raw").first()[1:] == (6, 12)
    fixes = spark.createDataFrame([("schooldistrict", "school district")], "tok string, fix string")
    out, audit = C.replaced(pages, fixes, words, "split")
    assert [r.lines for r in out.orderBy("page").collect()][0] == [["the", "legis", "lature", "of", "the", "state"], ["school", "district"]] and audit.count() == 1
    places = C._word_places(pages, spark.createDataFrame([("rigbt",), ("ervisors",), ("none",)], "tok string"))
    assert sorted((tuple(r.place), *r[1:]) for r in places.collect()) == [((1, 1, 0, 1), "rigbt", "the", "of"), ((1, 1, 1, 0), "ervisors", "", "")]
    out, _ = C.reunify(pages, words)
    for df in (out.select("flat"), places, audit):
        assert not shuffled(df) and "Join" not in planned(df) and "lambda" not in planned(df)
    assert "levenshtein" not in planned(T.within_two_edits(known.select("tok"), known))


def test_pairs_of_many_known_words_are_looked_up_before_they_are_shuffled(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b x a\nb a"), (2, "a b")], "doc_id long, text string")
    known = spark.createDataFrame([("a", 30), ("b", 30)], "tok string, freq long")
    monkeypatch.setattr(T, "BROADCAST_WORDS", 1)
    pairs = T.bigrams(docs, known)
    assert sorted(map(tuple, pairs.collect())) == [("a", "b", 2), ("b", "a", 1)]
    assert len(shuffled(T.bigrams(docs, known))) == 1 and "Join" not in planned(pairs)


def test_runs_are_neither_joined_nor_shuffled(spark, monkeypatch):
    """Also with more known words than are broadcast to be joined: nothing but what is found is written."""
    stored, seen = T.stored, []
    monkeypatch.setattr(T, "BROADCAST_WORDS", 1)
    monkeypatch.setattr(T, "stored", lambda df, name: (seen.append(df), stored(df, name))[1])
    lines = spark.createDataFrame([(1, 0, ["the", "sta", "tute", "of", "sta", "te"]), (1, 0, ["sta", "te"]), (2, 0, None)], "doc_id long, line_no int, toks array<string>")
    known = spark.createDataFrame([("statute", 30), ("the", 30), ("state", 30), ("te", 30)], "tok string, freq long")
    rows = sorted(map(tuple, T.rejoined(lines, known, known).collect()))
    assert rows == [(1, 0, 0, 2, "state"), (1, 0, 1, 2, "statute"), (1, 0, 4, 2, "state")]
    assert seen and all("Join" not in planned(df) and not shuffled(df) for df in seen)


def test_a_sieve_loses_no_key_and_most_others(spark):
    rng = np.random.default_rng(5)
    keys, others = (rng.integers(-(1 << 63), 1 << 63, n) for n in (200_000, 100_000))
    sieve = E.sieve(spark.createDataFrame(pa.table({"key": keys})), len(keys)).value
    assert len(sieve.bits) == 4 and sieve.passes(keys).all() and sieve.passes(others).mean() < 0.03
    assert not E.sieve(spark.createDataFrame([], "key long"), 0).value.passes(others).any()


def test_places_without_context_take_no_page_along(spark):
    """A word's surroundings are made with its place: no page is joined to show them."""
    known = spark.createDataFrame(list(WORDS.items()), "tok string, freq long")
    pages = C.pages_of(spark.createDataFrame([(1, 0, "the people of the sbction amended\nsbction"), (1, 1, None)], "volume long, page long, text string"), "volume", "page")
    lost, _ = C.context_lists(pages, C.Lexicon.of(known, known), spark.createDataFrame([], "prev string, next string, n long"))
    assert sorted(tuple(r) for r in lost.collect()) == [(1, 0, 0, 4, "sbction", "the people of the <<sbction>> amended", "section"), (1, 0, 1, 0, "sbction", "<<sbction>>", "section")]
    assert not any("lines" in x or "page#" in x for x in shuffled(lost))


def test_forms_are_made_by_all_tasks_and_sifted(spark):
    """A few words are many forms: they aren't made by the one task that a small table is."""
    known = spark.createDataFrame(list(WORDS.items()), "tok string, freq long").coalesce(1)
    plan = E.near(known.select("tok").coalesce(1), known, 2)._jdf.queryExecution().executedPlan().toString()
    n = spark.sparkContext.defaultParallelism
    assert n > 1 and plan.count(f", {n}), REPARTITION_BY_NUM") == 2 and "explode" not in plan
