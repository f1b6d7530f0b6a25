"""Alignments against brute force, and defined results for nulls and empty texts."""

import difflib
import itertools
import random

from pyspark.sql import functions as F

from foliant.functions import alignment as A
from foliant.functions import dates as D
from foliant.functions import pages as P
from foliant.functions.text import tokens
from foliant.operators import consensus as C


def swaps(a, b):
    """Edits with swaps of neighbours, by trying all."""
    if not a or not b:
        return len(a) + len(b)
    best = min(swaps(a[1:], b) + 1, swaps(a, b[1:]) + 1, swaps(a[1:], b[1:]) + (a[0] != b[0]))
    if len(a) > 1 and len(b) > 1 and a[0] == b[1] and a[1] == b[0]:
        best = min(best, swaps(a[2:], b[2:]) + 1)
    return best


def test_swap_distance(spark):
    words = ["".join(w) for n in range(4) for w in itertools.product("abc", repeat=n)]
    pairs = [(a, b) for a in words for b in words] + [("ca", "abc"), ("abdc", "acbd")]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", A.swap_distance("a", "b", F.lit(2)).alias("d")).collect()
    assert [(a, b, d) for a, b, d in got] == [(a, b, min(swaps(a, b), 3)) for a, b in pairs]
    assert spark.sql("SELECT CAST(NULL AS STRING) a, 'x' b").select(A.swap_distance("a", "b", F.lit(2))).first()[0] is None


def test_token_diff(spark):
    rows = [("a b c", "a x c"), ("", "a"), ("a", ""), ("", ""), (None, "b")]
    got = spark.createDataFrame(rows, "a string, b string").select(A.token_diff(tokens(F.col("a")), tokens(F.col("b")))).collect()
    assert [[(d["op"], d["tokens"]) for d in r[0]] for r in got] == [
        [("equal", ["a"]), ("delete", ["b"]), ("insert", ["x"]), ("equal", ["c"])],
        [("insert", ["a"])],
        [("delete", ["a"])],
        [],
        [("insert", ["b"])],
    ]


def test_pages_without_text(spark):
    got = spark.sql("SELECT CAST(NULL AS ARRAY<STRING>) t UNION ALL SELECT array() t").select(P.page_decision(F.col("t")).alias("d")).collect()
    assert [tuple(r.d) for r in got] == [("AMBIGUOUS", "no_text")] * 2


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


def test_nearest_span():
    rng = random.Random(1)
    for _ in range(400):
        gold, text = ("".join(rng.choice("abc") for _ in range(rng.randint(0, n))) for n in (6, 12))
        s, e, d = A.nearest_span(gold, text)
        assert 0 <= s <= e <= len(text)
        assert edits(gold, text[s:e]) == d == min(edits(gold, text[i:j]) for i in range(len(text) + 1) for j in range(i, len(text) + 1))


def test_best_span(spark):
    rows = [("legislature", "the 1egislatnre of"), ("a", ""), ("", "abc"), (None, "x"), ("x", None)]
    got = spark.createDataFrame(rows, "g string, t string").select(A.best_span("g", "t").alias("s")).collect()
    assert [tuple(r.s) if r.s else None for r in got][:3] == [("1egislatnre", 4, 2), ("", 0, 1), ("", 0, 0)]
    assert all(r.s is None or r.s.distance is None for r in got[3:])


def test_garbles(spark):
    gold = "the weights and measures of the state that that stands"
    want = {
        gold: {},
        "the weights eights and measures": {"slivers": 1, "total": 1},
        "meas measures of": {"slivers": 1, "total": 1},
        "the w eights and": {"splits": 1, "initials": 1, "total": 1},
        "meas ures and and of": {"splits": 1, "doubles": 1, "total": 2},
        "The W. eights eights, wei weights": {"splits": 1, "initials": 1, "slivers": 1, "doubles": 1, "total": 3},
        "meas ures ures measures": {"splits": 1, "slivers": 1, "doubles": 1, "total": 3},
        "": {},
    }
    df = spark.createDataFrame([(gold, r) for r in want] + [(None, "a a"), (gold, None)], "gold string, read string")
    got = A.with_garbles(df, F.split("gold", " "), F.split("read", " ")).collect()
    none = dict.fromkeys(A.GARBLES.names, 0)
    assert {r.read: r.garbles.asDict() for r in got if r.gold} == {r: none | w for r, w in want.items()} | {None: none}
    assert [r.garbles.asDict() for r in got if not r.gold] == [none | {"doubles": 1, "total": 1}]


def test_places_in_a_spine():
    """Every word of the other stands once, in order, and what both share stands at the spine's place."""
    rng = random.Random(2)
    for _ in range(300):
        spine, other = ([rng.choice("abcd") for _ in range(rng.randint(0, 9))] for _ in range(2))
        got = list(C.places(spine, other))
        assert [k for *_, k in got] == list(range(len(other)))
        at = [(p, 1 << 30 if r < 0 else r) for p, r, _ in got]
        assert at == sorted(at) and all(0 <= p <= len(spine) for p, _ in at)
        blocks = [(b.a + k, b.b + k) for b in difflib.SequenceMatcher(None, spine, other, autojunk=False).get_matching_blocks() for k in range(b.size)]
        assert {(p, k) for p, r, k in got if r < 0} >= set(blocks)
    assert list(C.places("a b c d".split(), "a x y z c d".split())) == [(0, -1, 0), (1, -1, 1), (2, 0, 2), (2, 1, 3), (2, -1, 4), (3, -1, 5)]


def test_consensus_by_plain_voting(spark):
    """Whole pages: the aligned vote of readings against a vote over the same places in plain Python."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(30)]
    rows, want = [], {}
    for page in range(12):
        true = rng.sample(words, 12)
        for reader in range(3):
            read = [w if (k + reader) % 3 else rng.choice(["zzz", "qqq", "yyy"]) + str(reader) for k, w in enumerate(true)]
            rows.append((page, f"r{reader}", " ".join(read)))
        want[page] = " ".join(true)  # two of three have each word
    df = spark.createDataFrame(rows, "page long, reader string, text string")
    got = {r.page: r for r in C.consensus(df, "page", "reader", "text").collect()}
    assert {p: r.text for p, r in got.items()} == want
    assert all(r.n_tokens == 12 and r.agreement == 1.0 and r.confidence == 0.6667 and r.method == "vote" for r in got.values())


def test_date_damage(spark):
    rows = [
        ("[Approved March 3, 1913.] amend an act of 1871", "Approved March 3, 1013", 1913, ["field_year:1013"]),
        ("Passed May 41, 1851", None, 1851, ["day:41"]),
        ("Filed with\nSecretary of State 19638", "", 1963, ["five_digits:19638"]),
        ("Approved by Governor June 1, 196%", "", 1963, ["year_symbol:196%"]),
        ("Statutes of 1880. Approved April 2, 1880", "", 1901, []),
        (None, None, 1901, []),
    ]
    df = spark.createDataFrame(rows, "t string, a string, y int, want array<string>")
    for r in df.select("want", D.date_damage(F.col("t"), F.col("a"), F.col("y")).alias("got")).collect():
        assert r.got == r.want, r


def test_aligned_words_are_returned_by_parts(spark, monkeypatch):
    """Nothing of a whole batch of readings is held as Python objects: results of one batch are many."""
    monkeypatch.setattr(C, "ROWS", 3)
    monkeypatch.setattr(C, "AT_ONCE", 7)
    toks = [["a", "b", "c", "d"] * (k % 4) + [f"x{k}"] for k in range(20)]
    rows = spark.createDataFrame([(1, k, t, toks[3], t) for k, t in enumerate(toks)], "page int, reader int, toks array<string>, spine_keys array<string>, keys array<string>").coalesce(1)
    got = sorted(tuple(r) for r in C.aligned(rows).collect())
    assert got == sorted((1, k, place, rank, t[at]) for k, t in enumerate(toks) for place, rank, at in C.places(toks[3], t))
