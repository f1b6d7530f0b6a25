"""The correction cascade on small pages, and its stages against plain Python."""

import itertools
import math
import random

import pytest

from foliant.operators import cascade as C
from foliant.operators import tokens as T
from foliant.plans.token_queries import az

WORDS = {
    "the": 9000, "legislature": 400, "people": 700, "state": 900, "shall": 800, "incorporated": 300, "restore": 250, "store": 300,
    "board": 260, "supervisors": 200, "county": 500, "section": 600, "amended": 300, "right": 300, "night": 290, "water": 300, "and": 5000, "of": 8000,
    "school": 400, "district": 400, "into": 600, "in": 4000, "to": 4500, "approved": 200, "rate": 100,
}


@pytest.fixture(scope="module")
def words(spark):
    known = spark.createDataFrame(list(WORDS.items()), "tok string, freq long")
    return C.Lexicon.of(known, known, spark.createDataFrame([("smyth",)], "tok string"))


def pages(spark, *texts, volume=1):
    return C.pages_of(spark.createDataFrame([(volume, k, t) for k, t in enumerate(texts)], "volume long, page long, text string"), "volume", "page")


def lines_of(df):
    return [r.lines for r in df.orderBy("volume", "page").collect()]


def test_pages(spark):
    df = pages(spark, "The Legis-\nlature\n\n  12\nOf", None, "")
    assert lines_of(df) == [[["the", "legis"], ["lature"], ["of"]], [], []]
    assert df.filter("page = 0").first().hyphens == ["legis", None, None]


def test_reunify_each_way(spark, words):
    df = pages(
        spark,
        "the legis lature of the state\nin to the county",  # in a line; known pieces stay
        "the people of the sup-\nervisors\nboard",  # over a line's end, by its hyphen
        "of the state incorpo",  # over a page's end
        "rated and the",
        "the incor the porated of",  # a known word ends the search
        "of incorpo xq rated",  # a piece looks ahead over what isn't a word
    )
    out, audit = C.reunify(df, words)
    assert lines_of(out) == [
        [["the", "legislature", "of", "the", "state"], ["in", "to", "the", "county"]],
        [["the", "people", "of", "the", "supervisors"], [], ["board"]],
        [["of", "the", "state", "incorporated"]],
        [["and", "the"]],
        [["the", "incor", "the", "porated", "of"]],
        [["of", "incorporated", "xq"]],
    ]
    got = sorted((r.page, r.kind, r.after) for r in audit.collect())
    assert got == [(0, "reunify_space", "legislature"), (1, "reunify_break", "supervisors"), (2, "reunify_xpage", "incorporated"), (5, "reunify_window", "incorporated")]


def test_pieces_over_page_ends(spark, words):
    """Within reach over a page's end, where the next page's first word isn't the other piece; two heads of one tail."""
    out, audit = C.reunify(pages(spark, "of the incor", "xq porated and the legis", "xz legis zq lature of"), words)
    assert lines_of(out) == [[["of", "the", "incorporated"]], [["xq", "and", "the", "legis"]], [["xz", "legislature", "zq", "of"]]]
    assert sorted((r.page, r.kind, r.before) for r in audit.collect()) == [(0, "reunify_window", "incor+porated"), (2, "reunify_window", "legis+lature")]


def test_split_correct_and_mend(spark, words):
    df = pages(spark, "schooldistrict of the schooldistrictwater ofthe smyth rigbt sbction amxnded watér\nboardx xxvii bcdfgh")
    split, audit = C.replaced(df, C.split_fixes(df, words), words, "split")
    assert lines_of(split)[0][0][:6] == ["school", "district", "of", "the", "school", "district"]
    assert {(r.before, r.after) for r in audit.collect()} == {("schooldistrict", "school district"), ("schooldistrictwater", "school district water")}
    fixed, audit = C.replaced(split, C.correction_fixes(split, words), words, "autocorrect_e1")
    assert {(r.before, r.after) for r in audit.collect()} == {("rigbt", "right"), ("sbction", "section"), ("amxnded", "amended"), ("boardx", "board"), ("watér", "water")}
    assert "smyth" in lines_of(fixed)[0][0] and "xxvii" in lines_of(fixed)[0][1] and "bcdfgh" in lines_of(fixed)[0][1]
    mended, _ = C.replaced(df, C.mojibake_fixes(df, words), words, "mojibake")
    assert "water" in lines_of(mended)[0][0]


def test_context_needs_a_clear_lead(spark, words):
    df = pages(spark, "the fight of\nthe kight to\nof xight")
    known = spark.createDataFrame([("right", 300), ("night", 300), *((w, n) for w, n in WORDS.items() if w not in ("right", "night"))], "tok string, freq long")
    lexicon = C.Lexicon.of(known, known)
    pairs = spark.createDataFrame([("the", "right", 40), ("right", "of", 30), ("the", "night", 9), ("night", "to", 3), ("right", "to", 4)], "prev string, next string, n long")
    out, audit = C.by_context(df, lexicon, pairs)
    assert lines_of(out) == [[["the", "right", "of"], ["the", "right", "to"], ["of", "xight"]]]
    score = lambda w, p, n: math.log1p({("the", "right"): 40, ("the", "night"): 9}.get((p, w), 0)) + math.log1p({("right", "of"): 30, ("night", "to"): 3, ("right", "to"): 4}.get((w, n), 0))
    assert score("right", "the", "to") - score("night", "the", "to") >= 1
    assert sorted((r.kind, r.before, r.after) for r in audit.collect()) == [("context", "fight", "right"), ("context", "kight", "right")]


def test_context_lists(spark, words):
    """No pair has a candidate of the first word; two candidates of the second one fit as well."""
    df = pages(spark, "of the people and the state of the county sbction amended xq\nthe kight")
    known = spark.createDataFrame([("right", 300), ("night", 300), *((w, n) for w, n in WORDS.items() if w not in ("right", "night"))], "tok string, freq long")
    pairs = spark.createDataFrame([("the", "right", 5), ("the", "night", 5)], "prev string, next string, n long")
    lost, weak = C.context_lists(df, C.Lexicon.of(known, known), pairs)
    assert [tuple(r) for r in lost.collect()] == [(1, 0, 0, 9, "sbction", "people and the state of the county <<sbction>> amended xq", "section")]
    assert [tuple(r) for r in weak.collect()] == [("kight", "night|right", 1)]


def test_cascade_rates(spark, words):
    texts = ["the legis lature of the state", "schooldistrict and the rigbt of water", "nothing here is aword xyzzy"]
    out, audit, rates = C.cascade(pages(spark, *texts), words, spark.createDataFrame([], "prev string, next string, n long"))
    got = {r.stage: (r.flagged, r.tokens) for r in rates.collect()}
    known = lambda lines: sum(w not in WORDS for x in lines for w in x if len(w) >= 2)
    assert got["raw"] == (9, 17) and got["reunify"] == (7, 16) and got["split"] == (6, 17) and got["autocorrect"][0] == 5
    final = [x for p in lines_of(out) for x in p]
    assert got["context"] == (known(final), sum(map(len, final)))
    empty = C.cascade(pages(spark, None), words, spark.createDataFrame([], "prev string, next string, n long"))
    assert lines_of(empty[0]) == [[]] and {r.tokens for r in empty[2].collect()} == {0}


def test_three_passes(spark):
    known = spark.createDataFrame(list(WORDS.items()), "tok string, freq long")
    often = {"rigbt": 12, "nlght": 2, "schooldistrict": 3, "boardof": 4, "watre": 30}
    vocab = spark.createDataFrame([*WORDS.items(), *often.items()], "tok string, freq long")
    texts = spark.createDataFrame([(1, 0, "the legis-\nlature of rigbt nlght schooldistrict\nboardof watre"), (1, 1, None)], "volume long, page long, text string")
    out, audit, rates = C.three_passes(texts, C.Lexicon.of(known, vocab), "volume", "page")
    # "nlght" stands too seldom to be corrected; "boardof" is cut at its stopword
    assert lines_of(out) == [[["the", "legislature", "of", "right", "nlght", "school", "district"], ["board", "of", "water"]], []]
    assert sorted((r.kind, r.before) for r in audit.collect()) == [("demerge", "boardof"), ("demerge", "schooldistrict"), ("spell", "rigbt"), ("spell", "watre")]
    assert {r.stage: (r.flagged, r.tokens) for r in rates.collect()} == {"raw": (7, 9), "rejoin": (5, 8), "demerge": (3, 10), "spell": (1, 10)}


# --- words against brute force ------------------------------------------------------------------------


def distance(a, b):
    """Edits with swaps, no place edited twice."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


@pytest.fixture(scope="module")
def some(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 7)))
    known = {word(): rng.choice([1, 4, 5, 12, 13, 30, 60, 200, 900]) for _ in range(120)}
    odd = sorted({word() for _ in range(150)} - known.keys())
    return known, odd, spark.createDataFrame(list(known.items()), "tok string, freq long"), spark.createDataFrame([(w,) for w in odd], "tok string")


def test_words_within_two_edits(some):
    known, odd, k, o = some
    got = {(r.tok, r.candidate): (r.freq, r.d) for r in T.within_two_edits(o, k).collect()}
    assert got == {(a, b): (f, d) for a in odd for b, f in known.items() if 1 <= (d := distance(a, b)) <= 2}
    assert {(r.tok, r.candidate) for r in T.within_one_edit(o, k).collect()} == {p for p, (_, d) in got.items() if d == 1}
    near = {(r.tok, r.candidate) for r in T.edit_neighbours(o).collect()}
    assert {p for p, (_, d) in got.items() if d == 1} <= near and all(distance(a, b) == 1 for a, b in random.Random(1).sample(sorted(near), 500))


def test_symmetric_lookup(some):
    known, odd, k, o = some
    want = {}
    for a in odd:
        found = sorted((distance(a, b), -f, b) for b, f in known.items() if f >= 5 and 1 <= distance(a, b) <= 2)
        if found:
            d, f, b = found[0]
            same = [-x for e, x, _ in found if e == d]
            if -f >= (12, 30)[d - 1] and (len(same) == 1 or same[0] >= (5, 8)[d - 1] * same[1]):
                want[a] = (b, d)
    assert {r.tok: (r.fix, r.d) for r in T.symmetric_lookup(o, k).collect()} == want and want


def test_triage_and_singletons(spark, some):
    from foliant.operators import headings as H

    known, odd, k, o = some
    starts = lambda w, by, least: len(w) >= least and any((x.startswith(w) or x.endswith(w)) and len(x) >= len(w) + by for x in known)
    runs = lambda w: max(len(list(g)) for _, g in itertools.groupby(w))
    vowels = lambda w: sum(c in "aeiou" for c in w) / len(w)
    want = {}
    for w in odd:
        near = any(distance(w, x) == 1 for x in known)
        want[w] = "NOISE" if runs(w) >= 4 else "TYPO" if near else "FRAGMENT" if starts(w, 1, 4) else "NAMELIKE" if 0.2 <= vowels(w) <= 0.6 and runs(w) <= 2 and len(w) >= 4 else "GARBLE"
    assert {r.tok: r.category for r in T.triage(o, k).collect()} == want
    rng = random.Random(9)
    side = lambda: rng.choice([None, *rng.sample(sorted(known), 3), *rng.sample(odd, 3)])
    places = [(w, side(), side()) for w in odd]
    got = {r.tok: r[1] for r in H.singleton_classes(spark.createDataFrame(places, "tok string, prev string, next string"), k).collect()}
    for w, p, n in places:
        vowelless = len(w) >= 5 and not set(w) & set("aeiouy")
        cons = max((len(list(g)) for c, g in itertools.groupby(w, lambda c: c in "bcdfghjklmnpqrstvwxz") if c), default=0)
        join = (n and n not in known and w + n in known) or (p and p not in known and p + w in known)
        least = min((distance(w, x) for x in known), default=9)
        over = any(w[:i] in known and w[i:] in known for i in range(3, len(w) - 2))
        tail = any(x.endswith(w) and len(x) >= len(w) + 2 for x in known) and p and p not in known
        head = any(x.startswith(w) and len(x) >= len(w) + 2 for x in known) and n and n not in known
        kind = "GARBAGE" if (len(w) >= 4 and runs(w) >= 3) or cons >= 5 or vowelless else "FRAG_join" if join else "EDIT1" if least == 1 else "EDIT2" if least == 2 else "OVER_MERGE" if over else "FRAG_affix" if tail or head else "STANDALONE"
        assert got[w] == kind, (w, p, n)


def test_rejoined_by_brute_force(spark):
    rng = random.Random(10)
    parts = ["ab", "cde", "fg", "hij", "k", "abcde", "fghij", "cdefg"]
    known = {"ab": 5, "abcde": 5, "cdefg": 5, "abcdefg": 5, "fghij": 5, "hijab": 5}
    lines = [(d, k, [rng.choice(parts) for _ in range(rng.randint(0, 9))]) for d in range(20) for k in range(5)]
    df = spark.createDataFrame(lines, "doc_id long, line_no int, toks array<string>")
    k = spark.createDataFrame(list(known.items()), "tok string, freq long")
    got = {(r.doc_id, r.line_no, r.start): (r.size, r.joined) for r in T.rejoined(df, k, k).collect()}
    want = {}
    for d, n, toks in lines:
        i = 0
        while i < len(toks):
            for size in range(min(4, len(toks) - i), 1, -1):
                run = toks[i : i + size]
                if "".join(run) in known and len("".join(run)) >= 5 and all(len(w) >= 2 for w in run) and any(w not in known for w in run) and all(w in known or len(w) >= 3 for w in run):
                    want[d, n, i] = (size, "".join(run))
                    i += size
                    break
            else:
                i += 1
    assert got == want and want
    # the lines are read once, for runs that are written: their words are in no later plan
    assert "toks" not in T.rejoined(df, k, k)._jdf.queryExecution().toString()
    odd = spark.createDataFrame([(1, 0, None), (2, 0, []), (3, 0, ["ab"]), (4, 0, ["cde", "fgh", "ab"] * 3000)], df.schema)
    assert {(r.doc_id, r.start, r.joined) for r in T.rejoined(odd, k.unionByName(spark.createDataFrame([("cdefghab", 5)], k.schema)), k).collect()} == {(4, 3 * i, "cdefghab") for i in range(3000)}


def test_hot_words_are_joined_all_the_same(spark, monkeypatch):
    monkeypatch.setattr(T, "BROADCAST_WORDS", 0)
    monkeypatch.setattr(T, "HOT_PLACES", 50)
    rng = random.Random(11)
    rows = [(k, rng.choice(["the"] * 8 + ["of", "state", "odd"])) for k in range(400)]
    df = spark.createDataFrame(rows, "k long, tok string")
    vocab = df.groupBy("tok").count().withColumnRenamed("count", "freq")
    right = spark.createDataFrame([("the", 1), ("state", 2)], "tok string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = sorted(map(tuple, T.join_words(df, right, vocab, how).collect()), key=repr)
        assert got == sorted(map(tuple, df.join(right, "tok", how).collect()), key=repr)
    assert az(df).count() == 400
