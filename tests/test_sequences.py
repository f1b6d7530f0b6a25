"""Sequence rules against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.operators import lineage
from foliant.operators import sequence as S


def test_longest_chain():
    rng = random.Random(1)
    for _ in range(200):
        v = [rng.randint(0, 9) for _ in range(rng.randint(0, 9))]
        got = S.increasing_chain(v)
        rising = lambda c: all(v[a] < v[b] for a, b in zip(c, c[1:]))
        best = max((len(c) for k in range(len(v) + 1) for c in itertools.combinations(range(len(v)), k) if rising(c)), default=0)
        assert rising(got) and got == sorted(got) and len(got) == best


@pytest.mark.parametrize("at_once", [1, 50, 1 << 20])
def test_upper_median_slope(at_once):
    rng = np.random.default_rng(2)
    for n in (2, 3, 7, 40, 90):
        for spread in (3, 1000):
            x, y = rng.integers(0, spread, n).astype(float), rng.integers(0, spread, n).astype(float)
            slopes = sorted((y[j] - y[i]) / (x[j] - x[i]) for i in range(n) for j in range(n) if x[j] > x[i])
            got = S.upper_median_slope(x, y, at_once)
            assert got == (slopes[len(slopes) // 2] if slopes else None)


def test_robust_line_drops_what_is_far_off():
    x = np.arange(40.0)
    y = 3 * x + 2
    y[[5, 20]] += 400
    assert np.flatnonzero(~S.robust_line(x, y)).tolist() == [5, 20]
    assert S.robust_line(x[:5], y[:5]).all() and S.robust_line(np.ones(9), x[:9]).all()


def test_streamed_rules(spark):
    rng = random.Random(3)
    rows = [(k, p, rng.randint(0, 300)) for k in "abc" for p in range(200)]
    df = spark.createDataFrame(rows, "k string, p long, v long")
    for rule, args in (("kept_by_gap", {"gap": 40}), ("pruned_chain", {"slack": 30}), ("split_runs", {})):
        want = {}
        for key in "abc":
            last, kept, run, top = None, None, 0, None
            for _, p, v in (r for r in rows if r[0] == key):
                if rule == "kept_by_gap":
                    keep = last is None or v - last >= 40
                    last = v if keep else last
                    want[key, p] = keep
                elif rule == "pruned_chain":
                    keep = kept is None or v - kept[1] <= p - kept[0] + 30
                    kept = (p, v) if keep else kept
                    want[key, p] = keep
                else:
                    if top is not None and v <= 5 and v < top - 2:
                        run, top = run + 1, 0
                    top = max(top or 0, v)
                    want[key, p] = run
        got = {(r[0], r[1]): r[3] for r in S.greedy(df, "k", "p", "v", rule, **args).collect()}
        assert got == want


def test_span_end(spark):
    rng = random.Random(4)
    pages = [rng.choice([None, *range(12)]) for _ in range(120)]
    df = spark.createDataFrame([("a", k, p) for k, p in enumerate(pages)], "vol string, pos long, page long")
    got = {r.pos: r.end_page for r in S.span_end(df, ["vol"], ["pos"], "page").collect()}
    assert got == {k: None if p is None else next((q for q in pages[k + 1 :] if q is not None and q > p), p) for k, p in enumerate(pages)}


def test_reached_by_brute_force(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(30), rng.randrange(30)) for _ in range(40)]
    df = spark.createDataFrame(edges, "from_id long, to_id long")
    got = {(r.start, r.id): r.depth for r in lineage.reached(df, spark.range(30)).collect()}
    want = {}
    for start in range(30):
        front, depth = {start}, 0
        while front:
            depth += 1
            front = {b for a, b in edges if a in front and (start, b) not in want}
            want.update({(start, b): depth for b in front})
    assert got == want
    assert {r.start: r.cyclic for r in lineage.cyclic(df, spark.range(30)).collect()} == {s: (s, s) in want for s in range(30)}


def test_neighbours_frames_only_grow(spark):
    """A frame up to a key's end is read anew for each row: its time grows with the square of the key's rows."""
    rows = [(k, p, (p * 7 + k) % 10, (p * p + k) % 4 == 0) for k in range(3) for p in range(40)]
    got = S.neighbours(spark.createDataFrame(rows, "k int, pos int, n int, t boolean"), ["k"], ["pos"], F.col("t"), ["n"])
    assert "unboundedfollowing" not in got._jdf.queryExecution().toString().lower()
    for r in got.collect():
        before, behind = ([x[2] for x in rows if x[0] == r.k and x[3] and side * x[1] > side * r.pos] for side in (-1, 1))
        assert (r.prev_n, r.next_n) == (before[-1] if before else None, behind[0] if behind else None)
