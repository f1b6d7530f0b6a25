"""Session fills, recovery passes, aligned headings and sweeps against brute force."""

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from foliant.operators import headings as H
from foliant.operators import recovery as R
from foliant.operators import sweep


def all_assignments(reads, slots):
    """Numbers that a candidate has in every best assignment of as many as possible."""
    m = min(len(reads), len(slots))
    scored = defaultdict(list)
    for some in itertools.combinations(range(len(reads)), m):
        for numbers in itertools.combinations(slots, m):
            scored[sum(0 if reads[i] is None else 1 if reads[i] == v else -1 for i, v in zip(some, numbers))].append(dict(zip(some, numbers)))
    best = scored[max(scored)]
    if len(reads) <= len(slots):
        return [(options := {a[i] for a in best}) and len(options) == 1 and options.pop() or None for i in range(len(reads))]
    out = [None] * len(reads)
    for v in slots:
        options = {next(i for i, x in a.items() if x == v) for a in best}
        if len(options) == 1:
            out[options.pop()] = v
    return out


def test_assignments():
    rng = random.Random(1)
    for _ in range(400):
        slots = sorted(rng.sample(range(1, 15), rng.randint(1, 6)))
        reads = [rng.choice([None, rng.randint(1, 15), rng.choice(slots)]) for _ in range(rng.randint(1, 6))]
        assert R.assigned(reads, slots) == all_assignments(reads, slots), (reads, slots)
    assert R.assigned([None, None], [4, 5]) == [4, 5] and R.assigned([], [1]) == [] and R.assigned([3], []) == [None]
    # long ones in blocks
    assert R.assigned([None] * 900, list(range(900))) == list(range(900))
    assert R.assigned([*range(500), None, *range(501, 900)], list(range(0, 1000))) == [*range(500), 500, *range(501, 900)]


ACT = "session long, pos long, volume long, page long, number long, readings array<long>, printed long, total long"


def some_acts(rng, sessions=6):
    rows = []
    for s in range(sessions):
        n, pos = 0, 0
        size = rng.randint(5, 40)
        for k in range(size):
            n += rng.choice([1, 1, 1, 1, 2])
            if rng.random() < 0.1:
                continue
            pos += 1
            read = lambda: rng.choice([None, n, n, n + rng.randint(-2, 3)])  # noqa: E731, B023
            rows.append([s, pos, k // 12, 3 + k - rng.randint(0, 1), n if rng.random() < 0.5 else None, [read(), read(), read()], read(), None])
        for r in rows:
            if r[0] == s:
                r[7] = n
    return rows


def by_session(rows):
    out = defaultdict(list)
    for r in rows:
        out[r[0]].append(r)
    return out


def plain_fill(rows):
    """session_fill of one session's rows (pos, volume, page, number, printed, total)."""
    seen = Counter(r[3] for r in rows if r[3] is not None)
    anchors, top = [], -1
    for r in rows:
        if r[3] is not None and seen[r[3]] == 1 and r[3] > top:
            anchors.append((r[0], top := r[3]))
    held = {r[1:3] for r in rows if r[3] is not None}
    first = {}
    for r in rows:
        if r[1:3] not in held:
            first.setdefault(r[1:3], r)
    out = {}
    if not anchors:
        return out
    sides = [((0, 0), anchors[0]), *zip(anchors, anchors[1:]), (anchors[-1], (10**9, rows[0][5] + 1))]
    for (p, lo), (q, hi) in sides:
        some = sorted(r for r in first.values() if p < r[0] < q)
        slots = [v for v in range(lo + 1, hi) if v not in seen]
        if some and slots:
            out |= {r[0]: v for r, v in zip(some, R.assigned([r[4] for r in some], slots)) if v is not None}
    return out


def test_session_fill(spark):
    rows = some_acts(random.Random(2), 12)
    got = R.session_fill(spark.createDataFrame(rows, ACT), "session", ["pos"], ["volume", "page"], "number", F.col("number").isNotNull(), "printed", "total").collect()
    want = {(s, p): v for s, own in by_session(rows).items() for p, v in plain_fill([(r[1], r[2], r[3], r[4], r[6], r[7]) for r in own]).items()}
    assert {(r.session, r.pos): r.filled for r in got} == want and len(got) == len(want) > 5
    assert all(r.lo < r.filled < r.hi for r in got)


def plain_passes(rows):
    """The passes over one session, each over all of it, until none adds anything."""
    rows = [dict(zip(("session", "pos", "volume", "page", "number", "readings", "printed", "total"), r)) for r in rows]
    origin = {}

    def neighbours(k):
        before = next((r for r in reversed(rows[:k]) if r["number"] is not None), None)
        behind = next((r for r in rows[k + 1 :] if r["number"] is not None), None)
        return before, behind

    def readers():
        out = {}
        for r in rows:
            often = [v for v, c in Counter(x for x in r["readings"] if x is not None).items() if c >= 2]
            if r["number"] is None and len(often) == 1:
                out[r["pos"]] = often[0]
        return out

    def printed():
        out = {}
        for k, r in enumerate(rows):
            a, b = neighbours(k)
            if r["number"] is None and r["printed"] is not None and a and b and a["number"] < r["printed"] < b["number"]:
                want = a["number"] + (b["number"] - a["number"]) * (r["pos"] - a["pos"]) / (b["pos"] - a["pos"])
                if abs(r["printed"] - want) <= max(12, 0.03 * r["total"]):
                    out[r["pos"]] = r["printed"]
        return out

    def counted():
        out, some = {}, []
        anchors = [k for k, r in enumerate(rows) if r["number"] is not None]
        if anchors:
            for i, j in zip([-1, *anchors], [*anchors, len(rows)]):
                lo = 0 if i < 0 else rows[i]["number"]
                hi = rows[0]["total"] + 1 if j == len(rows) else rows[j]["number"]
                some = rows[i + 1 : j]
                if some and hi - lo - 1 == len(some):
                    out |= {r["pos"]: lo + 1 + k for k, r in enumerate(some)}
        return out

    def over_volumes():
        return plain_fill([(r["pos"], r["volume"], r["page"], r["number"], r["printed"], r["total"]) for r in rows])

    idle, step = 0, 0
    while idle < 4:
        name, of = (("readers", readers), ("printed", printed), ("counted", counted), ("over_volumes", over_volumes))[step % 4]
        step += 1
        found = of()
        claims, known = Counter(found.values()), {r["number"] for r in rows}
        found = {p: v for p, v in found.items() if claims[v] == 1 and v not in known and 1 <= v <= rows[0]["total"]}
        for r in rows:
            if r["number"] is None and r["pos"] in found:
                r["number"], origin[r["pos"]] = found[r["pos"]], name
        idle = 0 if found else idle + 1
    return {r["pos"]: (r["number"], origin.get(r["pos"], "certain")) for r in rows if r["number"] is not None}


def test_recovery_is_the_fixpoint(spark):
    rows = some_acts(random.Random(3), 8)
    known, gains = R.recovered(spark.createDataFrame(rows, ACT))
    got = {(r.session, r.pos): (r.number, r.origin) for r in known.collect()}
    want = {(s, p): v for s, own in by_session(rows).items() for p, v in plain_passes(own).items()}
    assert got == want
    assert [g for *_, g in gains[-4:]] == [0] * 4 and sum(g for *_, g in gains) == len(got) - sum(r[4] is not None for r in rows) > 0
    assert len({name for _, name, g in gains if g}) >= 3
    none, gains = R.recovered(spark.createDataFrame([], ACT))
    assert none.count() == 0 and len(gains) == 4


def plain_rounds(kept, other, tolerance=0.18, margin=0.04):
    kept, other, pairs = dict(kept), dict(other), []
    while True:
        new = []
        for i, p in kept.items():
            near = sorted((abs(p - q), j) for j, q in other.items() if abs(p - q) <= tolerance)
            if not near or (len(near) > 1 and near[1][0] - near[0][0] < margin):
                continue
            j = near[0][1]
            if min((abs(q - other[j]), k) for k, q in kept.items() if abs(q - other[j]) <= tolerance)[1] == i:
                new.append((i, j))
        if not new:
            return pairs
        for i, j in new:
            del kept[i], other[j]
        pairs += new


def test_aligned_headings(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for page in range(60):
        # page 0: each pair becomes clear only when the one before it is taken out
        kept = [(k, 0.1 + 0.1 * k) for k in range(5)] if page == 0 else [(k, rng.randint(0, 32) / 32) for k in range(rng.randint(0, 7))]
        other = [(100 + k, 0.1 + 0.1 * k + 0.01 * k) for k in range(5)] if page == 0 else [(100 + k, rng.randint(0, 32) / 32) for k in range(rng.randint(0, 7))]
        rows += [(page, True, *x) for x in kept] + [(page, False, *x) for x in other]
        pairs = dict(plain_rounds(kept, other))
        rest = [(p, 0, j, None, j) for j, p in other if j not in pairs.values()]
        order = sorted([(p, 1, i, i, pairs.get(i)) for i, p in kept] + rest, key=lambda x: x[:3])
        want[page] = [(k + 1, x[3], x[4]) for k, x in enumerate(order)]
    df = spark.createDataFrame(rows, "page long, kept boolean, id long, pos double")
    got = defaultdict(list)
    for r in H.aligned_headings(df.filter("kept"), df.filter("NOT kept"), "page").orderBy("page", "place").collect():
        got[r.page].append((r.place, r.id, r.other))
    assert got == {p: w for p, w in want.items() if w}
    one = {(r.page, r.id) for r in H.paired_headings(df.filter("kept"), df.filter("NOT kept"), "page").collect()}
    assert len(one) < sum(i is not None and j is not None for w in want.values() for _, i, j in w)


def test_busy_windows(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), s := rng.randint(0, 300), s + rng.randint(-1, 12)) for _ in range(150)]
    df = spark.createDataFrame(rows, "k string, a long, b long")
    want = set()
    for key in "abc":
        level = np.zeros(330, int)
        for k, a, b in rows:
            if k == key and a < b:
                level[a:b] += 1
        at = 0
        for on, run in itertools.groupby(level >= 2):
            size = len(list(run))
            if on:
                want.add((key, at, at + size, level[at : at + size].max()))
            at += size
    assert {(r.k, r.begin, r.end, r.peak) for r in sweep.busy_windows(df, "k", "a", "b").collect()} == want
    assert sweep.busy_windows(df.limit(0), "k", "a", "b").count() == 0
