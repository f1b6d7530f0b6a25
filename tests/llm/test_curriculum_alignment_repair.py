"""Operators 11 to 13: whole queries against brute force or their oracle, and odd rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import pyarrow as pa
import pytest
from compare import differences
from conftest import DATA
from pyspark.sql import types as T

from foliant.llm import conversations, curriculum, queries, token_alignment
from foliant.llm.bpe import default_tokenizer, read_spec

FOLDER = f"{DATA}/sf0.001"
BLANK = " \t\n\x0b\x0c\r"
TURN = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n", T.StringType())]
)


# --- 11


def damaged(rows):
    """conv to rows after damage, in order."""
    out = {}
    for i, t, r, x in rows:
        own = out.setdefault(i, [])
        fault = zlib.crc32(f"{' ' if i is None else i}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if fault == 0:
            continue
        x = "" if fault == 1 else "".join(c for c in x if c not in ".!?") if fault == 2 else x
        own.extend([(t, "user" if fault == 4 else r, x)] * (2 if fault == 3 else 1))
    return {i: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for i, own in out.items()}


def repaired_by_brute_force(rows):
    """The contract's columns of one conversation, by a search over all edits."""
    seen, faults = set(), []
    for t, r, x in rows:
        core = x.strip(BLANK)
        faults.append("blank" if not core else "duplicate" if (r, x) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((r, x))

    def follows(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    @lru_cache(maxsize=None)
    def best(k, state, inserted=0):
        ways = []
        if k == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        if inserted < 3:
            for role in ("user", "assistant"):
                if q := follows(state, role[0]):
                    c, a, o = best(k, q, inserted + 1)
                    ways.append((c + 2, "I" + a, (f"{role}:", *o)))
        if k < len(rows):
            _, role, text = rows[k]
            c, a, o = best(k + 1, state)
            ways.append((c + 3, "D" + a, o))
            if faults[k] in ("", "truncated"):
                extra = faults[k] == "truncated"
                if q := follows(state, role[:1]):
                    c, a, o = best(k + 1, q)
                    ways.append((c + extra, "K" + a, (f"{role}:{text}", *o)))
                for new in ("user", "assistant"):
                    if q := follows(state, new[0]):
                        c, a, o = best(k + 1, q)
                        ways.append((c + 2 + extra, "R" + a, (f"{new}:{text}", *o)))
        return min(ways, key=lambda w: w[:2], default=(10**9, "", ()))

    cost, audit, out = best(0, "")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def columns(rows):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}


def test_repair_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op11_conversation_repair(spark, f"{DATA}/sf0.01").collect()
    want = {i: repaired_by_brute_force(r) for i, r in damaged(rows).items()}
    assert len(got) == len(want) and columns(got) == want


@pytest.mark.parametrize("stretch", [1, 3, 64])
def test_repair_of_random_rows(spark, monkeypatch, stretch):
    """Null ids, turns, roles and texts, other roles, ties, repeated rows, and conversations cut into many stretches."""
    monkeypatch.setattr(conversations, "STRETCH", stretch)
    rng = random.Random(stretch)
    rows = []
    for i in [None, *range(120)]:
        for _ in range(rng.choice([1, 2, 3, 5, 9, 14])):
            role = rng.choice(["user", "assistant", "system", "tool", None, "", "sys", "usher"])
            text = rng.choice([None, "", " \n", "Yes.", "No", "So? ", "end!\x0b", "é.", f"t{rng.random()}", f"t{rng.random()}."])
            rows.append((i, rng.choice([None, *range(8)]), role, text))
    df = spark.createDataFrame([(*r, "n") for r in rows], TURN)
    got = conversations.audits(conversations.damaged(df)).collect()
    assert columns(got) == {i: repaired_by_brute_force(r) for i, r in damaged(rows).items()}
    out = defaultdict(list)
    for r in conversations.repaired(conversations.damaged(df)).orderBy("place").collect():
        out[r.conv_id].append(f"{r.role}:{r.text}")
    assert all(hashlib.sha256("\n".join(out[r.conv_id]).encode()).hexdigest() == r.repaired_sha256 for r in got)


def test_odd_conversations(spark):
    assert conversations.audits(conversations.damaged(spark.createDataFrame([], TURN))).count() == 0
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    kept = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 9)
    df = spark.createDataFrame([(gone, 0, "user", "x.", "n"), (kept, 0, "user", "long " * 200_000 + ".", "n")], TURN)
    got = columns(conversations.audits(conversations.damaged(df)).collect())
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[kept][5:7] == (2, "KI")
    # without damage, and one conversation of many rows over several stretches
    many = spark.createDataFrame([(1, k, "user" if k % 2 == 0 else "assistant", f"t{k}.", "n") for k in range(5_001)], TURN)
    (row,) = conversations.audits(many).collect()
    assert (row.cost, row.audit) == (2, "K" * 5_001 + "I")


# --- 12


def test_curriculum_oracle(spark):
    for folder in (FOLDER, f"{DATA}/sf0.01"):
        assert differences(queries.op12_curriculum(spark, folder), queries.ORACLES["op12_curriculum"], folder) == ""


DOC = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()), T.StructField("size", T.LongType()), T.StructField("position", T.StringType())]
)


def test_curriculum_of_odd_rows(spark, monkeypatch):
    """Null and repeated ids, null texts and sources, a source of a third of all rows, one that is short, many ranges."""
    monkeypatch.setattr(curriculum, "RANGE_ROWS", 7)
    monkeypatch.setattr(curriculum, "STRETCH", 3)
    rng = random.Random(3)
    rows = [(rng.choice([None, 5, k]), rng.choice([None, "", "a " * rng.randint(1, 40), "b\x0bc\td"]), rng.choice(["hot"] * 5 + [None, "é", "z", "A", "none"])) for k in range(600)]
    rows = [(i, None if s == "none" else t, s) for i, t, s in rows] + [(9, "x y z", "short")] * 2
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], DOC)
    got = curriculum.mixed(df).collect()
    size = Counter()
    for _, t, s in rows:
        size[s] += len((t or "").split())
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(size, key=lambda s: (s is None, (s or "").encode())))}
    target, held = {}, set()
    while True:
        left = 1.5 * sum(size.values()) - sum(2 * size[s] for s in held)
        free = sum(w for s, w in weight.items() if s not in held)
        target = {s: 2.0 * size[s] if s in held else left * w / free for s, w in weight.items()}
        if not (over := {s for s in target if target[s] > 2 * size[s] + 1e-9}):
            break
        held |= over
    by_target = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        by_target[round(r.target, 6)] += r.taken
    assert len(got) == len(rows)
    for t in {round(x, 6) for x in target.values()}:
        assert abs(by_target[t] - sum(round(x) for x in target.values() if round(x, 6) == t)) <= 2
    assert sorted(round(r.target, 6) for r in got) == sorted(round(target[s], 6) for _, _, s in rows)
    assert sorted(map(repr, got)) == sorted(map(repr, curriculum.mixed(df.repartition(5)).collect()))
    used = curriculum.training_order(df).collect()
    assert sum(r.words for r in used) == sum(r.taken for r in got)
    assert [r.position for r in used] == sorted(r.position for r in used)
    assert curriculum.mixed(df.limit(0)).count() == 0


def test_words_follow_the_schedules(spark):
    """Of each source, what is used up to a time is its target times the integral of its schedule up to then."""
    rows = [(k, "w " * (1 + k % 5), f"s{k % 3}", 0, "") for k in range(6_000)]
    used = curriculum.training_order(spark.createDataFrame(rows, DOC)).collect()
    total = Counter()
    for r in used:
        total[r.source] += r.words
    for source, schedule in zip(sorted(total), curriculum.SCHEDULES):
        for until in (0.1, 0.3, 0.5, 0.8):
            area = 0.0
            for (s, v), (t, w) in zip(schedule, schedule[1:]):
                e = min(t, max(s, until))
                area += (e - s) * (v + v + (w - v) * (e - s) / (t - s)) / 2
            words = sum(r.words for r in used if r.source == source and r.position <= until)
            assert abs(words - total[source] * area / curriculum.integral(schedule)) <= 6
    with pytest.raises(ValueError):
        curriculum.checked([((0.0, 1.0), (0.9, 1.0))])


# --- 13

PIECES = [" ", "  ", "\n", "\r\n", ");\r", "\t", "\xa0", "　", "▁", "a", "the", "don't", "'s", "é", "日本", "🙂", "́", "<|endoftext|>", "<s>", "<0x41>", "\x00", "\x85", ".", ",", "123", "{\r", " ", "\x1c", "a" * 30]


def kernel():
    with open(default_tokenizer("piece_bpe_32k.model"), "rb") as f:
        return token_alignment.units(read_spec(default_tokenizer("byte_bpe_50k.json")), f.read())


def aligned_by_brute_force(u, text):
    """Counts, text of groups and links of one document."""
    a = u.a.encode(" " + text, add_special_tokens=False).ids if text else []
    b = u.b.encode(text) if text else []
    raw = (" " + text).encode() if text else b""
    if b"".join(u.a_bytes[i] for i in a) != raw or b"".join(u.b_bytes[i] for i in b) != raw or not text:
        return (0, 0, 0, 0), "", []

    def ranges(ids, table):
        out, at = [], 0
        for i in ids:
            out.append((at, at := at + len(table[i]), i))
        return out

    ra, rb = ranges(a, u.a_bytes), ranges(b, u.b_bytes)
    links = [(i, j) for s, e, i in ra for f, g, j in rb if s < g and f < e]
    groups, s = [], 0
    for c in sorted({e for _, e, _ in ra} & {e for _, e, _ in rb}):
        groups.append(",".join(str(i) for f, e, i in ra if s <= f and e <= c) + "|" + ",".join(str(i) for f, e, i in rb if s <= f and e <= c))
        s = c
    return (len(a), len(b), len(groups), len(links)), ";".join(groups), links


def aligned_rows(docs):
    u = kernel()
    found = [(i, *aligned_by_brute_force(u, t)) for i, t in docs]
    count = Counter(x for *_, links in found for x in links)
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return sorted(
        ((i, *n, sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(g.encode()).hexdigest() if g else "") for i, n, g, links in found), key=repr
    )


def alignment_columns(rows):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows), key=repr)


def test_alignment_query(spark, monkeypatch):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    want = aligned_rows(docs)
    assert alignment_columns(queries.op13_token_alignment(spark, FOLDER).collect()) == want
    # many groups of batches
    monkeypatch.setattr(token_alignment, "GROUP_DOCS", 30)
    monkeypatch.setattr(token_alignment, "BATCH_BYTES", 20_000)
    assert alignment_columns(queries.op13_token_alignment(spark, FOLDER).collect()) == want


def test_alignment_of_odd_rows(spark):
    rng = random.Random(7)
    texts = [None, "", " ", "a", " a", "\n", "\r", "  \r\n x", "x ", "▁", "plain words. plain words."] * 2
    texts += ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 25))) for _ in range(1_500)]
    docs = [(rng.choice([None, 7, k]), t) for k, t in enumerate(texts)]
    schema = "doc_id long, text string, b int, seq string"
    got = token_alignment.aligned(spark.createDataFrame([(*d, 1, "s") for d in docs], schema)).collect()
    assert alignment_columns(got) == aligned_rows(docs)
    assert token_alignment.aligned(spark.createDataFrame([], schema)).count() == 0


def test_units_are_remembered_up_to_a_bound(monkeypatch):
    monkeypatch.setattr(token_alignment, "REMEMBERED_BYTES", 2_000)
    u = token_alignment.Units(read_spec(default_tokenizer("byte_bpe_50k.json")), open(default_tokenizer("piece_bpe_32k.model"), "rb").read())
    texts = [f"word{k} the {'z' * 500}{k} é{k % 9}" for k in range(60)]
    for _ in range(3):
        for k in range(0, 60, 7):
            some = texts[k : k + 7]
            got, _ = token_alignment.Aligner(u, 0)(pa.array(some))
            want = [aligned_by_brute_force(u, t) for t in some]
            assert got["groups_sha256"] == [hashlib.sha256(g.encode()).hexdigest() for _, g, _ in want]
            assert [tuple(int(got[c][j]) for c in token_alignment.COUNTS) for j in range(len(some))] == [n for n, _, _ in want]
            assert len(u.late) + len(u.before) < 40 and not any(len(x) > 64 for x in [*u.late, *u.before])
