"""Classes of near copies by SimHash tries with a wide error budget, and an exact check.

Two texts are near copies at a Jaccard similarity of ``similarity`` or more over their sets of ``width``-word shingles
(words and case as in :mod:`.simhash`; a text with fewer words is one shingle). Classes are connected components.

A bit of two SimHash fingerprints differs with probability ``acos(2J / (1 + J)) / pi``: 0.15 at J = 0.8. So many
differing bits are more than a few blocks of equal bits can find. Fingerprints here have 256 bits, and each of several
tables draws 64 of them and holds them as a binary trie. The first ``depth`` bits name a subtree; in it node pairs are
traversed together, differing bits accumulate, and a pair of nodes is dropped once over the budget for 64 bits. A pair
that is left is held against the budget for all 256 bits. ``depth`` grows with the logarithm of the number of
fingerprints, so that a subtree holds as many unrelated ones at any size, and the number of tables follows from
``depth``: at the given similarity all tables together miss a pair with probability ``1 - recall`` at most.

A subtree gives two edge-disjoint spanning forests of least distances, never all its pairs. A subtree above
``subtree_rows`` is dealt out as pairs of shards, which together cover all its pairs.

The tries only say which links to check first. What they miss, and what their forests leave out, comes from an exact
path: in any one order of all shingles, two similar texts share one of the first ``n - ceil(similarity * n) + 1`` of
each. These prefixes are taken with the frequent shingles of a sample last (the sample changes the work, never the
result), and texts with a common shingle in both prefixes are a list. Pairs of a list whose sizes and places in the
prefix allow the similarity, and that checked links haven't joined yet, are offered in rounds of growing distance in
the list, until no pair is left. All links, of both kinds, are checked: first by sketches, counts of a text's shingles
by parts of the range of hashes, which bound from above what two texts may share, then exactly on the shingles of both.

Texts are told apart by a 64-bit hash of their set of shingles, the ``unit``.

Defined cases: a null text counts as empty, and texts without words are copies of each other; null ids take part, and a
class without any id has a null class id; repeated rows stay and share their class; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import greatest, picked, removed, shuffles_freed, rowwise, sliced, spread_join, written
from .simhash import AT_ONCE, BITS, SEED, classes, components, merge, trie_pairs, whole_groups

WIDTH = 5
SIMILARITY = 0.8
LANES = 4
WIDE = BITS * LANES
RECALL = 0.95
#: Unrelated fingerprints that share a subtree, about.
SHARING = 16
SUBTREE_ROWS = 8_000
#: Distance in a list up to which the first round pairs texts, and the factor from round to round.
FIRST, GROWTH = 32, 8
#: Frequent shingles that are known by name, and about as many texts as their sample has at least.
COMMON, SAMPLE = 1 << 16, 5_000
LIST_ROWS = 200_000
#: Units up to this number (some 40 bytes each, counted first) are broadcast.
BROADCAST_UNITS = 20_000
#: A sketch has at most two to this power parts.
SKETCH_BITS = 12

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def shingles(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct hashes of a UTF-8 text's shingles."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_digest
    join = b" ".join
    raw = b"".join([digest(join(words[k : k + width]), SEED) for k in range(max(1, len(words) - width + 1))])
    return np.unique(np.frombuffer(raw, ">u8").astype(np.uint64))


def unit_of(hashes: np.ndarray) -> int:
    """A hash of a set of shingles, as a signed 64-bit integer."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def prefix(hashes: np.ndarray, similarity: float, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The shingles of which two similar texts share one: rare ones by hash, then ``common`` ones by rank."""
    n = len(hashes)
    keep = n - math.ceil(similarity * n - 1e-9) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        known = common[at] == hashes
        if known.any():
            often = hashes[known]
            hashes = np.r_[hashes[~known], often[np.argsort(rank[at[known]])]]
    return hashes[:keep]


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """The bits set in over half of the hashes; each lane of 64 bits mixes the hashes anew."""
    if not len(hashes):
        return bytes(WIDE // 8)
    ones = np.zeros(WIDE, np.int64)
    with np.errstate(over="ignore"):
        for s in range(0, len(hashes), AT_ONCE):
            part = np.empty((len(hashes[s : s + AT_ONCE]), LANES), np.uint64)
            for lane in range(LANES):
                x = hashes[s : s + AT_ONCE] + _MIX[0] * np.uint64(lane + 1)
                x = (x ^ (x >> np.uint64(30))) * _MIX[1]
                x = (x ^ (x >> np.uint64(27))) * _MIX[2]
                part[:, lane] = x ^ (x >> np.uint64(31))
            ones += np.unpackbits(part.view(np.uint8), axis=1).sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes)).tobytes()


def differing(similarity: float) -> float:
    """The share of bits in which texts of that similarity differ."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def budget(bits: int, similarity: float, deviations: float) -> int:
    """Differing bits of ``bits`` that pairs at ``similarity`` keep within, up to some standard deviations."""
    p = differing(similarity)
    return math.ceil(bits * p + deviations * math.sqrt(bits * p * (1 - p)))


def plan(count: int, similarity: float = SIMILARITY, recall: float = RECALL) -> tuple[int, int]:
    """The depth of subtrees and the number of tables for ``count`` fingerprints."""
    depth = max(8, math.ceil(math.log2(max(count, 2) / SHARING)))
    hit = (1 - differing(similarity)) ** depth
    return depth, math.ceil(math.log(1 - recall) / math.log(1 - hit))


@lru_cache(maxsize=4096)
def drawn(table: int) -> np.ndarray:
    """The bits that a table draws, in its order."""
    return np.random.default_rng(table).permutation(WIDE)[:BITS]


def table_keys(fps: np.ndarray, table: int) -> np.ndarray:
    """The drawn bits of fingerprints given as rows of bits."""
    return np.ascontiguousarray(np.packbits(fps[:, drawn(table)], axis=1)).view(">u8").ravel().astype(np.uint64)


def least_forest(n: int, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Which links make up a spanning forest of least distances (ties: the links' order)."""
    order = np.argsort(d, kind="stable")
    a, b = a[order], b[order]
    label, chosen, live = np.arange(n), np.zeros(len(a), bool), np.arange(len(a))
    while True:
        la, lb = label[a[live]], label[b[live]]
        apart = la != lb
        live, la, lb = live[apart], la[apart], lb[apart]
        if not len(live):
            return order[chosen]
        best = np.full(n, len(a))
        np.minimum.at(best, la, live)
        np.minimum.at(best, lb, live)
        pick = np.unique(best[best < len(a)])
        chosen[pick] = True
        label = merge(label, a[pick], b[pick])


def two_forests(n: int, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
    first = least_forest(n, a, b, d)
    rest = np.setdiff1d(np.arange(len(a)), first)
    return np.r_[first, rest[least_forest(n, a[rest], b[rest], d[rest])]]


def subtree_links(keys: np.ndarray, words: np.ndarray, depth: int, near: int, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (a, b, distance) among fingerprints of one table whose first ``depth`` bits agree: two forests.

    ``keys``: the drawn bits; ``words``: all bits as rows of 64-bit words.
    """
    order = np.argsort(keys, kind="stable")
    unique, first, many = np.unique(keys[order], return_index=True, return_counts=True)
    # equal keys: each with the first and with the one before it
    rank = np.arange(len(keys)) - np.repeat(first, many)
    later, second = np.flatnonzero(rank > 0), np.flatnonzero(rank > 1)
    pairs = [(order[later - rank[later]], order[later]), (order[second - 1], order[second])]
    held: list[np.ndarray] = [np.zeros(0, np.int64)] * 3

    def reduce() -> None:
        nonlocal held, pairs
        a, b = (np.concatenate(x) for x in zip(*pairs))
        d = np.bitwise_count(words[a] ^ words[b]).sum(1, dtype=np.int64)
        ok = d <= wide
        held = [np.r_[h, x[ok]] for h, x in zip(held, (a, b, d))]
        if len(held[0]) > 4 * len(keys):
            keep = two_forests(len(keys), *held)
            held = [h[keep] for h in held]
        pairs = []

    count = len(later)
    for i, j in trie_pairs(unique, depth, near):
        pairs.append((order[first[i]], order[first[j]]))
        count += len(i)
        if count > 1 << 20:
            reduce()
            count = 0
    if pairs:
        reduce()
    keep = two_forests(len(keys), *held)
    return tuple(h[keep] for h in held)


_LINK = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType()), T.StructField("d", T.IntegerType())])


def _as_bytes(column: pa.Array) -> np.ndarray:
    """A binary column of fingerprints as rows of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, WIDE // 8)


def candidate_links(fps: DataFrame, count: int, similarity: float = SIMILARITY, recall: float = RECALL, subtree_rows: int = SUBTREE_ROWS) -> DataFrame:
    """Links (a, b) with their distance d between distinct fingerprints ``fp``, of which there are ``count``."""
    depth, tables = plan(count, similarity, recall)
    near, wide = budget(BITS, similarity, 3), budget(WIDE, similarity, 2)
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = T.StructType([T.StructField("place", T.LongType()), T.StructField("fp", T.BinaryType())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2_000):
                column = batch.column(0).slice(start, 2_000)
                bits = np.unpackbits(_as_bytes(column), axis=1)
                for t in range(tables):
                    block = table_keys(bits, t) >> np.uint64(BITS - depth)
                    yield pa.RecordBatch.from_arrays([pa.array((np.uint64(t << depth) | block).view(np.int64)), column], names=["place", "fp"])

    dealt = fps.select("fp").mapInArrow(deal, kind)
    large = dealt.groupBy("place").count().filter(F.col("count") > subtree_rows)
    shards = F.coalesce(F.ceil(F.col("count") / subtree_rows), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("s")).cast("int")
    both = F.transform(F.sequence(F.lit(0), F.col("s") - 1), lambda o: F.struct(F.least(own, o).alias("x"), F.greatest(own, o).alias("y")))
    alone = F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))
    dealt = dealt.join(large, "place", "left").select("place", "fp", shards.alias("s"))
    dealt = dealt.select("place", F.explode(F.when(F.col("s") == 1, alone).otherwise(both)).alias("p"), "fp").select("place", "p.x", "p.y", "fp")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = lambda b: [c.to_numpy(zero_copy_only=False) for c in b.columns[:3]] + [_as_bytes(b.column(3))]
        for place, x, y, fp in whole_groups((columns(b) for b in batches if b.num_rows), 3, 4 * subtree_rows):
            table = place.view(np.uint64) >> np.uint64(depth)
            group = np.flatnonzero(np.r_[True, (table[1:] != table[:-1]) | (((x != 0) | (y != 0))[1:] & ((place[1:] != place[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])))])
            for s, e in zip(group, np.r_[group[1:], len(place)]):
                keys = table_keys(np.unpackbits(fp[s:e], axis=1), int(table[s]))
                a, b, d = subtree_links(keys, np.ascontiguousarray(fp[s:e]).view(np.uint64), depth, near, wide)
                if len(a):
                    low, high = [fp[s + i].tobytes() for i in a], [fp[s + i].tobytes() for i in b]
                    pairs = [(p, q) if p < q else (q, p) for p, q in zip(low, high)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p for p, _ in pairs], pa.binary()), pa.array([q for _, q in pairs], pa.binary()), pa.array(d, pa.int32())], names=["a", "b", "d"]
                    )

    key = ["place", "x", "y"]
    return dealt.repartition(n, *key).sortWithinPartitions(*key).mapInArrow(join, _LINK)


def common_shingles(texts: DataFrame, count: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are frequent in a sample of about ``count`` texts, sorted, and their ranks from rare to frequent."""
    share = max(1, min(16, count // SAMPLE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in sliced(batch):
                found = np.concatenate([shingles(t, width) for t in b.column(0).to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["token"])

    sample = texts.filter(F.pmod("hash", F.lit(share)) == 0).select("text")
    often = sample.mapInArrow(run, "token long").groupBy("token").count().filter("count > 2").orderBy(F.desc("count"), "token").limit(COMMON)
    tokens = np.array([r.token for r in often.select("token").collect()], np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], len(tokens) - order


def prefix_lists(texts: DataFrame, similarity: float, width: int, common: np.ndarray, rank: np.ndarray) -> DataFrame:
    """(token, unit, place) for each shingle in the prefixes of two units or more; place is ``size << 32 | index``."""
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = T.StructType([T.StructField(c, T.LongType()) for c in ("token", "unit", "place")])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies within the task
        for batch in batches:
            for b in sliced(batch):
                tokens, units, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for t in b.column(0).to_pylist():
                    own = shingles(t, width)
                    unit = unit_of(own)
                    if unit in seen or not len(own):
                        continue
                    seen.add(unit)
                    first = prefix(own, similarity, common, rank)
                    tokens.append(first)
                    units.append(np.full(len(first), unit))
                    places.append((len(own) << 32) + np.arange(len(first)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(units)), pa.array(np.concatenate(places))], names=kind.names
                )

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ([c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows)
        for cols in whole_groups(columns, 1, LIST_ROWS):
            token, unit, _ = cols
            new = np.r_[True, (token[1:] != token[:-1]) | (unit[1:] != unit[:-1])]
            token, unit, place = (c[new] for c in cols)
            same = token[1:] == token[:-1]
            many = np.r_[False, same] | np.r_[same, False]
            if many.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[many]) for c in (token, unit, place)], names=kind.names)

    return texts.select("text").mapInArrow(deal, kind).repartition(n, "token").sortWithinPartitions("token", "unit").mapInArrow(shared, kind)


def offered(lists: DataFrame, roots: DataFrame, done: int, until: int, similarity: float) -> DataFrame:
    """Pairs (a, b) of different classes that may be similar and are over ``done``, at most ``until`` apart in a list."""
    n = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    roots = F.broadcast(roots) if roots.count() <= BROADCAST_UNITS else roots
    labelled = lists.join(roots, F.col("unit") == F.col("node"), "left").select("token", "place", "unit", F.coalesce("root", "unit").alias("label"))

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ([c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows)
        for token, place, unit, label in whole_groups(columns, 1, LIST_ROWS):
            size, index = place >> 32, place & 0xFFFFFFFF
            left = size - index
            live = np.arange(len(token))
            for apart in range(done + 1, until + 1):
                live = live[live + apart < len(token)] if apart > done + 1 else np.arange(max(0, len(token) - apart))
                live = live[(token[live] == token[live + apart]) & (size[live] >= similarity * size[live + apart] - 1e-9)]
                if not len(live):
                    break
                other = live + apart
                need = similarity / (1 + similarity) * (size[live] + size[other]) - 1e-9
                ok = (label[live] != label[other]) & (np.minimum(left[live], left[other]) >= need)
                if ok.any():
                    a, b = unit[live[ok]], unit[other[ok]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=kind.names)

    return labelled.repartition(n, "token").sortWithinPartitions("token", "place", "unit").mapInArrow(pair, kind).distinct()


def similar(rows: DataFrame, similarity: float, width: int) -> DataFrame:
    """Of rows (a, b, left text, right text) those whose texts have that similarity, without the texts."""
    kind = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in sliced(batch):
                keep = []
                for s, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                    x, y = shingles(s, width), shingles(t, width)
                    shared = len(np.intersect1d(x, y, assume_unique=True)) if min(len(x), len(y)) >= similarity * max(len(x), len(y)) else 0
                    keep.append(shared >= similarity * (len(x) + len(y) - shared))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, kind)


def sketch(hashes: np.ndarray) -> bytes:
    """How many hashes fall into each of about as many equal parts of their range as there are hashes."""
    bits = min(SKETCH_BITS, max(4, math.ceil(math.log2(max(1, len(hashes))))))
    counts = np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def may_be_similar(x: bytes, y: bytes, similarity: float) -> bool:
    """Whether two sketches leave open that the sets have that similarity: they share no more in any part of the range
    than the smaller count there. Sets with too many in one part have no sketch and are left open."""
    if not x or not y:
        return True
    p, q = np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)
    parts = min(len(p), len(q))
    p, q = p.reshape(parts, -1).sum(1), q.reshape(parts, -1).sum(1)
    shared = int(np.minimum(p, q).sum())
    return shared >= similarity * (int(p.sum()) + int(q.sum()) - shared) - 1e-9


def of_units(texts: DataFrame, distinct: DataFrame, pairs: DataFrame) -> DataFrame:
    """(unit, text) of the units in pairs (a, b), from the rows that stand for them; a repeated row comes repeatedly.

    Up to ``BROADCAST_UNITS`` units are broadcast; beyond that the texts are shuffled.
    """
    ends = pairs.select(F.col("a").alias("unit")).unionByName(pairs.select(F.col("b").alias("unit"))).distinct()
    needed, _ = written(ends.join(distinct, "unit").select("unit", F.col("id").alias("of"), F.col("hash").alias("of_hash")), "needed-units")
    if needed.count() <= BROADCAST_UNITS:
        needed = F.broadcast(needed)
    return texts.join(needed, F.col("id").eqNullSafe(F.col("of")) & (F.col("hash") == F.col("of_hash"))).select("unit", "text")


def left_open(texts: DataFrame, distinct: DataFrame, found: DataFrame, similarity: float, width: int) -> DataFrame:
    """Of pairs (a, b) of units those whose sketches don't rule the similarity out; texts stay where they are."""
    kind = T.StructType([T.StructField("unit", T.LongType()), T.StructField("sketch", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in sliced(batch):
                out = [sketch(shingles(t, width)) for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=kind.names)

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in sliced(batch):
                keep = [may_be_similar(x, y, similarity) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sketches, path = written(of_units(texts, distinct, found).mapInArrow(run, kind).groupBy("unit").agg(F.min("sketch").alias("sketch")), "sketches")
    x, y = (sketches.select(F.col("unit").alias(c), F.col("sketch").alias(f"{c}_sketch")) for c in ("a", "b"))
    both = found.join(x, "a").join(y, "b").select("a", "b", "a_sketch", "b_sketch")
    out, _ = written(both.mapInArrow(bound, T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b")])), "left-open")
    removed(found.sparkSession, path)
    return out


def checked(texts: DataFrame, distinct: DataFrame, pairs: DataFrame, similarity: float, width: int) -> tuple[DataFrame, str]:
    """Of pairs (a, b) of units those that are similar, written. Texts travel only for pairs that sketches leave open."""
    spark = texts.sparkSession
    found, found_path = written(pairs, "candidates")
    shuffles_freed(spark)
    found = left_open(texts, distinct, found, similarity, width)
    shuffles_freed(spark)
    wanted, wanted_path = written(of_units(texts, distinct, found).groupBy("unit").agg(F.min("text").alias("text")), "wanted-texts")
    left, right = (wanted.select(F.col("unit").alias(c), F.col("text").alias(f"{c}_text")) for c in ("a", "b"))
    out = written(similar(found.join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text"), similarity, width), "near-copies")
    removed(spark, found_path, wanted_path)
    return out


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """A row for each row of ``docs``: its id and ``component_id``, the least id of its class."""
    spark = docs.sparkSession
    texts = picked(docs, id=id_col, text=text_col).select("id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    texts = texts.select("id", F.xxhash64("text").alias("hash"), "text")
    schema = T.StructType([T.StructField("id", texts.schema["id"].dataType), T.StructField("hash", T.LongType()), T.StructField("fp", T.BinaryType()), T.StructField("unit", T.LongType())])

    def build():
        def step(b):
            sets = [shingles(t, width) for t in b.column(2).to_pylist()]
            return {"id": b.column(0), "hash": b.column(1), "fp": [wide_fingerprint(s) for s in sets], "unit": [unit_of(s) for s in sets]}

        return step

    rows, _ = written(rowwise(texts, schema, build), "wide-fingerprints")
    # the row that stands for a unit: of its rows with an id the one with the least
    distinct, _ = written(
        rows.groupBy("unit").agg(F.min("fp").alias("fp"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash")).alias("least"), F.count("*").alias("copies")).select("unit", "fp", "least.id", "least.hash", "copies"), "wide-distinct"
    )
    prints, prints_path = written(distinct.groupBy("fp").agg(F.min("unit").alias("unit"), F.count("*").alias("copies")), "wide-prints")
    count = prints.count()
    a, b = (prints.select(F.col("fp").alias(c), F.col("unit").alias(f"{c}_unit")) for c in ("a", "b"))
    near = candidate_links(prints, count, similarity, recall).select("a", "b").distinct().join(a, "a").join(b, "b").select(F.col("a_unit").alias("a"), F.col("b_unit").alias("b"))
    units = distinct.count()
    same = spread_join(distinct.select("fp", "unit"), prints.select("fp", F.col("unit").alias("a"), "copies"), "fp", units, greatest(prints))
    same = same.filter("unit <> a").select("a", F.col("unit").alias("b"))
    edges, _ = checked(texts, distinct, near.unionByName(same), similarity, width)
    removed(spark, prints_path)
    shuffles_freed(spark)
    roots, _ = components(edges)
    lists, lists_path = written(prefix_lists(texts, similarity, width, *common_shingles(texts, count, width)), "prefixes")
    shuffles_freed(spark)
    longest = lists.groupBy("token").count().agg(F.max("count")).first()[0] or 0
    done, until = 0, FIRST
    while done < longest - 1:
        more, _ = checked(texts, distinct, offered(lists, roots, done, until, similarity), similarity, width)
        shuffles_freed(spark)
        if more.take(1):
            edges = edges.unionByName(more)
            roots, _ = components(edges)
        done, until = until, until * GROWTH
    removed(spark, lists_path)
    linked = classes(roots, distinct.select(F.col("unit").alias("node"), F.col("id").alias("least")), units).withColumnRenamed("node", "unit")
    of_unit = distinct.join(linked, "unit", "left").select("unit", F.coalesce("component_id", "id").alias("component_id"), "copies")
    return spread_join(rows.select("id", "unit"), of_unit, "unit", rows.count(), greatest(distinct)).select(F.col("id").alias(id_col), "component_id")
