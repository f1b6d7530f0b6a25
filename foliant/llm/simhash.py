"""SimHash near-duplicates by a binary-trie self-join.

A text's fingerprint has 64 bits: bit b is 1 if it is set in over half of the XXH64 hashes (seed 42) of the
text's 3-word shingles, repeats included. Two fingerprints link at ``budget`` or fewer differing bits; classes
of duplicates are the connected components of these links.

The join runs over distinct fingerprints, so exact copies cost nothing. Of 64 bits cut into ``budget + 1``
blocks, two linked fingerprints agree in one block at least. Each fingerprint is therefore turned so that each
block in its turn stands first, and all with the same first block form one subtree of a binary trie. Within a
subtree, node pairs are traversed together from the top, differing bits are accumulated, and a pair of nodes is
dropped as soon as its sum is over the budget. Each subtree gives a spanning forest of its links, at most one
link for each of its fingerprints, and never all pairs. A subtree above ``subtree_rows`` is dealt out as pairs of
shards, which together cover all its pairs.

Defined cases: a null text counts as empty; texts without words have fingerprint 0, which links like any other;
null ids take part, and a class without any id has a null class id; repeated rows stay and share their class.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import greatest, picked, removed, rowwise, spread_join, written

BITS = 64
SEED = 42
SHINGLE = 3
#: Shingles whose bits are summed at once.
AT_ONCE = 1 << 15


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text, as a signed 64-bit integer."""
    words = (text or b"").lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    n = max(1, len(words) - width + 1)
    ends = ends[width - 1 :] or ends[-1:]
    digest = xxhash.xxh64_digest
    ones = np.zeros(BITS, np.int64)
    for k in range(0, n, AT_ONCE):
        raw = b"".join([digest(joined[s : e - 1], SEED) for s, e in zip(starts[k : min(n, k + AT_ONCE)], ends[k : k + AT_ONCE])])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """(id, fp) of each row."""
    rows = picked(docs, id=id_col, text=text_col).select("id", F.col("text").cast("binary").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("fp", T.LongType())])
    return rowwise(
        rows, schema, lambda: lambda b: {"id": b.column(0), "fp": [fingerprint(t, width) for t in b.column(1).to_pylist()]}
    )


# --- the trie self-join inside one task -------------------------------------------------------------


def trie_pairs(keys: np.ndarray, depth: int, budget: int, at_once: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of the sorted distinct ``keys`` that differ in at most ``budget`` bits.

    Only keys with the same first ``depth`` bits are paired. A node is a range of ``keys`` that share a prefix;
    the frontier holds node pairs of one depth with the bits in which their prefixes differ.
    """
    n = len(keys)
    if n < 2:
        return
    top = keys >> np.uint64(BITS - depth) if depth else np.zeros(n, np.uint64)
    cuts = np.flatnonzero(np.r_[True, top[1:] != top[:-1]])
    lo, hi = cuts, np.r_[cuts[1:], n]
    many = hi - lo > 1
    lo, hi = lo[many], hi[many]
    stack = [(depth, lo, hi, lo, hi, np.zeros(len(lo), np.int64))]
    while stack:
        depth, alo, ahi, blo, bhi, diff = stack.pop()
        if len(alo) > at_once:
            half = len(alo) // 2
            stack += [(depth, *(x[half:] for x in (alo, ahi, blo, bhi, diff))), (depth, *(x[:half] for x in (alo, ahi, blo, bhi, diff)))]
            continue
        size = (ahi - alo) * (bhi - blo)
        small = (size <= 8) | (depth == BITS)
        if small.any():
            yield from _leaf_pairs(keys, alo[small], ahi[small], blo[small], bhi[small], budget)
            alo, ahi, blo, bhi, diff = (x[~small] for x in (alo, ahi, blo, bhi, diff))
        if not len(alo):
            continue
        bit = np.uint64(1 << (BITS - 1 - depth))
        keep = np.uint64((1 << BITS) - (1 << (BITS - depth))) if depth else np.uint64(0)
        amid = np.clip(np.searchsorted(keys, (keys[alo] & keep) | bit), alo, ahi)
        bmid = np.clip(np.searchsorted(keys, (keys[blo] & keep) | bit), blo, bhi)
        own = alo == blo  # a node with itself: its (1, 0) children repeat (0, 1)
        parts = [
            (alo, amid, blo, bmid, diff, None),
            (amid, ahi, bmid, bhi, diff, None),
            (alo, amid, bmid, bhi, diff + 1, None),
            (amid, ahi, blo, bmid, diff + 1, ~own),
        ]
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        for a0, a1, b0, b1, d, also in parts:
            live = (a1 > a0) & (b1 > b0) & (d <= budget) & ~((a0 == b0) & (a1 - a0 < 2))
            if also is not None:
                live &= also
            for o, x in zip(out, (a0, a1, b0, b1, d)):
                o.append(x[live])
        nxt = [np.concatenate(o) for o in out]
        if len(nxt[0]):
            stack.append((depth + 1, *nxt))


def _leaf_pairs(keys, alo, ahi, blo, bhi, budget):
    """The pairs below small node pairs, verified on all bits."""
    na, nb = ahi - alo, bhi - blo
    for x in range(int(na.max())):
        for y in range(int(nb.max())):
            i, j = alo + x, blo + y
            ok = (x < na) & (y < nb) & (i < j)
            i, j = i[ok], j[ok]
            near = np.bitwise_count(keys[i] ^ keys[j]) <= budget
            if near.any():
                yield i[near], j[near]


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels (the least index of each component) after also linking a[k] with b[k]."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        parent = np.arange(len(label))
        np.minimum.at(parent, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        label = parent[label]


def forest(keys: np.ndarray, depth: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of the links among ``keys``: (member, least member)."""
    label = np.arange(len(keys))
    for i, j in trie_pairs(keys, depth, budget):
        label = merge(label, i, j)
    own = np.flatnonzero(label != np.arange(len(keys)))
    return keys[own], keys[label[own]]


def _turn(keys: np.ndarray, by: int) -> np.ndarray:
    """Bits rotated to the left."""
    return keys if by == 0 else (keys << np.uint64(by)) | (keys >> np.uint64(BITS - by))


# --- the distributed join --------------------------------------------------------------------------

LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def links(fps: DataFrame, budget: int = 3, subtree_rows: int = 20_000, partitions: int | None = None) -> DataFrame:
    """Links (a, b) whose connected components are those of all links at ``budget`` or fewer differing bits.

    ``fps``: distinct fingerprints in a column ``fp``, as a table that can be read twice.
    """
    spark = fps.sparkSession
    blocks = budget + 1
    width = BITS // blocks
    turned = _turned(fps, blocks, width)
    sizes = turned.groupBy("turn", "block").count().filter(F.col("count") > subtree_rows)
    shards = F.coalesce(F.ceil(F.col("count") / subtree_rows), F.lit(1)).cast("int")
    dealt = turned.join(sizes, ["turn", "block"], "left").select("turn", "block", "fp", shards.alias("s"))
    own = F.pmod(F.xxhash64("fp"), F.col("s")).cast("int")
    dealt = dealt.select(
        "turn",
        "block",
        "fp",
        F.explode(
            F.when(F.col("s") == 1, F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))).otherwise(
                F.transform(F.sequence(F.lit(0), F.col("s") - 1), lambda o: F.struct(F.least(own, o).alias("x"), F.greatest(own, o).alias("y")))
            )
        ).alias("p"),
    ).select("turn", "block", "p.x", "p.y", "fp")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = ["turn", "block", "x", "y"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ([c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches)
        for turn, block, x, y, fp in whole_groups(columns, 4, subtree_rows):
            keys = fp.view(np.uint64)
            out_a, out_b = [], []
            # rows are sorted by group; one trie for all groups of a turn that aren't sharded, else one for each group
            sharded = (x != 0) | (y != 0)
            for k in np.unique(turn[~sharded]):
                turned = np.unique(_turn(keys[(turn == k) & ~sharded], int(k) * width))
                a, b = forest(turned, width, budget)
                out_a.append(_turn(a, (BITS - int(k) * width) % BITS))
                out_b.append(_turn(b, (BITS - int(k) * width) % BITS))
            if sharded.any():
                at = np.flatnonzero(sharded)
                change = np.flatnonzero(np.r_[True, np.any([v[at][1:] != v[at][:-1] for v in (turn, block, x, y)], axis=0)])
                for s, e in zip(change, np.r_[change[1:], len(at)]):
                    a, b = forest(np.unique(keys[at[s:e]]), 0, budget)
                    out_a.append(a)
                    out_b.append(b)
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).view(np.int64)) for v in (out_a, out_b)], names=["a", "b"])

    return dealt.repartition(n, *key).sortWithinPartitions(*key).mapInArrow(join, LINK)


def _turned(fps: DataFrame, blocks: int, width: int) -> DataFrame:
    block = lambda k: F.shiftrightunsigned(F.shiftleft("fp", k * width), BITS - width)
    each = F.array(*(F.struct(F.lit(k).alias("turn"), block(k).alias("block")) for k in range(blocks)))
    return fps.select(F.explode(each).alias("t"), "fp").select("t.*", "fp")


def whole_groups(batches: Iterator[list[np.ndarray]], keys: int, rows: int) -> Iterator[list[np.ndarray]]:
    """Runs of sorted rows, given and returned by column, of about ``rows`` rows or one group.

    Groups have equal values in the first ``keys`` columns; runs are cut only between groups.
    """
    held: list[list[np.ndarray]] = []
    count = 0
    for cols in batches:
        held.append(cols)
        count += len(cols[0])
        if count < rows:
            continue
        cols = [np.concatenate(c) for c in zip(*held)]
        same = np.all([c == c[-1] for c in cols[:keys]], axis=0)
        cut = len(same) if same.all() else int(np.flatnonzero(~same)[-1]) + 1
        if same.all():  # one group so far: more of it may come
            held, count = [cols], 0
            continue
        yield [c[:cut] for c in cols]
        held = [[c[cut:] for c in cols]]
        count = len(same) - cut
    if held:
        cols = [np.concatenate(c) for c in zip(*held)]
        if len(cols[0]):
            yield cols


# --- connected components --------------------------------------------------------------------------


def components(edges: DataFrame, most_rounds: int = 50) -> tuple[DataFrame, list[str]]:
    """(node, root) for each node of ``edges`` (a, b); the root is the least node of the component.

    Alternating large-star and small-star rounds, each written to the shared folder. A hub's edges are spread over
    tasks. Also gives the paths that the result reads.
    """
    spark = edges.sparkSession
    at, path = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    for _ in range(most_rounds):
        now = at.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        edges_both = 2 * now[0]
        both = at.unionByName(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("copies"))
        large = spread_join(both, least, "u", edges_both, greatest(least)).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large, large_path = written(large.filter("u <> v").distinct(), "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("copies"))
        small = spread_join(large, low, "u", edges_both, greatest(low))
        small = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        nxt, nxt_path = written(small.filter("u <> v").distinct(), "links")
        removed(spark, path, large_path)
        at, path = nxt, nxt_path
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    # every edge is now (member, root)
    return at.select(F.col("u").alias("node"), F.col("v").alias("root")), [path]


def classes(roots: DataFrame, least: DataFrame, nodes: int) -> DataFrame:
    """(node, component_id) for each member of a component; ``least`` has the least id of each node."""
    # a root is a node of its component too
    members = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    ids = members.join(least, "node").groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("copies"))
    return spread_join(members, ids, "root", nodes, greatest(ids)).select("node", "component_id")


# --- the operator ----------------------------------------------------------------------------------


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE,
    budget: int = 3,
    subtree_rows: int = 20_000,
) -> DataFrame:
    """A row for each row of ``docs``: its id, ``fingerprint`` (16 hex digits) and ``component_id``."""
    spark = docs.sparkSession
    rows, _ = written(fingerprints(docs, id_col, text_col, width), "fingerprints")
    distinct, _ = written(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("copies")), "distinct")
    found, found_path = written(links(distinct.select("fp"), budget, subtree_rows), "found")
    roots, _ = components(found)
    removed(spark, found_path)
    # copies of a fingerprint and members of a class are spread over tasks
    of_fp = distinct.join(classes(roots, distinct.select(F.col("fp").alias("node"), "least"), distinct.count()), F.col("fp") == F.col("node"), "left")
    of_fp = of_fp.select("fp", F.coalesce("component_id", "least").alias("component_id"), "copies")
    return spread_join(rows, of_fp, "fp", rows.count(), greatest(distinct)).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
