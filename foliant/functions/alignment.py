"""Alignments of two texts, which no built-in function gives: one pair at a time in Arrow batches."""

from __future__ import annotations

import difflib
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import vote_key

DIFF = T.ArrayType(T.StructType([T.StructField("op", T.StringType()), T.StructField("tokens", T.ArrayType(T.StringType()))]))


@F.pandas_udf(T.StringType())
def composed(text: pd.Series) -> pd.Series:
    """Unicode's composed form (NFC)."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(DIFF)
def token_diff(old: pd.Series, new: pd.Series) -> pd.Series:
    """Runs of tokens that are ``equal``, ``delete`` (of old only) or ``insert`` (of new only), in order.

    A null array counts as empty.
    """

    def runs(a, b):
        a, b = list(a if a is not None else ()), list(b if b is not None else ())
        for kind, a0, a1, b0, b1 in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
            if kind == "equal":
                yield {"op": "equal", "tokens": a[a0:a1]}
                continue
            if a0 < a1:
                yield {"op": "delete", "tokens": a[a0:a1]}
            if b0 < b1:
                yield {"op": "insert", "tokens": b[b0:b1]}

    return pd.Series([list(runs(a, b)) for a, b in zip(old, new)])


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def wrong_places(gold: pd.Series, read: pd.Series) -> pd.Series:
    """Positions from 0 of gold keys that the reading doesn't have at the aligned place."""

    def wrong(a, b):
        a, b = list(a if a is not None else ()), list(b if b is not None else ())
        right = {a0 + k for a0, _, size in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() for k in range(size)}
        return [k for k in range(len(a)) if k not in right]

    return pd.Series([wrong(a, b) for a, b in zip(gold, read)])


def token_errors(gold: Column, read: Column) -> Column:
    """Positions of gold tokens that a reading has wrong or lacks; case and punctuation around tokens don't count."""
    return wrong_places(F.transform(gold, vote_key), F.transform(read, vote_key))


@F.pandas_udf(T.IntegerType())
def swap_distance(a: pd.Series, b: pd.Series, most: pd.Series) -> pd.Series:
    """Edits with swaps of neighbours, no place edited twice; ``most`` + 1 if there are more than ``most``."""

    def distance(x, y, k):
        if x is None or y is None:
            return None
        if abs(len(x) - len(y)) > k:
            return k + 1
        before, row = [], list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            before, above, row = row, before, [i]
            for j, d in enumerate(y, 1):
                best = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (c != d))
                if i > 1 and j > 1 and c == y[j - 2] and d == x[i - 2]:
                    best = min(best, above[j - 2] + 1)
                row.append(best)
            if min(row) > k and min(before) > k:
                return k + 1
        return min(row[-1], k + 1)

    return pd.Series([distance(x, y, k) for x, y, k in zip(a, b, most)], dtype="Int32")


SPAN = T.StructType([T.StructField("span", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("distance", T.IntegerType())])


def nearest_span(gold: str, text: str) -> tuple[int, int, int]:
    """(start, end, distance) of the stretch of ``text`` with the fewest edits to ``gold``; of equal ones the longest, then
    the first.

    One pass over the table of edit distances in which a stretch may begin anywhere: no window sizes or steps are
    tried, so no better stretch is missed. An entry is the distance times ``edit`` plus the first start that has it.
    """
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    place, edit = np.arange(len(codes) + 1), len(codes) + 1
    row = place.copy()
    for k, c in enumerate(np.frombuffer(gold.encode("utf-32-le"), np.uint32), 1):
        new = np.r_[k * edit, np.minimum(row[:-1] + edit * (codes != c), row[1:] + edit)]
        # characters of the text that gold lacks: each costs one more than the place before
        row = np.minimum.accumulate(new - edit * place) + edit * place
    distance, start = row // edit, row % edit
    end = int(np.lexsort((start - place, distance))[0])
    return int(start[end]), end, int(distance[end])


@F.pandas_udf(SPAN)
def best_span(gold: pd.Series, text: pd.Series) -> pd.DataFrame:
    """The stretch of a text that is nearest to ``gold``, where it begins, and its edits; null if one is null."""
    rows = []
    for g, t in zip(gold, text):
        if g is None or t is None:
            rows.append((None, None, None))
        else:
            s, e, d = nearest_span(g, t)
            rows.append((t[s:e], s, d))
    return pd.DataFrame(rows, columns=SPAN.names).astype({"start": "Int32", "distance": "Int32"})


GARBLES = T.StructType([T.StructField(c, T.IntegerType()) for c in ("slivers", "splits", "initials", "doubles", "total")])


def with_garbles(df: DataFrame, gold: Column, read: Column, name: str = "garbles") -> DataFrame:
    """``df`` with what a reading has twice or in pieces beside gold's tokens, as a struct of :data:`GARBLES`; case and
    punctuation around tokens don't count, a null array counts as empty.

    Each pair of neighbours in the reading has at most one signature, from what its words are to gold:

    * ``doubles``: a word twice in a row that gold never has so;
    * ``splits``: put together they are one of gold's words, and not both are gold's themselves; ``initials`` are those
      that begin with a lone character which isn't gold's;
    * ``slivers``: one is gold's, and the other, of two characters or more and not gold's, begins or ends it.

    A word counts in one split or sliver only: signatures are taken from left to right.
    """
    keys = lambda c: F.coalesce(F.transform(c, vote_key), F.array().cast("array<string>"))
    pairs = lambda c: F.zip_with(F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, 2, F.size(c)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    own = df.withColumns({"gold_": keys(gold), "read_": keys(read)})
    repeated = F.transform(F.filter(pairs(F.col("gold_")), lambda p: p["a"] == p["b"]), lambda p: p["a"])
    own = own.withColumns({"known_": F.array_remove(F.array_distinct("gold_"), ""), "repeated_": repeated, "pairs_": pairs(F.col("read_"))})
    known = lambda w: F.array_contains("known_", w)

    def signed(p: Column) -> Column:
        a, b = p["a"], p["b"]
        in_a, in_b = known(a), known(b)
        piece = lambda x, x_known, y, y_known: (F.length(x) >= 2) & ~x_known & y_known & (y.startswith(x) | y.endswith(x))
        sign = F.when((a == "") | (b == ""), None).when(~(in_a & in_b) & known(F.concat(a, b)), "split").when(piece(b, in_b, a, in_a), "right").when(piece(a, in_a, b, in_b), "left")
        return F.struct(sign.alias("sign"), ((F.length(a) == 1) & ~in_a).alias("initial"), ((a != "") & (a == b) & ~F.array_contains("repeated_", a)).alias("double"))

    own = own.withColumn("signs_", F.transform("pairs_", signed))
    # which signatures are taken: none whose left word is used by the pair before
    start = F.struct(F.lit(False).alias("used"), F.array().cast("array<boolean>").alias("taken"))

    def step(acc: Column, s: Column) -> Column:
        taken = ~acc["used"] & s["sign"].isNotNull()
        return F.struct(F.coalesce(taken & s["sign"].isin("split", "right"), F.lit(False)).alias("used"), F.concat(acc["taken"], F.array(taken)).alias("taken"))

    own = own.withColumn("taken_", F.aggregate("signs_", start, step)["taken"])
    own = own.withColumn("signs_", F.zip_with("signs_", "taken_", lambda s, t: F.struct(F.when(t, s["sign"]).alias("sign"), s["initial"], s["double"])))
    count = lambda test: F.size(F.filter("signs_", test))
    own = own.withColumns(
        {
            "slivers_": count(lambda s: s["sign"].isin("left", "right")),
            "splits_": count(lambda s: s["sign"] == "split"),
            "initials_": count(lambda s: (s["sign"] == "split") & s["initial"]),
            "doubles_": count(lambda s: s["double"]),
        }
    )
    total = F.col("slivers_") + F.col("splits_") + F.col("doubles_")
    counts = F.struct(*(F.col(f"{c}_").alias(c) for c in GARBLES.names[:-1]), total.alias("total"))
    return own.select(*df.columns, counts.alias(name))
