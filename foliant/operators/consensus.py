"""Consensus of several readings of a page: a spine, alignment to it, and a vote at each of its places.

All but the alignment of one reading to one spine are joins and groupings, so a page's readings needn't meet in one
task with those of others.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.text import tokens, vote_key


def readings(df: DataFrame, page: str, reader: str, text: str) -> DataFrame:
    """(page, reader, toks) of readings with any token."""
    rows = df.select(F.col(page).alias("page"), F.col(reader).alias("reader"), tokens(F.col(text)).alias("toks"))
    return rows.filter(F.size("toks") > 0)


def spines(read: DataFrame) -> DataFrame:
    """For each page the reading nearest to the median count of tokens: then more tokens, more characters, the reader."""
    median = read.groupBy("page").agg(F.median(F.size("toks")).alias("m"), F.count("*").alias("readers"))
    order = F.struct(F.abs(F.size("toks") - F.col("m")), -F.size("toks"), -F.length(F.array_join("toks", "")), "reader")
    return read.join(median, "page").groupBy("page").agg(F.min_by("reader", order).alias("spine"), F.min_by("toks", order).alias("spine_toks"), F.max("readers").alias("readers"))


def merged_splits(spine: DataFrame, read: DataFrame) -> DataFrame:
    """Spines whose neighbouring tokens are joined where two other readings or more have them as one word.

    Pairs are taken from left to right, and a joined token isn't joined again.
    """
    keys = read.select("page", "reader", F.explode("toks").alias("tok")).select("page", "reader", vote_key(F.col("tok")).alias("key"), "tok")
    pairs = spine.select("page", "spine", F.posexplode("spine_toks").alias("pos", "tok"))
    nxt = F.lead("tok").over(Window.partitionBy("page").orderBy("pos"))
    pairs = pairs.withColumn("next", nxt).filter("next IS NOT NULL").select("page", "spine", "pos", F.concat(vote_key(F.col("tok")), vote_key(F.col("next"))).alias("key"), vote_key(F.col("tok")).alias("k1"), vote_key(F.col("next")).alias("k2"))
    held = pairs.filter("k1 <> '' AND k2 <> ''").join(keys, ["page", "key"]).filter("reader <> spine")
    sure = held.groupBy("page", "pos").agg(F.count_distinct("reader").alias("n"), F.min_by("tok", "reader").alias("whole")).filter("n >= 2")
    # of a run of joinable pairs every other one, from the first
    run = F.col("pos") - F.row_number().over(Window.partitionBy("page").orderBy("pos"))
    sure = sure.withColumn("run", run).withColumn("k", F.row_number().over(Window.partitionBy("page", "run").orderBy("pos"))).filter("k % 2 = 1")
    joins = sure.groupBy("page").agg(F.map_from_entries(F.collect_list(F.struct("pos", "whole"))).alias("whole_at"))
    at = F.transform("spine_toks", lambda t, k: F.when(F.element_at("whole_at", k).isNotNull(), F.element_at("whole_at", k)).when(F.element_at("whole_at", k - 1).isNotNull(), F.lit(None)).otherwise(t))
    out = spine.join(joins, "page", "left")
    return out.withColumn("spine_toks", F.when(F.col("whole_at").isNull(), F.col("spine_toks")).otherwise(F.array_compact(at))).drop("whole_at")


def places(spine: list[str], other: list[str]) -> Iterator[tuple[int, int, int]]:
    """(place in the spine, rank among what is inserted before it, or -1 at the place itself, place in the other).

    Stretches that both have in common stand at their places. What lies between two of them is paired off in order,
    and words of the other that are left over hang before the place at which the next stretch begins.
    """
    here, there = 0, 0
    for block in difflib.SequenceMatcher(None, spine, other, autojunk=False).get_matching_blocks():
        paired = min(block.a - here, block.b - there)
        for k in range(paired):
            yield here + k, -1, there + k
        for rank, place in enumerate(range(there + paired, block.b)):
            yield block.a, rank, place
        for k in range(block.size):
            yield block.a + k, -1, block.b + k
        here, there = block.a + block.size, block.b + block.size


#: Readings that are aligned at once, and rows of aligned tokens that are returned at once.
ROWS, AT_ONCE = 64, 1 << 14


def aligned(rows: DataFrame) -> DataFrame:
    """(page, reader, place, rank, tok) from rows with the keys of spine and reading.

    What is held is a batch as it came, the words of ``ROWS`` readings, and ``AT_ONCE`` rows of the result.
    """
    schema = T.StructType([rows.schema["page"], rows.schema["reader"], T.StructField("place", T.IntegerType()), T.StructField("rank", T.IntegerType()), T.StructField("tok", T.StringType())])
    arrow = to_arrow_schema(schema)

    def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All words of some rows, and where each row's begin."""
        return column.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (batch.slice(k, ROWS) for batch in batches for k in range(0, batch.num_rows, ROWS)):
            (spine, s), (keys, n) = words(b.column("spine_keys")), words(b.column("keys"))
            each = ((k, place, rank, n[k] + at) for k in range(b.num_rows) for place, rank, at in places(spine[s[k] : s[k + 1]].tolist(), keys[n[k] : n[k + 1]].tolist()))
            toks = b.column("toks").flatten()  # a key for each
            while some := list(islice(each, AT_ONCE)):
                row, place, rank, at = (pa.array(c, pa.int32()) for c in zip(*some))
                yield pa.RecordBatch.from_arrays([b.column("page").take(row), b.column("reader").take(row), place, rank, toks.take(at)], schema=arrow)

    return rows.select("page", "reader", "toks", "spine_keys", "keys").mapInArrow(run, schema)


def consensus(df: DataFrame, page: str, reader: str, text: str, agreeing: int = 2) -> DataFrame:
    """A row for each page: ``text``, ``n_tokens``, ``confidence``, ``agreement`` and ``method``.

    A place's word is the one most readings have (ties: the first reader's); what isn't in the spine needs ``agreeing``
    readings. One reading alone has a confidence of a third and no agreement.
    """
    read = readings(df, page, reader, text)
    spine = merged_splits(spines(read), read)
    rows = read.join(spine, "page").select("page", "reader", "toks", F.transform("spine_toks", vote_key).alias("spine_keys"), F.transform("toks", vote_key).alias("keys"))
    found = aligned(rows).withColumn("key", vote_key(F.col("tok")))
    votes = found.groupBy("page", "place", "rank", "key").agg(F.count_distinct("reader").alias("n"), F.min("reader").alias("first"), F.min_by("tok", "reader").alias("tok"))
    won = votes.groupBy("page", "place", "rank").agg(F.min_by(F.struct("tok", "n"), F.struct(-F.col("n"), "first", "key")).alias("w"), F.sum("n").alias("present"))
    won = won.filter((F.col("rank") < 0) | (F.col("w.n") >= agreeing))
    out = won.groupBy("page").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", F.when(F.col("rank") < 0, 1 << 30).otherwise(F.col("rank")).alias("rank"), F.col("w.tok").alias("tok")))), lambda x: x["tok"]), " ").alias("text"),
        F.count("*").alias("n_tokens"),
        F.avg(F.col("w.n") / F.col("present")).alias("confidence"),
        F.avg((F.col("w.n") >= 2).cast("double")).alias("agreement"),
    )
    alone = F.col("readers") == 1
    return out.join(spine.select("page", "readers"), "page").select(
        F.col("page").alias(page),
        "text",
        "n_tokens",
        F.when(alone, 0.3333).otherwise(F.round("confidence", 4)).alias("confidence"),
        F.when(alone, 0.0).otherwise(F.round("agreement", 4)).alias("agreement"),
        F.when(alone, "single").otherwise("vote").alias("method"),
    )


def positional_vote(df: DataFrame, page: str, reader: str, text: str) -> DataFrame:
    """The vote without alignment: readings agree at equal positions (ties: the least key)."""
    read = readings(df, page, reader, text).select("page", "reader", F.posexplode("toks").alias("pos", "tok")).withColumn("key", vote_key(F.col("tok")))
    votes = read.groupBy("page", "pos", "key").agg(F.count("*").alias("n"))
    return votes.groupBy("page", "pos").agg(F.min_by("key", F.struct(-F.col("n"), "key")).alias("key"), F.max("n").alias("n_agree"), F.sum("n").alias("n_present"))
