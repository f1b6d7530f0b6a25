"""Consensus of readings: the turns of a conversation stand in for readers of one page."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import consensus
from ..registry import query, table

#: A phrase as three readers have it: the wrong split is in one of them, and one misreads a word.
READ = (
    (1, "a", "Sealer of Weights and Measures"),
    (1, "b", "Sealer of W eights and Measures"),
    (1, "c", "Sealer of Weights and Measures"),
    (2, "a", "fixing the time"),
    (2, "b", "fixing the lime"),
    (2, "c", "firing the time"),
    (3, "a", "one reader only"),
    (4, "a", "the Act shall take effect"),
    (4, "b", "the Act shall not take effect"),
    (4, "c", "the Act shall not take effect"),
)
_CHARS = " .,;:!?\"'`()[]{}"


@query(
    "c01_consensus",
    """SELECT * FROM (VALUES (1, 'Sealer of Weights and Measures', 5, 'vote'), (2, 'fixing the time', 3, 'vote'), (3, 'one reader only', 3, 'single'),
 (4, 'the Act shall not take effect', 6, 'vote')) AS x(page, text, n_tokens, method)""",
)
def c01_consensus(spark, sf):
    df = spark.createDataFrame(list(READ), "page int, reader string, text string")
    return consensus.consensus(df, "page", "reader", "text").select("page", "text", F.col("n_tokens").cast("int").alias("n_tokens"), "method")


@query("c01_consensus_of_turns")
def c01_consensus_of_turns(spark, sf):
    return consensus.consensus(table(spark, sf, "conversations"), "conv_id", "turn", "text")


@query(
    "c01b_vote",
    f"""WITH t AS (SELECT conv_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS toks FROM conversations),
p AS (SELECT conv_id, unnest(toks) AS tok, generate_subscripts(toks, 1) - 1 AS pos FROM t),
k AS (SELECT conv_id, pos, lower(trim(tok, '{_CHARS.replace("'", "''")}')) AS key, count(*) AS n FROM p GROUP BY ALL)
SELECT conv_id, CAST(pos AS INT) AS pos, first(key ORDER BY n DESC, key) AS key, max(n) AS n_agree, CAST(sum(n) AS BIGINT) AS n_present FROM k GROUP BY conv_id, pos""",
)
def c01b_vote(spark, sf):
    return consensus.positional_vote(table(spark, sf, "conversations"), "conv_id", "turn", "text").select(F.col("page").alias("conv_id"), "pos", "key", "n_agree", "n_present")


@query("d14_single_reader", "SELECT count(*) AS n_single, CAST(0 AS BIGINT) AS n_wrong FROM (SELECT conv_id FROM conversations WHERE regexp_matches(text, '\\S') GROUP BY conv_id HAVING count(*) = 1)")
def d14_single_reader(spark, sf):
    """One reading alone never has full confidence."""
    c = consensus.consensus(table(spark, sf, "conversations"), "conv_id", "turn", "text").filter("method = 'single'")
    return c.agg(F.count("*").alias("n_single"), F.count_if(F.col("confidence") >= 1).alias("n_wrong"))
