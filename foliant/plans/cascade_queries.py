"""The correction cascade over the documents, words of nine letters or more broken in two."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cascade as C
from ..operators import tokens as T
from ..registry import query, table
from ..sources.paths import stored
from .token_queries import docs, vocab_known


def cascaded(spark, sf):
    v, known = vocab_known(spark, sf)
    words = C.Lexicon.of(known, v)
    broken = F.regexp_replace("text", r"(\p{L}{4})(\p{L}{5,})", "$1 $2")
    texts = table(spark, sf, "documents").select(F.floor(F.col("doc_id") / 20).alias("volume"), (F.col("doc_id") % 20).alias("page"), broken.alias("text"))
    return C.cascade(C.pages_of(texts, "volume", "page"), words, stored(T.bigrams(docs(spark, sf), known), "bigrams"))


@query("c02_cascade")
def c02_cascade(spark, sf):
    """Each stage's flagged words, all words and number of changes; tested against brute force."""
    _, audit, rates = cascaded(spark, sf)
    stage = F.when(F.col("kind").startswith("reunify"), "reunify").when(F.col("kind") == "autocorrect_e1", "autocorrect").otherwise(F.col("kind"))
    changes = audit.filter("kind <> 'context_weak'").groupBy(stage.alias("stage")).agg(F.count("*").alias("changes"))
    return rates.join(changes, "stage", "left").select("stage", "flagged", "tokens", F.coalesce("changes", F.lit(0)).alias("changes"))


def context_lists(spark, sf):
    v, known = vocab_known(spark, sf)
    texts = table(spark, sf, "documents").select(F.floor(F.col("doc_id") / 20).alias("volume"), (F.col("doc_id") % 20).alias("page"), "text")
    return C.context_lists(C.pages_of(texts, "volume", "page"), C.Lexicon.of(known, v), stored(T.bigrams(docs(spark, sf), known), "bigrams"))


@query("c20_no_context")
def c20_no_context(spark, sf):
    """Tested on small pages."""
    return context_lists(spark, sf)[0]


@query("c20_context_weak")
def c20_context_weak(spark, sf):
    """Tested on small pages."""
    return context_lists(spark, sf)[1]


@query("c03_three_passes")
def c03_three_passes(spark, sf):
    """Flagged words before and after each pass, words of nine letters or more broken by a hyphen at a line's end; tested
    on small pages."""
    v, known = vocab_known(spark, sf)
    broken = F.regexp_replace("text", r"(\p{L}{4})(\p{L}{5,})", "$1-\n$2")
    texts = table(spark, sf, "documents").select(F.floor(F.col("doc_id") / 20).alias("volume"), (F.col("doc_id") % 20).alias("page"), broken.alias("text"))
    return C.three_passes(texts, C.Lexicon.of(known, v), "volume", "page")[2]
