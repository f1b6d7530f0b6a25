"""Which pages are body text: a shape map, its reconciliation and a verdict, each with a default."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sieve(pages: DataFrame, shape: DataFrame, recon: DataFrame, verdict: DataFrame, key: Sequence[str], nonbody: Sequence[str], removing: Sequence[str], body: str = "BODY") -> DataFrame:
    """``pages`` with ``shape``, ``recon`` (both body where unknown), ``verdict`` (null where none) and ``category``."""
    out = pages.join(shape, list(key), "left").join(recon, list(key), "left").join(verdict, list(key), "left")
    out = out.withColumns({"shape": F.coalesce("shape", F.lit(body)), "recon": F.coalesce("recon", F.lit(body))})
    odd = F.col("shape").isin(*nonbody)
    category = (
        F.when(~odd & (F.col("recon") != "AMBIGUOUS"), "SHAPE_BODY")
        .when(F.col("recon") == "BODY", "RESCUED")
        .when(F.col("recon") == "NONBODY", "CONFIRMED")
        .when(F.col("verdict").isNull(), "AMB_FAILED")
        .when(F.col("verdict").isin(*removing), "AMB_REMOVED")
        .otherwise("AMB_BODY")
    )
    return out.withColumn("category", category)
