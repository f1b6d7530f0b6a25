"""A corpus pipeline in five stages, each over all documents that the one before kept.

quality classifier -> SimHash near-dedup -> benchmark decontamination -> PII -> BPE encoding and decoding.
Each stage's result is written as Parquet and read again as the next one's documents. All but the last return the
columns of ``documents``.

Defined cases, in every stage: a null text counts as empty; rows are judged one by one, also where ids are null or
repeated; further columns are dropped whatever their names; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm import bpe, decontaminate, near_copies, pii, quality_classifier
from foliant.llm.common import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: What a worker remembers of encoded pieces: less than alone, since it outlives the stage and other stages need memory.
REMEMBERED_BYTES = 8 << 20


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on these documents' labels, doesn't reject; all, where there are no labels
    of both kinds."""
    docs = docs.select(*COLUMNS)
    model = quality_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.kept(docs, model)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a ``key`` of each row's own: the order of keys is that of ids, null ids last, then stored places.

    Ids are ordered as integers or, if they are of another type, as texts by code point.
    """
    number = lambda c: F.lpad(F.hex(c), 16, "0")
    # integers in the order of their hex digits; texts in that of their bytes', each with a lesser character behind
    whole = isinstance(docs.schema["doc_id"].dataType, T.IntegralType)
    of_id = number(F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(2**63)))) if whole else F.concat(F.hex(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(" "))
    of_id = F.coalesce(F.concat(F.lit("0"), of_id), F.lit("1"))
    place = (number(F.xxhash64("_metadata.file_path")), number(F.col("_metadata.row_index")))
    return docs.select(*COLUMNS, F.concat(of_id, *place).alias("key"))


def stored(docs: DataFrame) -> DataFrame:
    """``docs`` if it is a stored table, else written as one."""
    return docs if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation" else written(docs, "stage-input")[0]


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the least id, of each class of texts with a similarity of 0.8 or more in five-word shingles.

    Tries over SimHash bits say which texts to compare first; an exact join by shingles finds what they miss, so that
    classes are exact. Empty texts are one class.
    """
    docs = keyed(stored(docs))
    classes = near_copies.near_copies(docs, "key")
    later = classes.filter("key <> component_id").select("key")
    return docs.join(later, "key", "left_anti").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no passage of the benchmark, within the operator's budget of edits."""
    docs = keyed(stored(docs))
    found, _ = written(decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "key").select("key").distinct(), "contaminated")
    return docs.join(found, "key", "left_anti").select(*COLUMNS)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in them replaced by its kind; null texts stay null."""
    return pii.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of each document's tokens and decoded text."""
    return bpe.bpe_roundtrip(docs, with_ids=False, remembered=REMEMBERED_BYTES)


STAGES = [
    ("quality classifier", keep_quality),
    ("near-dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("bpe", encode),
]

#: SQL can't express fingerprints, a fitted classifier or tokens; tests compare run() to a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs, _ = written(docs, f"stage-{k + 1}")
    return docs
