"""Readers and sinks of the corpus's files, as DataFrames.

Every reader declares its schema, so no file is read to infer one, and bad lines give nulls, not errors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

PAGE = "struct<tess_text:string,doctr_text:string,surya_text:string,consensus_text:string,agreement_ratio:double>"
ACT = "struct<chapter:string,chapter_int:int,title:string,text:string,source_page:int,confident:boolean>"
SECTION = "SectionNumber"


def label_of(path: Column, pattern: str = r"production-([^/]+)/") -> Column:
    """The label that a folder ``production-<label>`` names."""
    return F.regexp_extract(path, pattern, 1)


def pages(spark: SparkSession, path: str, label: str = r"production-([^/]+)/") -> DataFrame:
    """(label, page, record) of JSON files with a map from page number to record, in each volume's folder."""
    files = spark.read.text(path, wholetext=True).select(label_of(F.col("_metadata.file_path"), label).alias("label"), "value")
    rows = files.select("label", F.explode(F.from_json("value", f"map<string,{PAGE}>")).alias("key", "record"))
    return rows.select("label", F.expr("try_cast(key AS int)").alias("page"), "record.*")


def acts(spark: SparkSession, path: str) -> DataFrame:
    """Both lists of a parsed-act file as one; what lacks a flag has the one that its list says."""
    kind = f"struct<confident_acts:array<{ACT}>,flagged_acts:array<{ACT}>>"
    file = spark.read.text(path, wholetext=True).select(label_of(F.col("_metadata.file_path")).alias("label"), F.from_json("value", kind).alias("f"))
    each = [
        file.select("label", F.posexplode(f"f.{name}").alias("pos", "act")).select("label", F.lit(name).alias("list"), "pos", "act.*").withColumn("confident", F.coalesce("confident", F.lit(sure)))
        for name, sure in (("confident_acts", True), ("flagged_acts", False))
    ]
    return each[0].unionByName(each[1])


def totals(spark: SparkSession, path: str) -> DataFrame:
    """Session totals from tab-separated lines: five columns, or four without the session's own id."""
    kind = "label string, year string, kind string, total string, id string"
    rows = spark.read.csv(path, sep="\t", header=True, schema=kind, enforceSchema=True, mode="PERMISSIVE")
    return rows.select("label", F.expr("try_cast(year AS int)").alias("year"), "kind", F.expr("try_cast(total AS int)").alias("total"), F.coalesce("id", "label").alias("id")).filter("total IS NOT NULL")


def dump(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A delimited dump: tabs, back-ticks as quotes, ``NULL`` for null."""
    return spark.read.csv(path, sep="\t", quote="`", nullValue="NULL", schema=schema)


def decoded(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as UTF-8, or as Latin-1 where they aren't UTF-8."""
    raw = spark.read.format("binaryFile").load(path).select(F.col("path"), "content")
    text = F.expr("CASE WHEN is_valid_utf8(cast(content AS string)) THEN cast(content AS string) ELSE decode(content, 'ISO-8859-1') END")
    return raw.select(F.element_at(F.split("path", "/"), -1).alias("file"), text.alias("text"))


def _sections(text: str | None) -> list[dict]:
    """A bill's sections in document order, those within others too, and one row with an error if it isn't XML."""
    name = lambda e: e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""

    def own(e: ElementTree.Element) -> Iterator[ElementTree.Element]:
        """What lies in a section and not in one within it."""
        for x in e:
            if name(x) != "BillSection":
                yield x
                yield from own(x)

    def words(e: ElementTree.Element) -> Iterator[str]:
        yield e.text or ""
        for x in e:
            if name(x) != "BillSection":
                yield from words(x)
            yield x.tail or ""

    def first(e: ElementTree.Element, tag: str) -> str:
        found = next((x for x in own(e) if name(x) == tag), None)
        return "" if found is None else " ".join(" ".join(words(found)).split())

    try:
        root = ElementTree.fromstring(text or "")
    except ElementTree.ParseError as e:
        return [{"order": None, "number": None, "action": None, "text": None, "error": str(e)}]
    some = [e for e in root.iter() if name(e) == "BillSection"]
    return [{"order": k, "number": first(e, "Num"), "action": e.get("action", ""), "text": first(e, "Content"), "error": None} for k, e in enumerate(some, 1)]


def bill_actions(files: DataFrame) -> DataFrame:
    """Section actions of bills in XML, whatever their namespace: (file, order, number, action, text, error).

    Sections stand anywhere, also within others, whose text they aren't part of. Processing instructions, by which
    editors track changes, don't count, CDATA is text. A file that isn't well-formed gives one row that has ``error`` only.
    """
    text = [T.StructField(c, T.StringType()) for c in ("number", "action", "text", "error")]
    schema = T.StructType([files.schema["file"], T.StructField("order", T.IntegerType()), *text])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                yield pa.RecordBatch.from_pylist([{"file": r["file"], **x} for x in _sections(r["text"])], schema=arrow)

    return files.select("file", "text").mapInArrow(run, schema)


def log_fields(spark: SparkSession, path: str, patterns: dict[str, str]) -> DataFrame:
    """The last value that each pattern's group has in a run's log, by file."""
    lines = spark.read.text(path).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), "value", F.monotonically_increasing_id().alias("line"))
    out = [F.max_by(F.when(F.col("value").rlike(p), F.regexp_extract("value", p, 1)), F.when(F.col("value").rlike(p), F.col("line"))).alias(name) for name, p in patterns.items()]
    return lines.groupBy("file").agg(*out)


def last_verdicts(rows: DataFrame, key: Sequence[str], order: str, value: str) -> DataFrame:
    """The last value of each key."""
    return rows.groupBy(*key).agg(F.max_by(value, order).alias(value))


def registered(known: DataFrame, files: DataFrame) -> DataFrame:
    """Known contents and new ones, each once: files whose bytes hash alike are one artifact."""
    hashed = files.select(F.sha2("content", 256).alias("sha256"), "file").groupBy("sha256").agg(F.min("file").alias("file"))
    return known.select("sha256", "file").unionByName(hashed.join(known, "sha256", "left_anti"))


def write_stages(df: DataFrame, path: str, by: Sequence[str] = ("stage", "label")) -> None:
    """Stage outputs in a folder for each stage and volume; a stage that runs again replaces its own only."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def json_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
