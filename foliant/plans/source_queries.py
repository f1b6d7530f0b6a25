"""Sources and sinks: the test tables written in the corpus's formats and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..registry import query, table
from ..sources import readers
from ..sources.paths import shared_path


#: Pages of all volumes for each file of a volume, over 64 times as many.
FILE_PAGES = 2_000


@query(
    "s01_s02_page_json",
    "SELECT lang AS label, CAST(doc_id AS INT) AS page, md5(coalesce(text, '')) AS digest FROM documents",
)
def s01_s02_page_json(spark, sf):
    """A JSON map from page number to record in each volume's folder, the language standing in for the volume. A
    volume's pages are dealt out over files, more of them the more pages there are, so that none is held in one row."""
    docs = table(spark, sf, "documents")
    path = shared_path(spark, "pages")
    record = F.struct(F.coalesce("text", F.lit("")).alias("consensus_text"))
    dealt = F.pmod(F.xxhash64("doc_id"), F.lit(max(64, -(-docs.count() // FILE_PAGES))))
    files = docs.groupBy("lang", dealt).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("doc_id").cast("string"), record)))).alias("value"))
    # one map in each file
    files.select(F.concat(F.lit("production-"), "lang").alias("volume"), "value").write.option("maxRecordsPerFile", 1).partitionBy("volume").text(path)
    volumes = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(readers.label_of(F.replace("path", F.lit("volume=production-"), F.lit("production-"))).alias("label")).distinct()
    named = readers.pages(spark, f"{path}/*/*.txt", r"production-([^/]+)/").join(F.broadcast(volumes), "label", "left_semi")  # few names; pages aren't dealt by them
    return named.select("label", "page", F.md5("consensus_text").alias("digest"))


@query(
    "s05_parsed_acts",
    """SELECT CAST(n_nationkey AS INT) AS chapter_int, n_name AS title, n_nationkey % 4 <> 0 AS confident,
       CASE WHEN n_nationkey % 4 <> 0 THEN 'confident_acts' ELSE 'flagged_acts' END AS list FROM nation""",
)
def s05_parsed_acts(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").cast("int").alias("chapter_int"), F.col("n_name").alias("title"))
    path = shared_path(spark, "acts")
    sure = F.col("chapter_int") % 4 != 0
    act = F.struct("chapter_int", "title")
    each = n.groupBy(F.col("chapter_int") % 3).agg(F.collect_list(F.when(sure, act)).alias("confident_acts"), F.collect_list(F.when(~sure, act)).alias("flagged_acts"))
    each.select("confident_acts", "flagged_acts").write.option("maxRecordsPerFile", 1).json(f"{path}/production-1850/")
    return readers.acts(spark, f"{path}/*/*.json").select("chapter_int", "title", "confident", "list")


@query(
    "s06_totals_tsv",
    "SELECT n_name AS label, CAST(1850 + n_nationkey AS INT) AS year, CAST(n_nationkey AS INT) AS total, CASE WHEN n_nationkey % 2 = 0 THEN 'S' || n_nationkey ELSE n_name END AS id FROM nation WHERE n_nationkey % 5 <> 0",
)
def s06_totals_tsv(spark, sf):
    n = table(spark, sf, "nation")
    path = shared_path(spark, "totals")
    key = F.col("n_nationkey").cast("string")
    n.select(
        F.col("n_name").alias("session_label"),
        (F.col("n_nationkey") + 1850).alias("session_year"),
        F.lit("regular").alias("session_type"),
        F.when(F.col("n_nationkey") % 5 == 0, "unknown").otherwise(key).alias("total_chapters"),
        F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("S"), key)).alias("canonical_id"),
    ).write.csv(path, sep="\t", header=True)
    return readers.totals(spark, path).select("label", "year", "total", "id")


@query("s07_dump", "SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS segment FROM customer")
def s07_dump(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("segment"))
    path = shared_path(spark, "dump")
    c.write.csv(path, sep="\t", quote="`", quoteAll=True, nullValue="NULL")
    return readers.dump(spark, path, "c_custkey long, c_name string, segment string")


@query("s08_encodings", "SELECT CAST(n_nationkey AS INT) AS n, 'Café ' || n_name AS text FROM nation")
def s08_encodings(spark, sf):
    """One file in UTF-8 and one in Latin-1, each read as what it is."""
    n = table(spark, sf, "nation").select("n_nationkey", F.concat_ws("|", F.col("n_nationkey").cast("string"), F.concat(F.lit("Café "), "n_name")).alias("value"))
    path = shared_path(spark, "encodings")
    for k, encoding in enumerate(("UTF-8", "ISO-8859-1")):
        n.filter(F.col("n_nationkey") % 2 == k).select("value").coalesce(1).write.option("encoding", encoding).csv(f"{path}/{k}", sep="\x01", quote="", escapeQuotes=False)
    lines = readers.decoded(spark, f"{path}/*/*.csv").select(F.explode(F.split("text", "\n")).alias("line")).filter("line <> ''")
    part = F.split("line", r"\|")
    return lines.select(part[0].cast("int").alias("n"), part[1].alias("text"))


@query(
    "s09_bill_actions",
    "SELECT CAST(n_nationkey AS INT) AS bill, o AS \"order\", CAST(n_nationkey * 10 + o AS VARCHAR) AS number, CASE WHEN o = 1 THEN 'amend' ELSE 'repeal' END AS action, n_name || ' text ' || o AS text FROM nation, (VALUES (1), (2)) AS x(o)",
)
def s09_bill_actions(spark, sf):
    section = lambda o, action: F.concat(
        F.lit(f'<caml:BillSection id="s{o}" action="{action}"><caml:Num>'), (F.col("n_nationkey") * 10 + o).cast("string"), F.lit("</caml:Num><caml:Content><?xm-insertion_mark_start?><p>"), F.col("n_name"), F.lit(f" <b>text</b>\n {o}</p><?xm-insertion_mark_end?></caml:Content></caml:BillSection>")
    )
    bills = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("file"), F.concat(F.lit('<caml:Bill xmlns:caml="urn:x">'), section(1, "amend"), section(2, "repeal"), F.lit("</caml:Bill>")).alias("text"))
    return readers.bill_actions(bills).select(F.col("file").cast("int").alias("bill"), "order", "number", "action", "text")


@query("s11_json_lines", "SELECT conv_id, turn, role, length(text) AS n FROM conversations")
def s11_json_lines(spark, sf):
    path = shared_path(spark, "jsonl")
    table(spark, sf, "conversations").write.json(path)
    return readers.json_lines(spark, path, "conv_id long, turn long, role string, text string").select("conv_id", "turn", "role", F.length("text").cast("long").alias("n"))


@query("s13_s14_verdicts", "SELECT user_id AS label, max_by(event_type, event_id) AS verdict FROM events GROUP BY user_id")
def s13_s14_verdicts(spark, sf):
    path = shared_path(spark, "verdicts")
    table(spark, sf, "events").select("user_id", "event_id", "event_type").write.csv(path, sep="\t")
    rows = spark.read.csv(path, sep="\t", schema="label long, line long, verdict string")
    return readers.last_verdicts(rows, ["label"], "line", "verdict")


@query(
    "s17_content_hash",
    "WITH h AS (SELECT sha256(coalesce(text, '')) AS sha256, min(doc_id) AS first_id FROM documents GROUP BY 1) SELECT sha256, first_id FROM h",
)
def s17_content_hash(spark, sf):
    docs = table(spark, sf, "documents").select(F.coalesce("text", F.lit("")).cast("binary").alias("content"), F.col("doc_id").alias("file"))
    known = docs.filter("file < 50").select(F.sha2("content", 256).alias("sha256"), "file").groupBy("sha256").agg(F.min("file").alias("file"))
    return readers.registered(known, docs).select("sha256", F.col("file").alias("first_id"))


@query(
    "s18_stage_sink",
    "SELECT CASE WHEN doc_id % 2 = 0 THEN 'split' ELSE 'reunify' END AS stage, lang AS label, doc_id, CASE WHEN doc_id % 2 = 0 THEN n_chars + 1 ELSE n_chars END AS n FROM documents",
)
def s18_stage_sink(spark, sf):
    """A stage that runs again replaces its own folders and leaves the others."""
    docs = table(spark, sf, "documents").select(F.when(F.col("doc_id") % 2 == 0, "split").otherwise("reunify").alias("stage"), F.col("lang").alias("label"), "doc_id", F.col("n_chars").alias("n"))
    path = shared_path(spark, "stages")
    readers.write_stages(docs, path)
    readers.write_stages(docs.filter("stage = 'split'").withColumn("n", F.col("n") + 1), path)
    return spark.read.schema("doc_id long, n long, stage string, label string").parquet(path).select("stage", "label", "doc_id", "n")


@query("s21_log_fields", "SELECT CAST(count(*) AS VARCHAR) AS pages, CAST(max(event_id) AS VARCHAR) AS last_event FROM events")
def s21_log_fields(spark, sf):
    path = shared_path(spark, "logs")
    e = table(spark, sf, "events").agg(F.count("*").alias("n"), F.max("event_id").alias("m"))
    e.select(F.concat(F.lit("start\npages: 0\npages: "), F.col("n").cast("string"), F.lit("\nlast event "), F.col("m").cast("string"), F.lit("\n")).alias("value")).write.text(path)
    return readers.log_fields(spark, path, {"pages": r"^pages: (\d+)", "last_event": r"^last event (\d+)"}).select("pages", "last_event")
