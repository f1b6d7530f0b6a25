"""Acts parsed from the pages of volumes.

A heading opens an act if "An Act" stands on its line or one of the next four with content; the act runs to the next
heading that opens one. Headings are found page by page, each page with the first lines of the pages after it, and an
act takes its lines from the pages that it spans: no volume is gathered or sorted line by line in one task.

Pages and acts are joined by sorting both: what a table has on disk says little of its texts' size once they are taken
apart, so left to itself Spark may broadcast them through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import acts as A
from ..functions import numerals as N
from ..functions import pages as P

#: Lines with content that a heading looks ahead, pages they may be on, lengths of titles and texts.
AHEAD, PAGES_AHEAD, TITLE, FALLBACK_TITLE, TEXT = 4, 4, 500, 300, 6000


def headings(pages: DataFrame, volume: str = "volume", page: str = "page", text: str = "text") -> DataFrame:
    """(volume, page, line_no, raw) of the lines that open an act."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    trimmed = pages.select(F.col(volume).alias("volume"), F.col(page).cast("long").alias("page"), F.transform(lines, lambda x: F.btrim(x, F.lit(" \t\r"))).alias("lines"))
    filled = lambda c: F.filter(c, lambda x: x != "")
    # the first lines with content of each page, on the pages before it
    heads = trimmed.select("volume", "page", F.slice(filled(F.col("lines")), 1, AHEAD).alias("first")).filter(F.size("first") > 0)
    on = heads.select("volume", F.explode(F.sequence(F.col("page") - PAGES_AHEAD, F.col("page") - 1)).alias("page"), F.struct(F.col("page").alias("of"), "first").alias("f"))
    after = on.groupBy("volume", "page").agg(F.flatten(F.transform(F.array_sort(F.collect_list("f")), lambda f: f["first"])).alias("after"))
    whole = trimmed.filter(F.exists("lines", lambda x: A.heading_number(x).isNotNull())).join(after.hint("merge"), ["volume", "page"], "left")
    at = F.transform("lines", lambda x, k: F.struct(k.alias("line_no"), A.heading_number(x).alias("raw"), x.alias("line")))
    each = whole.select("volume", "page", "lines", "after", F.explode(F.filter(at, lambda h: h["raw"].isNotNull())).alias("h"))
    rest = F.slice(F.concat(filled(F.slice("lines", F.col("h.line_no") + 2, F.size("lines"))), F.coalesce("after", F.array().cast("array<string>"))), 1, AHEAD)
    return each.filter(F.concat_ws(" ", F.array("h.line"), rest).rlike(A.AN_ACT)).select("volume", "page", "h.line_no", "h.raw")


def bodies(pages: DataFrame, volume: str = "volume", page: str = "page", text: str = "text") -> DataFrame:
    """(volume, in_act_order, page, raw, header, text): what stands under each heading, in reading order from 0."""
    by = Window.partitionBy("volume").orderBy("page", "line_no")
    order = headings(pages, volume, page, text).withColumns({"in_act_order": F.row_number().over(by) - 1, "next_": F.lead(F.struct("page", "line_no")).over(by)})
    last = pages.groupBy(F.col(volume).alias("volume")).agg(F.max(F.col(page).cast("long")).alias("last_"))
    spans = order.join(last, "volume").withColumn("to_", F.coalesce("next_.page", "last_"))
    parts = spans.withColumn("on_", F.explode(F.sequence("page", "to_")))
    lines = pages.select(F.col(volume).alias("volume"), F.col(page).cast("long").alias("on_"), F.split(F.coalesce(F.col(text), F.lit("")), "\n").alias("lines"))
    held = parts.join(lines.hint("merge"), ["volume", "on_"])
    first = F.when(F.col("on_") == F.col("page"), F.col("line_no")).otherwise(0)
    end = F.when(F.col("on_") == F.col("next_.page"), F.col("next_.line_no")).otherwise(F.size("lines"))
    cut = held.select("volume", "in_act_order", "page", "raw", "on_", F.slice("lines", first + 1, F.greatest(end - first, F.lit(0))).alias("part"))
    whole = cut.groupBy("volume", "in_act_order", "page", "raw").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("on_", "part"))), lambda p: p["part"])).alias("lines"))
    return whole.select("volume", "in_act_order", "page", "raw", F.get("lines", F.lit(0)).alias("header"), "lines")


def parsed_acts(pages: DataFrame, years: DataFrame, volume: str = "volume", page: str = "page", text: str = "text") -> DataFrame:
    """Acts of all volumes; ``years`` (volume, year) has each volume's own year.

    Columns: volume, in_act_order, chapter_raw, chapter (0 if it can't be read), title, approved, path, source_page (from
    1), rejected_years, date_needs_review, confident, reject (why it is no act, else null) and text.
    """
    b = bodies(pages, volume, page, text).join(years, "volume", "left")
    full = F.trim(F.array_join("lines", "\n"))
    b = b.withColumn("full", full).withColumn("d", A.act_date(F.col("full"), F.col("year")))
    squeezed = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    titled = F.get(F.filter("lines", lambda x: x.rlike(A.AN_ACT)), F.lit(0))
    title = F.coalesce(F.substring(squeezed(titled), 1, TITLE), F.substring(squeezed(F.col("header")), 1, FALLBACK_TITLE))
    review = F.col("d.date").isNull() & (F.size("d.rejected") > 0)
    chapter = N.misread_numeral(F.col("raw"))
    return b.select(
        "volume",
        "in_act_order",
        F.col("raw").alias("chapter_raw"),
        chapter.cast("int").alias("chapter"),
        title.alias("title"),
        F.col("d.date").alias("approved"),
        P.enactment_path(F.col("full")).alias("path"),
        (F.col("page") + 1).alias("source_page"),
        F.col("d.rejected").alias("rejected_years"),
        review.alias("date_needs_review"),
        (A.is_confident(F.col("full"), F.col("d.date")) & (chapter > 0) & ~review).alias("confident"),
        A.flush_reject(F.col("header"), F.col("full")).alias("reject"),
        F.substring(F.regexp_replace("full", r"[ \t]+", " "), 1, TEXT).alias("text"),
    )


def merged_acts(acts: DataFrame, anchors: DataFrame, alike: float = 0.6, weak: float = 0.3, tokens: int = 15) -> DataFrame:
    """Acts with ``verdict`` and ``keeper``: of acts of one (volume, page) those that are the same act are merged.

    ``acts`` (volume, page, id, chapter, title, text); ``anchors`` (volume, chapter) of chapters whose headings are
    printed on their page. Of two acts with bodies of ``tokens`` words or more that share a part of ``alike`` or more of
    their distinct words, the one with an anchored chapter stays, else that with the longer text, else the least id:
    the other is ``same``. A part of ``weak`` or more is ``weak`` and both stay. An act with a shorter body whose title's
    words are all in another's title is a ``stub`` of it. Acts are compared within a page, whose acts are few.
    """
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("[a-z]+"), 0))
    a = acts.join(anchors.select("volume", "chapter", F.lit(True).alias("anchored")).distinct(), ["volume", "chapter"], "left")
    a = a.select("volume", "page", "id", words(F.col("text")).alias("b"), words(F.col("title")).alias("t"), F.struct(F.coalesce("anchored", F.lit(False)).alias("anchored"), F.length("text").alias("n"), (-F.col("id")).alias("i")).alias("worth"))
    other = a.select("volume", "page", *(F.col(c).alias(f"{c}_") for c in ("id", "b", "t", "worth")))
    pairs = a.join(other, ["volume", "page"]).filter("id <> id_ AND worth < worth_")
    shared = F.size(F.array_intersect("b", "b_"))
    part = F.when((F.size("b") >= tokens) & (F.size("b_") >= tokens), shared / (F.size("b") + F.size("b_") - shared))
    stub = (F.size("b") < tokens) & (F.size("t") > 0) & (F.size(F.array_except("t", "t_")) == 0)
    kind = F.when(part >= alike, 1).when(stub, 2).when(part >= weak, 3)
    judged = pairs.withColumn("k_", kind).filter("k_ IS NOT NULL").groupBy("volume", "page", "id").agg(F.min("k_").alias("k_"), F.max_by("id_", F.struct(-F.col("k_"), "worth_")).alias("keeper"))
    out = acts.join(judged, ["volume", "page", "id"], "left")
    verdict = F.when(F.col("k_") == 1, "same").when(F.col("k_") == 2, "stub").when(F.col("k_") == 3, "weak").otherwise("own")
    return out.select(*acts.columns, verdict.alias("verdict"), F.when(F.col("k_").isin(1, 2), F.col("keeper")).alias("keeper"))


def planned_acts(acts: DataFrame, pages: DataFrame, witnesses: DataFrame) -> DataFrame:
    """The rows to ingest: confident acts with their page spans and what the spans' pages say of quality.

    ``acts`` as :func:`parsed_acts` gives them; ``pages`` (volume, page, confidence, tokens); ``witnesses`` (volume,
    in_act_order, numeral): other readings of an act's number. An act's span ends on the page where the next one
    begins. ``confident_number``: the number is 1 or more and all witnesses agree on it; an act with a doubtful number or
    no date is planned all the same, with the fact.
    """
    by = Window.partitionBy("volume").orderBy("in_act_order")
    last = pages.groupBy("volume").agg(F.max("page").alias("last_"))
    real = acts.filter("reject IS NULL AND confident")
    spans = real.withColumn("start_page", F.col("source_page") - 1).withColumn("next_", F.lead("start_page").over(by)).join(last, "volume")
    spans = spans.withColumn("end_page", F.greatest("start_page", F.coalesce("next_", "last_"))).drop("next_", "last_")
    on = spans.select("volume", "in_act_order", F.explode(F.sequence("start_page", "end_page")).alias("page")).join(pages.hint("merge"), ["volume", "page"], "left")
    signal = on.groupBy("volume", "in_act_order").agg(
        F.count("confidence").alias("pages_read"),
        F.round(F.sum(F.col("confidence") * F.col("tokens")) / F.nullif(F.sum(F.when(F.col("confidence").isNotNull(), F.col("tokens"))), F.lit(0)), 4).alias("quality"),
    )
    said = witnesses.groupBy("volume", "in_act_order").agg(F.array_distinct(F.collect_list("numeral")).alias("said"))
    out = spans.join(signal.hint("merge"), ["volume", "in_act_order"], "left").join(said.hint("merge"), ["volume", "in_act_order"], "left")
    agreed = F.coalesce((F.size("said") == 1) & (F.get("said", F.lit(0)) == F.col("chapter")), F.lit(False))
    return out.select("volume", "in_act_order", "chapter", "title", "approved", "path", "start_page", "end_page", "pages_read", "quality", ((F.col("chapter") >= 1) & agreed).alias("confident_number"))
