"""Verdicts on volumes, flags on acts, and what is left to find."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import acts as A
from ..functions import dates as D
from ..functions import pages as P
from . import sequence as S

# Chapters of more than a stub; shares of doubtful and of empty pages and of missing chapters; what a count
# may fall short of the expected one by.
STUB, DOUBTFUL, EMPTY, MISSING, SLACK = 5, 0.30, 0.05, 0.30, (5, 0.08)
#: Damaged numbers in an act, and how far a section's number may jump.
DAMAGED_NUMBERS, SECTION_STEP = 3, 5000


def volume_facts(acts: DataFrame, pages: DataFrame) -> DataFrame:
    """(volume, sessions, chapters, top, gap_rate, classified, body_gaps, leading, doubtful, empty).

    ``acts`` (volume, session, chapter); ``pages`` (volume, page, shape, engines, sure, n_chars): the shape is null
    where a page wasn't classified, ``engines`` null where it wasn't read. ``chapters`` counts the distinct ones of all
    sessions, ``top`` and ``gap_rate`` are of the primary session: REGULAR, else UNKNOWN, else the first by name.
    """
    each = acts.select("volume", "session", "chapter").distinct()
    by_session = each.groupBy("volume", "session").agg(F.count("*").alias("n"), F.max("chapter").alias("top"), F.min("chapter").alias("low"))
    rank = F.when(F.col("session") == "REGULAR", 0).when(F.col("session") == "UNKNOWN", 1).otherwise(2)
    primary = F.min_by(F.struct("top", "low", "n"), F.struct(rank, "session")).alias("p")
    numbers = by_session.groupBy("volume").agg(F.count("*").alias("sessions"), F.sum("n").alias("chapters"), primary)
    span = F.col("p.top") - F.col("p.low") + 1
    numbers = numbers.select("volume", "sessions", "chapters", F.col("p.top").alias("top"), F.round(1 - F.col("p.n") / span, 6).alias("gap_rate"))
    read = F.col("engines").isNotNull()
    first = pages.filter(read).groupBy("volume").agg(F.min("page").alias("first_"))
    many = read & (F.col("engines") > 1)
    share = lambda some, of: F.round(F.coalesce(F.try_divide(F.count_if(some), F.count_if(of)), F.lit(0.0)), 6)
    seen = pages.join(first, "volume", "left").groupBy("volume").agg(
        F.coalesce(F.bool_or(F.col("shape").isNotNull()), F.lit(False)).alias("classified"),
        F.count_if(~read & (F.col("shape") == "body") & (F.col("page") > F.col("first_"))).alias("body_gaps"),
        F.count_if(~read & (F.col("page") < F.col("first_"))).alias("leading"),
        share(many & ~F.coalesce("sure", F.lit(False)), many).alias("doubtful"),
        share(read & (F.coalesce("n_chars", F.lit(0)) == 0), read).alias("empty"),
    )
    return seen.join(numbers, "volume", "left").fillna(0, ["sessions", "chapters"])


def volume_verdicts(facts: DataFrame, expected: DataFrame) -> DataFrame:
    """``facts`` with ``verdict``: the first of STUB, GAPS_FOUND (body pages lack), SUSPECT, GAPS_FOUND (chapters lack, or
    fall short of ``expected`` (volume, label, expected)), UNVERIFIED, LEADING_GAP_ONLY and COMPLETE."""
    f = facts.join(expected.select("volume", "label", "expected"), "volume", "left")
    c = F.col
    short = c("top") < c("expected") - F.greatest(F.lit(SLACK[0]), F.floor(c("expected") * SLACK[1]))
    one_of_many = F.coalesce(c("label").rlike(r"(?i)-vol\d+"), F.lit(False))
    verdict = (
        F.when(c("chapters") < STUB, "STUB")
        .when(c("classified") & (c("body_gaps") > 0), "GAPS_FOUND")
        .when((c("doubtful") > DOUBTFUL) | (c("empty") > EMPTY) | (c("sessions") == 0), "SUSPECT")
        .when((c("sessions") == 1) & (c("gap_rate") >= MISSING) & ~one_of_many, "GAPS_FOUND")
        .when(F.coalesce(short, F.lit(False)), "GAPS_FOUND")
        .when(~c("classified"), "UNVERIFIED")
        .when(c("leading") > 0, "LEADING_GAP_ONLY")
        .otherwise("COMPLETE")
    )
    return f.withColumn("verdict", verdict)


def act_flags(acts: DataFrame) -> DataFrame:
    """(volume, position, check, detail): what is doubtful in each act, by six checks.

    ``acts`` (volume, position, chapter, ceiling, year, approved, text). ``range``: the number is under 1 or over the
    ceiling; ``sequence``: it breaks the volume's sequence, or an earlier act has it; ``dates``: by
    :func:`~foliant.functions.dates.date_damage`; ``keywords``: misread key words; ``sections``: damaged or leaping section
    numbers, and many damaged numbers; ``formula``: a text of 200 characters without the enacting formula.
    """
    c, text = F.col, F.coalesce("text", F.lit(""))
    heads = F.regexp_extract_all(text, F.lit(r"(?im)^[ \t]*Sec(?:tion|\.)\s*([0-9A-Za-z.]{1,8})"), 1)
    bare = F.transform(heads, lambda t: F.regexp_replace(t, "[.,;:()]+$", ""))
    whole = lambda some: F.filter(F.transform(some, lambda t: t.try_cast("int")), lambda n: n.isNotNull())
    leaps = lambda n: F.exists(F.arrays_zip(n.alias("a"), F.slice(n, F.lit(2), F.size(n)).alias("b")), lambda p: (F.abs(p["b"] - p["a"]) > SECTION_STEP) & (p["b"] > 100))
    of = lambda name, a: F.transform(a, lambda x: F.struct(F.lit(name).alias("check"), x.alias("detail")))
    when = lambda name, cond, detail: of(name, F.when(F.coalesce(cond, F.lit(False)), F.array(detail)).otherwise(F.array().cast("array<string>")))
    # section numbers are searched for once: a transform's argument is a name for what it is given
    sections = F.flatten(F.transform(F.array(bare), lambda b: F.concat(
        when("sections", F.exists(b, P.damaged_section), F.lit("damaged")),
        F.flatten(F.transform(F.array(whole(b)), lambda n: when("sections", (F.size(n) >= 3) & leaps(n), F.lit("leap")))),
    )))
    simple = F.concat(
        when("range", (c("chapter") < 1) | (c("chapter") > c("ceiling")), c("chapter").cast("string")),
        of("dates", F.coalesce(D.date_damage(text, c("approved"), c("year")), F.array().cast("array<string>"))),
        of("keywords", P.misread_keywords(text)),
        sections,
        when("sections", P.damaged_numbers(text) >= DAMAGED_NUMBERS, F.lit("dense")),
        when("formula", (F.length(text) >= 200) & ~text.rlike(r"(?i)do\s+enact\b"), F.lit("missing")),
    )
    flags = acts.select("volume", "position", F.explode(simple).alias("f")).select("volume", "position", "f.*")
    numbers = acts.select("volume", "position", "chapter").filter("chapter IS NOT NULL")
    broken = S.breaks(numbers, "volume", ["position"], "chapter").filter("is_break").select("volume", "position", F.lit("sequence").alias("check"), F.lit("break").alias("detail"))
    again = numbers.withColumn("r_", F.row_number().over(Window.partitionBy("volume", "chapter").orderBy("position"))).filter("r_ > 1")
    return flags.unionByName(broken).unionByName(again.select("volume", "position", F.lit("sequence").alias("check"), F.lit("duplicate").alias("detail")))


def flag_quality(flags: DataFrame, truth: DataFrame) -> DataFrame:
    """(check, flagged, true, precision, recall) of each check against ``truth`` (volume, position), acts known to be bad."""
    at = flags.select("volume", "position", "check").distinct().join(truth.select("volume", "position", F.lit(1).alias("t_")).distinct(), ["volume", "position"], "left")
    total = truth.select("volume", "position").distinct().count()
    per = at.groupBy("check").agg(F.count("*").alias("flagged"), F.count("t_").alias("true"))
    return per.select("check", "flagged", "true", F.round(F.col("true") / F.col("flagged"), 4).alias("precision"), F.round(F.col("true") / F.lit(max(1, total)), 4).alias("recall"))


def index_totals(entries: DataFrame, coverage: float = 0.75) -> DataFrame:
    """(volume, derived, entries): the count of chapters that a volume's index entries (volume, chapter) speak for.

    The contiguous run from the lowest number, lone high ones aside; null where the index has under ``coverage`` of it.
    """
    one = entries.select("volume", "chapter").distinct()
    top = S.contiguous_top(one, "volume", "chapter")
    held = one.join(top, "volume").filter("chapter <= top").groupBy("volume", "top").agg(F.count("*").alias("entries"))
    return held.select("volume", F.when(F.col("entries") >= coverage * F.col("top"), F.col("top")).alias("derived"), "entries")


def index_verdicts(derived: DataFrame, known: DataFrame) -> DataFrame:
    """(volume, derived, known, verdict): MATCH within one, ORACLE_LOW or ORACLE_HIGH, NO_INDEX where none is derived."""
    both = known.select("volume", "known").join(derived.select("volume", "derived"), "volume", "left")
    verdict = F.when(F.col("derived").isNull(), "NO_INDEX").when(F.abs(F.col("derived") - F.col("known")) <= 1, "MATCH").when(F.col("known") < F.col("derived"), "ORACLE_LOW").otherwise("ORACLE_HIGH")
    return both.withColumn("verdict", verdict)
