"""What makes a text an act: headings, clauses, dates and the gates of the parser, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import day_number, lapse_date, month_number

# Patterns of printed acts, with the misreadings that they allow for.
DASHES = "—–‒‐‑-"
HEADING = (
    r"(?i)^[^A-Za-z0-9]*(?:[Cc][HhUuNnRrAaOoEe][AaRrVvPpOo][PpVvRrTt]?[a-zA-Z]{0,3}\.?\s*|[Cc][Hh][Aa][Pp][Tt][Ee][Rr]\s*)\.?"
    rf"[\s{DASHES}]*(?:,[\s.]*(?=[IVXLCDMivxlcdm]))?[\s{DASHES}]*([IVXLCDMivxlcdm0-9JjTtYyLl!|]{{1,8}})\s*[.,;:]?(?:\s*[{DASHES}].*)?$"
)
AN_ACT = r"(?i)\bAn?\s+A[CEO][TI]\b"
ENACTING = r"(?i)P[er]?[eo]ple\s+[oa][fa]\s+the\s+State\s+[oa][fa]\s+C[a-z]{5,12}|d[ou]\s+en[a-z]{2,4}\s+a[a-z]\s+f[aeiou]l[a-z]*"
RESOLUTION = (
    r"(?i)^\W{0,4}(?:(?:Senate|Assembly)\s+)?(?:Concurrent|Joint)\s+Resolution\b|^\W{0,4}Resolution\s+No\b"
    r"|^\W{0,4}Resolved\s*,?\s+by\s+the\s+(?:Assembly|Senate)\b|^\W{0,4}[WV][A-Za-z]{4,9}[sS]\s*[,.]\s+(?:By|That|the|it|in|whereas)\b"
)
CHAPTER_PREFIX = r"(?i)^[^A-Za-z0-9]*(?:CHAPTER|CHAP)[^A-Za-z0-9]*[IVXLCDMivxlcdm0-9]{1,8}[^A-Za-z0-9]*"
MONTH = "(Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Mav|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"
YEAR = r"((?:18|19|20)\d\d)"
APPROVED_WORD = r"(?:[AP][A-Za-z]{1,4}[OoUu0][VvUuYy][A-Za-z]{0,5}|A[Pp]{1,3}[Rr]{1,3}[Oo]?[Vv]\w{0,6}|P[A-Za-z]{2,4}[Ee][Dd]|Pass(?:ed)?)"
BY_WHOM = r"(?:[^\n.;:]{0,20}?(?:[GC][a-z]{0,3}[vu][a-z]{0,4}n[a-z]{0,2}|tary\s+of\s+State)[^\n;]{0,12}?)?"
EARLY_DATE = rf"(?i){APPROVED_WORD}{BY_WHOM}\s*[,.]?\s*{MONTH}\s+((?:[IilOo]?\d+|[IilOo])(?:st|nd|rd|th|d)?)[,.]?\s*{YEAR}\b"
MODERN_DATE = rf"(?is)(?:Approved\s+by\s+(?:the\s+)?Governor|Filed\s+with\s+Secretary\s+of\s+State)\s+{MONTH}\s+(\d{{1,2}})\s*,?\s*{YEAR}\b"
#: How far a date's year may be from the volume's, lengths of texts, and what is looked at for clauses.
YEARS_APART, SHORTEST, SHORTEST_ACT, BODY, HEAD = 3, 60, 100, 200, 2000


def heading_number(line: Column) -> Column:
    """The numeral of a chapter's heading as it is printed, null for other lines."""
    return F.nullif(F.regexp_extract(F.trim(line), HEADING, 1), F.lit(""))


def opening_line(text: Column) -> Column:
    """The first line with content that is more than a chapter's heading; empty if there is none."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n"), lambda x: F.btrim(F.regexp_replace(F.btrim(x, F.lit(" \t\r\f\x0b")), CHAPTER_PREFIX, ""), F.lit(" \t\r\f\x0b")))
    return F.coalesce(F.get(F.filter(lines, lambda x: x != ""), F.lit(0)), F.lit(""))


def is_resolution(text: Column) -> Column:
    """Whether a text announces itself as a resolution on its opening line; one that is named further down doesn't count."""
    return opening_line(text).rlike(RESOLUTION)


def has_clause(text: Column) -> Column:
    """Whether the enacting clause stands anywhere in a text."""
    return F.coalesce(text.rlike(ENACTING), F.lit(False))


def is_real(title: Column, text: Column, approved: Column) -> Column:
    """A text of ``BODY`` characters with an enacting clause, or with a title "An act" and a date of approval."""
    titled = F.coalesce(title.rlike(r"(?i)^\s*An\s+act\b"), F.lit(False))
    return F.coalesce((F.length(F.trim(text)) >= BODY) & (has_clause(text) | (titled & approved.isNotNull())), F.lit(False))


def bound(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of`` a value that is computed once, however often it is used in it."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def _dates(text: Column, pattern: str) -> Column:
    """A text is searched once, and what is found again for its parts."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    part = lambda f, k: F.regexp_extract(f, pattern, k)
    date = lambda f: F.try_make_timestamp_ntz(part(f, 3).try_cast("int"), bound(part(f, 1), month_number), bound(part(f, 2), day_number), F.lit(0), F.lit(0), F.lit(0)).cast("date")
    return F.filter(F.transform(found, date), lambda d: d.isNotNull())


def act_date(text: Column, year: Column, apart: int = YEARS_APART) -> Column:
    """(date, rejected): the first date of approval with a year near ``year``, and the years of the dates before it that
    are further off.

    Dates by the Governor or the Secretary of State go first, then early ones with all their misreadings, then the day
    on which an act became law without a signature. Without ``year`` any year will do.
    """
    dates = F.concat(_dates(text, MODERN_DATE), _dates(text, EARLY_DATE), F.array_compact(F.array(lapse_date(text))))
    near = lambda d: year.isNull() | (F.abs(F.year(d) - year) <= apart)

    def chosen(d: Column) -> Column:
        first = F.array_position(F.transform(d["dates"], near), True)
        before = F.when(first > 0, F.slice(d["dates"], F.lit(1), (first - 1).cast("int"))).otherwise(d["dates"])
        return F.struct(F.when(first > 0, F.get(d["dates"], (first - 1).cast("int"))).alias("date"), F.transform(before, F.year).alias("rejected"))

    return bound(F.struct(dates.alias("dates")), chosen)


def flush_reject(header: Column, text: Column) -> Column:
    """Why what stands under a heading is no act at all: ``short``, ``header`` (it says Approved or Passed), ``no_clause``;
    null if it is one."""
    trimmed = F.trim(text)
    return (
        F.when(F.length(trimmed) < SHORTEST, "short")
        .when(header.rlike(r"(?i)\b(?:Approved|Passed)\b"), "header")
        .when(~has_clause(text), "no_clause")
    )


def is_confident(text: Column, date: Column) -> Column:
    """No resolution, with "An Act" or the enacting clause near the head, a date, and ``SHORTEST_ACT`` characters."""
    head = F.substring(text, 1, HEAD)
    return F.coalesce(~is_resolution(text) & (head.rlike(AN_ACT) | head.rlike(ENACTING)) & date.isNotNull() & (F.length(F.trim(text)) >= SHORTEST_ACT), F.lit(False))


def spills_over(text: Column) -> Column:
    """Whether a body has more than one chapter's heading in it."""
    return F.size(F.filter(F.split(text, "\n"), lambda x: heading_number(x).isNotNull())) > 1


def quotes_title(line: Column) -> Column:
    """Whether "An Act" stands in quotation marks or behind ``entitled``: a title that is named, not the line's own."""
    return F.coalesce(line.rlike(r"(?i)(?:[\"“”']|\bentitled[,:]?)\s*An?\s+A[CEO][TI]\b"), F.lit(False))


def refers_to_chapter(line: Column) -> Column:
    """Whether a line names a chapter of something else, as in ``chapter 12 of the laws``."""
    return F.coalesce(line.rlike(r"(?i)\bchap(?:ter)?\.?\s+[IVXLCDM0-9]{1,8}\s*,?\s+(?:of|statutes)\b"), F.lit(False))


def is_marginal(line: Column) -> Column:
    """Whether a line begins as a margin's note does: a short word or two and a dash or column line before a heading."""
    return F.coalesce(line.rlike(rf"(?i)^\s*[A-Za-z]{{1,12}}(?:\s+[A-Za-z]{{1,12}})?\s*[|{DASHES}]\s*chap"), F.lit(False))
