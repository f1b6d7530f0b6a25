"""Dates and labels of sessions as column expressions. An unknown date is null, never a stand-in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .pages import LAPSE

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def month_number(text: Column) -> Column:
    """By the first three letters; ``mav`` is a misread May."""
    three = F.lower(F.substring(F.trim(text), 1, 3))
    at = F.array_position(F.array(*map(F.lit, MONTHS)), F.when(three == "mav", "may").otherwise(three))
    return F.when(at > 0, at.cast("int"))


def day_number(text: Column) -> Column:
    """1 to 31, after ordinal endings are taken off and I, l and O are read as digits; else null."""
    bare = F.regexp_replace(F.trim(text), "(?i)(st|nd|rd|th|d)[.,]?$", "")
    day = F.regexp_replace(F.translate(bare, "IlOo", "1100"), "[^0-9]", "").try_cast("int")
    return F.when(day.between(1, 31), day)


def approved_date(text: Column, year: Column, before: int = 1, after: int = 2) -> Column:
    """The first ``Month day, year`` of a text whose year is ``before`` earlier to ``after`` later than ``year``."""
    pattern = F.lit(r"([A-Z][a-z]{2,8})\.? +([0-9IlO]{1,2})(?:st|nd|rd|th)?, +([0-9]{4})")
    found = F.arrays_zip(*(F.regexp_extract_all(text, pattern, k).alias(n) for k, n in ((1, "m"), (2, "d"), (3, "y"))))
    dates = F.transform(
        found,
        lambda f: F.when(
            f["y"].cast("int").between(year - before, year + after),
            F.try_make_timestamp_ntz(f["y"].cast("int"), month_number(f["m"]), day_number(f["d"]), F.lit(0), F.lit(0), F.lit(0)).cast("date"),
        ),
    )
    return F.get(F.filter(dates, lambda d: d.isNotNull()), F.lit(0))


def operative_date(chaptered: Column, urgent: Column) -> Column:
    """Of an urgent act the day it was chaptered, else the next New Year's Day."""
    return F.when(urgent, chaptered).otherwise(F.make_date(F.year(chaptered) + 1, F.lit(1), F.lit(1)))


def range_literal(lo: Column, hi: Column) -> Column:
    """``[lo,hi)``; an unknown lower bound is ``(``, an open end is empty."""
    d = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(""))
    return F.concat(F.when(lo.isNull(), "(").otherwise("["), d(lo), F.lit(","), d(hi), F.lit(")"))


def session_label(year: Column) -> Column:
    """Two years that begin with an odd one: 2023-2024 for 2023 and 2024."""
    odd = year - F.when(year % 2 == 0, 1).otherwise(0)
    return F.concat(odd.cast("string"), F.lit("-"), (odd + 1).cast("string"))


def label_year(label: Column) -> Column:
    """``1927-vol1-26chapters`` is 1926 by its chapters, ``1863-64`` and ``1900-01`` go by their first year, but
    ``YYYY-01`` names the year after."""
    chapters = F.regexp_extract(label, "(?:^|[^0-9])([0-9]{2})chapters", 1)
    first = F.regexp_extract(label, "^([0-9]{4})", 1).try_cast("int")
    rolled = label.rlike("^[0-9]{2}00-01$")
    return F.when(chapters != "", (F.floor(first / 100) * 100 + chapters.try_cast("int")).cast("int")).when(rolled, first + 1).otherwise(first)


def session_kind(label: Column) -> Column:
    low = F.lower(label)
    return F.when(low.rlike("extra|special"), F.lit("extra")).when(low.rlike("^[0-9]{4}-[0-9]{2}$"), "biennium").otherwise("regular")


def era(year: Column, bounds: tuple[int, ...] = (1850, 1880, 1900, 1950, 2000)) -> Column:
    """The interval of ``bounds`` that a year is in, as ``1850-1879``."""
    out = F.when(year < bounds[0], F.lit(f"before {bounds[0]}"))
    for lo, hi in zip(bounds, bounds[1:]):
        out = out.when(year < hi, f"{lo}-{hi - 1}")
    return out.when(year >= bounds[-1], f"from {bounds[-1]}")


def ceiling(year: Column, steps: tuple[tuple[int, int], ...] = ((1850, 300), (1880, 500), (1920, 1200), (1970, 2500))) -> Column:
    """The greatest ordinal that a year's acts may have; null before the first step."""
    out = F.lit(None).cast("int")
    for since, most in steps:
        out = F.when(year >= since, most).otherwise(out)
    return out


ORDINALS = ("first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth", "eleventh", "twelfth", "thirteenth", "fourteenth", "fifteenth", "sixteenth", "seventeenth", "eighteenth", "nineteenth")
TENS = ("twentieth", "thirtieth", "fortieth", "fiftieth", "sixtieth", "seventieth", "eightieth", "ninetieth")


def ordinal_number(phrase: Column) -> Column:
    """``twenty-third`` and ``Twenty third`` are 23; null if it is no ordinal up to 99."""
    low = F.lower(F.trim(phrase))
    one = F.array_position(F.array(*map(F.lit, ORDINALS)), F.regexp_extract(low, "([a-z]+)$", 1))
    tens = F.array_position(F.array(*map(F.lit, TENS)), low)
    stem = F.array_position(F.array(*(F.lit(t[:3]) for t in TENS)), F.when(low.rlike("^[a-z]+ty[- ][a-z]+$"), F.substring(low, 1, 3)).otherwise(""))
    out = F.when(tens > 0, (tens + 1) * 10).when((one > 0) & ~low.rlike("[- ]"), one).when((one.between(1, 9)) & (stem > 0), (stem + 1) * 10 + one)
    return out.cast("int")


CARDINALS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen")
CARDINAL_TENS = ("twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety")


def spelled_day(phrase: Column) -> Column:
    """``twenty-seventh``, also with a dash or space, is 27; null for no day of a month."""
    n = ordinal_number(F.regexp_replace(F.trim(phrase), r"[\s\u2010-\u2015-]+", "-"))
    return F.when(n.between(1, 31), n)


def spelled_year(phrase: Column) -> Column:
    """``eighteen hundred and sixty-six`` is 1866; null if a word is unknown or the year isn't 1800 to 2100."""
    values = {w: k + 1 for k, w in enumerate(CARDINALS)} | {w: 10 * k + 20 for k, w in enumerate(CARDINAL_TENS)}
    value = F.create_map(*(F.lit(x) for item in values.items() for x in item))
    words = F.filter(F.split(F.lower(phrase), "[^a-z]+"), lambda w: ~w.isin("", "and"))

    def step(s, w):
        scale = F.when(w == "thousand", 1000).when(w == "hundred", 100)
        done = s["done"] + F.when(scale.isNotNull(), F.greatest(s["open"], F.lit(1)) * scale).otherwise(0)
        return F.struct(done.alias("done"), F.when(scale.isNotNull(), F.lit(0)).otherwise(s["open"] + F.try_element_at(value, w)).alias("open"))

    year = F.aggregate(words, F.struct(F.lit(0).alias("done"), F.lit(0).alias("open")), step, lambda s: s["done"] + s["open"])
    return F.when(year.between(1800, 2100), year)


def lapse_date(text: Column) -> Column:
    """The day on which an act ``became a law``, spelled out after ``this`` or as ``Month day, year``.

    Between these words and the date no other act or chapter begins and no column line stands.
    """
    gap = r"(?:(?!\bAn\s+Act\b)(?!chap)[^|]){0,90}?"
    month = "(" + "|".join(f"{m}[a-z]*" for m in MONTHS) + ")"
    law = f"(?i){LAPSE}"
    spelled = rf"{law}{gap}\bthis\s+([a-z]+(?:[\s-]+[a-z]+)?)\s+day\s+of\s+{month}\s*,?\s*(?:A\.?\s*D\.?\s*,?\s*)?([a-z][a-z\s*.-]{{8,60}}?)\s*[.;,)]"
    digits = rf"{law}{gap}{month}\s+([0-9IlO]{{1,2}}(?:st|nd|rd|th)?)[,.]?\s*([0-9]{{4}})\b"
    a, b = (lambda k: F.regexp_extract(text, spelled, k)), (lambda k: F.regexp_extract(text, digits, k))
    date = lambda y, m, d: F.try_make_timestamp_ntz(y, m, d, F.lit(0), F.lit(0), F.lit(0)).cast("date")
    return F.coalesce(date(spelled_year(a(3)), month_number(a(2)), spelled_day(a(1))), date(b(3).try_cast("int"), month_number(b(1)), day_number(b(2))))


#: How far a date's year may be from the volume's, and words that lines of approval begin with. Before words
#: of several kinds stand their first two letters, so that most places of a text are passed by at once.
YEARS_NEAR = 4
APPROVAL = r"(?=[AF][pi])(?:Appro[a-z]{1,6}|Filed\s+with\s+Secr)"
APPROVAL_YEAR = r"(?is)(?=[AFP][piau])(?:Appro[a-z]{1,6}|Filed\s+with\s+Secr|Passed|Pussed|APry\b).{0,80}?\b(1[0-9]{3})\b"
AMENDED_YEAR = r"(?i)(?=[as][mt])(?:amend(?:atory|ed)?\s+[^;.]{0,60}?|Statutes\s+of\s+|Stats[.,]\s*)\b(1[0-9]{3})\b"
ANY_MONTH = "(?=[JFMASOND][aepuco])(?:January|February|March|April|May|June|July|August|September|October|November|December|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sept|Sep|Oct|Nov|Dec)"


def _without_one(s: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))))


def year_implausible(year: Column, volume_year: Column) -> Column:
    """Whether a year of four digits is over ``YEARS_NEAR`` from the volume's and was in use, or wasn't and has one digit
    in place of another of a year that is near."""
    y = year.try_cast("int")
    far = F.abs(y - volume_year) > YEARS_NEAR
    near = F.sequence(volume_year - YEARS_NEAR, volume_year + YEARS_NEAR)
    one_off = F.exists(near, lambda n: F.size(F.filter(F.sequence(F.lit(1), F.lit(4)), lambda i: F.substring(n.cast("string"), i, F.lit(1)) != F.substring(year, i, F.lit(1)))) == 1)
    return F.coalesce(far & (y.between(1848, 2010) | ((F.length(year) == 4) & one_off)), F.lit(False))


def date_damage(text: Column, approved: Column, volume_year: Column) -> Column:
    """What is wrong with an act's dates, as ``kind:value``, one of each kind.

    ``field_year``: the date's own year is implausible; ``text_year``: a year in a line of approval is, and the text
    doesn't name it as an amended act's; ``year_symbol``: three digits and a sign stand for a year; ``five_digits``: a
    year has a digit too many; ``day``: a month has a day over 31.
    """
    first = lambda a: F.get(a, F.lit(0))
    bad = lambda a: F.filter(a, lambda y: year_implausible(y, volume_year))
    # each search is named once: an expression that is named twice is computed twice
    unnamed = lambda years: F.array_except(years, F.regexp_extract_all(text, F.lit(AMENDED_YEAR), 1))
    in_text = F.filter(F.transform(F.array(bad(F.regexp_extract_all(text, F.lit(APPROVAL_YEAR), 1))), lambda y: F.when(F.size(y) > 0, unnamed(y))), lambda y: y.isNotNull())
    symbol = F.regexp_extract_all(text, F.lit(rf"(?is){APPROVAL}.{{0,120}}?\b(1[0-9]{{2}}[^\d\s\w])"), 1)
    near = lambda y, more: F.abs(y.try_cast("int") - volume_year) <= YEARS_NEAR + more
    fives = F.filter(
        F.regexp_extract_all(text, F.lit(rf"(?is){APPROVAL}.{{0,120}}?\b(1[0-9]{{4}})\b"), 1),
        lambda y: near(F.substring(y, 1, 4), 1) | near(F.substring(y, 2, 4), 1) | F.exists(_without_one(y), lambda x: near(x, 0)),
    )
    day = first(F.filter(F.regexp_extract_all(text, F.lit(rf"(?i){ANY_MONTH}\s+(\d{{2,4}})\b"), 1), lambda d: d.try_cast("int") > 31))
    named = lambda kind, v: F.concat(F.lit(f"{kind}:"), v)
    own = first(bad(F.regexp_extract_all(F.coalesce(approved, F.lit("")), F.lit(r"\b(1[0-9]{3})\b"), 1)))
    return F.array_compact(F.array(named("field_year", own), named("text_year", first(first(in_text))), named("year_symbol", first(symbol)), named("five_digits", first(fives)), named("day", day)))
