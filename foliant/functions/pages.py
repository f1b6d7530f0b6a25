"""Signals of whole pages, of misread headings and of damaged numerals, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mark pages.
MONEY_WORDS = ("dollars", "appropriated", "appropriation", "thousand", "hundred", "salary", "sum", "expended")
INDEX_WORDS = ("index", "contents", "table")
ROSTER_WORDS = (
    "index", "officers", "members", "contents", "roster", "list", "assembly", "senate", "name", "names", "counties", "represented",
    "residence", "residences", "district", "districts", "post", "office", "nativity", "occupation",
)
ROSTER_STATUTE_WORDS = ("section", "chapter", "approved", "whereas", "act", "shall", "enact", "provided", "sec", "title")

# Patterns of key words' spellings that only a misreading gives.
CHAPTER_GARBLES = r"(?im)^(?:CHAPTEN|CHAPIER|CHAPTKR|CHAPTR|CHAPTFR|CHAPT\b)"
SECTION_GARBLES = r"(?m)^[ \t]*(?:Ncction|SEcTION|SECIION|SEcTlON|SECHON|SECTON|SECTIOX)\b"
APPROVAL_GARBLES = (
    r"(?i)(?=[ALJFWPS][pauiye])\b(?:Approwee[a-z]+|Appioved|Appi[ao]ved|LAppi[a-z]+|Apyi|JApprove[a-z]*|Approyed|Fuled\s+with\s+Secretary"
    r"|Fuld\s+with\s+Secretary|Wiled\s+with\s+Secretary|Puled\s+with\s+Secretary|Fy\s+Governor|Secreiary|Secrelary)\b"
)

# Patterns of how an act became law.
VETO = (
    r"(?i)over\s+the\s+Governor'?s?\s+objection|constitutional\s+majority\s+of\s+both\s+Houses|notwithstanding\s+the\s+objections?\s+of\s+the\s+Governor"
    r"|notwithstanding\s+the\s+veto\s+of\s+the\s+Governor|Passed\s+the\s+(?:Assembly|Senate)\s+notwithstanding"
)
LAPSE = r"bec[ao]me(?:s)?\s+(?:a\s+)?law(?!\s+effective)(?!\s+operative)(?!\s+on\s+or\s+before)"

# Shares and counts by which a page is a roster or an index.
FEW_MARKERS, STATUTE_FEW, NAMES_MANY, STATUTE_SCARCE, GARBLED_MANY, NAMES_SOME, PLACES_SOME, STATUTE_LITTLE, ENTRIES = 2, 0.008, 0.35, 0.003, 0.15, 0.18, 0.012, 0.005, 5


def count_of(toks: Column, words: tuple[str, ...]) -> Column:
    return F.size(F.filter(toks, lambda t: t.isin(*words)))


def has_phrase(toks: Column, phrase: str) -> Column:
    """Whether words stand in a row among tokens without spaces."""
    return F.concat(F.lit(" "), F.array_join(toks, " "), F.lit(" ")).contains(f" {phrase} ")


def page_decision(toks: Column) -> Column:
    """(decision, why) of a page that its shape calls no body: BODY where its words say otherwise, NONBODY where they
    confirm it, else AMBIGUOUS; so too without text."""
    has = lambda *w: count_of(toks, w) > 0
    enacting = has("enacted") | has_phrase(toks, "people of the state")  # "be it enacted" has the word too
    grant = has("dollars") & ((count_of(toks, MONEY_WORDS) >= 2) | has("appropriated"))
    numbered = has("chapter", "chap") & has("section", "sec", "sections")
    index = (count_of(F.slice(toks, 1, 16), INDEX_WORDS) > 0) | has_phrase(F.slice(toks, 1, 30), "title of act")
    why = (
        F.when(toks.isNull() | (F.size(toks) == 0), "no_text")
        .when(enacting, "rescued:enacting")
        .when(grant, "rescued:approp")
        .when(numbered, "rescued:chapsec")
        .when(index, "confirmed")
        .otherwise("no_signal")
    )
    decision = F.when(why.startswith("rescued"), "BODY").when(why == "confirmed", "NONBODY").otherwise("AMBIGUOUS")
    return F.struct(decision.alias("decision"), why.alias("why"))


def roster_signs(toks: Column) -> Column:
    """What the rules ask of a page's tokens: share of statutes' words, markers, entries, and whether it is titled so."""
    statute = F.try_divide(count_of(toks, ROSTER_STATUTE_WORDS), F.size(toks))
    markers = F.size(F.array_intersect(F.slice(toks, 1, 40), F.array(*map(F.lit, ROSTER_WORDS))))
    entries = F.size(F.filter(toks, lambda t, k: (t == "an") & (F.get(toks, k + 1) == "act")))
    head = F.slice(toks, 1, 20)
    titled = F.size(F.filter(head, lambda t, k: (t == "title") & (F.get(head, k + 1).isin("act", "acts") | F.get(head, k + 2).isin("act", "acts")))) > 0
    return F.struct(statute.alias("statute"), markers.alias("markers"), entries.alias("entries"), titled.alias("titled"))


def roster_rule(toks: Column, garbled: Column, names: Column, places: Column) -> Column:
    """The first rule by which a page is a roster or an index, null for a body page.

    ``garbled``, ``names`` and ``places`` are shares of its tokens.
    """
    return rule_of_signs(roster_signs(toks), garbled, names, places)


def rule_of_signs(signs: Column, garbled: Column, names: Column, places: Column) -> Column:
    """:func:`roster_rule` by a page's :func:`roster_signs`."""
    statute, markers, entries, titled = (signs[c] for c in ("statute", "markers", "entries", "titled"))
    return (
        F.when((markers >= FEW_MARKERS) & (statute < STATUTE_FEW), "R1_marker")
        .when((names > NAMES_MANY) & (statute < STATUTE_SCARCE), "R2_names")
        .when((garbled >= GARBLED_MANY) & (names >= NAMES_SOME) & (places >= PLACES_SOME) & (statute < STATUTE_LITTLE), "R3_fingerprint")
        .when((entries >= ENTRIES) & titled, "R4_titles")
    )


def misread_heading(line: Column) -> Column:
    """The number in a heading such as ``CIIAPTER 1O2.``: a word within two edits of CHAPTER and a number with at least
    one digit. Null for other lines and for references such as ``chapter 12 of``."""
    parts = r"^[^A-Za-z0-9]{0,4}([A-Za-z]{5,9})[^A-Za-z0-9]{0,3}([0-9OoIlij]{1,4})\b(.*)$"
    part = lambda k: F.regexp_extract(line, parts, k)
    is_heading = (part(2) != "") & (F.levenshtein(F.upper(part(1)), F.lit("CHAPTER")) <= 2) & part(2).rlike("[0-9]") & ~part(3).rlike(r"(?i)^\s*\.?\s+of\b")
    return F.when(is_heading, F.translate(part(2), "OoIlij", "001111").try_cast("int"))


def damaged_numbers(text: Column) -> Column:
    """How many tokens of 3 to 10 letters and digits mix both; ordinals, numbers with a short ending or a short
    beginning of letters don't count."""
    mixed = lambda t: t.rlike("[0-9]") & t.rlike("[A-Za-z]") & ~t.rlike("(?i)^[0-9]+(?:st|nd|rd|th|[a-z]{1,2})$") & ~t.rlike("^[A-Za-z]{1,3}[0-9]+$")
    return F.size(F.filter(F.regexp_extract_all(text, F.lit(r"\b(?=[A-Za-z]{0,9}[0-9])[A-Za-z0-9]{3,10}\b"), 0), mixed))


def surely_damaged(text: Column) -> Column:
    """Whether a letter stands between digits, or an o or l beside three digits or more."""
    return text.rlike(r"\b[0-9]+[a-wyzA-WYZ][0-9]+\b|\b[oOlI][0-9]{3,}\b|\b[0-9]{3,}[oOlI]\b")


def damaged_section(token: Column) -> Column:
    """Whether a section's number is misread: letters and digits mixed otherwise than in 12a, or a lone l, o, I or O."""
    t = F.regexp_replace(token, "[.,;:()]+$", "")
    fine = t.rlike(r"^[0-9]+([a-zA-Z]{1,2}|\.[0-9]+)?$")
    mixed = t.rlike(r"^[A-Za-z0-9]{2,}") & t.rlike("[0-9]") & t.rlike("[A-Za-z]")
    return ~fine & (mixed | t.isin("l", "o", "I", "O"))


def misread_keywords(text: Column) -> Column:
    """Which key words of a text are misread: ``chapter``, ``section``, ``approval``."""
    kinds = F.array(
        F.when(text.rlike(CHAPTER_GARBLES), "chapter"),
        F.when(text.rlike(SECTION_GARBLES), "section"),
        F.when(text.rlike(APPROVAL_GARBLES), "approval"),
    )
    return F.array_compact(kinds)


def enactment_path(text: Column) -> Column:
    """veto_override, unsigned_lapse or, of all other texts, approved; a veto goes before a lapse."""
    return F.when(text.rlike(VETO), "veto_override").when(text.rlike(f"(?i){LAPSE}"), "unsigned_lapse").otherwise("approved")
