"""Tokens and their shapes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PUNCTUATION = " \t\n\r.,;:!?\"'`()[]{}"


def tokens(text: Column) -> Column:
    """Runs of characters other than white space."""
    return F.filter(F.split(text, r"\s+"), lambda x: x != "")


def words(text: Column) -> Column:
    """Lower-case runs of letters."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), 0)


def vote_key(token: Column) -> Column:
    """A token without punctuation around it, in lower case."""
    return F.lower(F.btrim(token, F.lit(PUNCTUATION)))


def dehyphenated(text: Column) -> Column:
    """Words broken by a hyphen at a line's end put together."""
    return F.regexp_replace(text, r"(\p{L})-\n(\p{L})", "$1$2")


def normalised(text: Column) -> Column:
    """Lower case, runs of white space as one space, none around."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def error_rate(reference: Column, read: Column, most: int = 2000) -> Column:
    """Edits per character of the reference, both normalised and cut at ``most`` characters; 1 for an empty reference."""
    a, b = F.substring(normalised(reference), 1, most), F.substring(normalised(read), 1, most)
    return F.when(F.length(a) == 0, F.lit(1.0)).otherwise(F.levenshtein(a, b) / F.length(a))


def match_category(reference: Column, read: Column, found: Column) -> Column:
    """EXACT, NEAR (under 5 %), PARTIAL (under 30 %), MISMATCH, NULL_TEXT, or NO_VERSION where none was found."""
    rate = error_rate(reference, read)
    return F.when(~found, "NO_VERSION").when(read.isNull(), "NULL_TEXT").when(rate == 0, "EXACT").when(rate < 0.05, "NEAR").when(rate < 0.3, "PARTIAL").otherwise("MISMATCH")


def deletes(word: Column, edits: int = 1) -> Column:
    """The word and all that is left after up to ``edits`` characters are taken out."""

    def one(w: Column) -> Column:
        n = F.length(w)
        return F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, n)))

    out = level = F.array(word)
    for _ in range(edits):
        level = F.array_distinct(F.flatten(F.transform(level, one)))
        out = F.array_distinct(F.concat(out, level))
    return out


def one_edit(word: Column) -> Column:
    """All words of a to z at one deletion, swap of neighbours, substitution or insertion, without the word itself."""
    n = F.length(word)
    head = lambda i: F.substring(word, F.lit(1), i)
    tail = lambda i: F.substring(word, i + 1, n)
    cuts, letters = F.sequence(F.lit(0), n), F.split(F.lit("abcdefghijklmnopqrstuvwxyz"), "")
    each = lambda least, f: F.transform(F.filter(cuts, lambda i: n - i >= least), f)
    gone = each(1, lambda i: F.concat(head(i), tail(i + 1)))
    swapped = each(2, lambda i: F.concat(head(i), F.substring(word, i + 2, F.lit(1)), F.substring(word, i + 1, F.lit(1)), tail(i + 2)))
    changed = F.flatten(each(1, lambda i: F.transform(letters, lambda c: F.concat(head(i), c, tail(i + 1)))))
    added = F.flatten(each(0, lambda i: F.transform(letters, lambda c: F.concat(head(i), c, tail(i)))))
    return F.array_remove(F.array_distinct(F.concat(gone, swapped, changed, added)), word)


def within_one(a: Column, b: Column) -> Column:
    """Whether two words are at most one deletion, insertion, substitution or swap of neighbours apart."""
    n = F.length(a)
    swap = lambda i: F.concat(F.substring(a, F.lit(1), i - 1), F.substring(a, i + 1, F.lit(1)), F.substring(a, i, F.lit(1)), F.substring(a, i + 2, n))
    swapped = F.when((n == F.length(b)) & (n > 1), F.exists(F.sequence(F.lit(1), n - 1), lambda i: swap(i) == b)).otherwise(False)
    return F.levenshtein(a, b, 1).between(0, 1) | swapped


def vowel_ratio(word: Column) -> Column:
    return F.when(F.length(word) == 0, F.lit(0.0)).otherwise(F.length(F.regexp_replace(word, "[^aeiou]", "")) / F.length(word))


def longest_run(word: Column) -> Column:
    """The length of the longest run of one character."""
    return F.coalesce(F.array_max(F.transform(F.regexp_extract_all(word, F.lit(r"((.)\2*)"), 1), F.length)), F.lit(0))


def garbage_rule(word: Column) -> Column:
    """The rule by which an unknown word is garbage, roman or recoverable; the first that fits."""
    odd = F.length(F.regexp_replace(word, r"[\x00-\x7F]", ""))
    bare = ~word.rlike("[aeiouy]") & (F.length(word) >= 5)
    clump = word.rlike("[bcdfghjklmnpqrstvwxz]{5,}")
    return (
        F.when(word.rlike("^[ivxlcdm]{2,}$"), "roman")
        .when((odd > 1) | ((odd == 1) & (F.length(word) > 16)), "garbage_mojibake")
        .when(odd == 1, "recoverable")
        .when(word.rlike(r"(.)\1\1\1"), "garbage_repeat4")
        .when(word.rlike(r"(.)\1\1"), F.when(clump | bare, "garbage_repeat3").otherwise("recoverable"))
        .when(clump, "garbage_cons5")
        .when(bare, "garbage_novowel")
        .when(F.length(word) >= 25, "garbage_toolong")
        .otherwise("recoverable")
    )


def rating(raw: Column) -> Column:
    """A rating from free text: the answer itself, else the first name in it."""
    low = F.lower(F.trim(raw))
    return (
        F.when(low.isin("clean", "noisy_but_coherent", "garbage"), low)
        .when(low.contains("noisy"), "noisy_but_coherent")
        .when(low.contains("garbage"), "garbage")
        .when(low.contains("clean"), "clean")
        .otherwise("unknown")
    )


def parse_link(href: Column) -> Column:
    """(code, section) of a link's query, null where one is missing."""
    decoded = F.try_url_decode(href)
    part = lambda name: F.nullif(F.regexp_extract(decoded, f"[?&]{name}=([^&#]+)", 1), F.lit(""))
    return F.struct(part("lawCode").alias("code"), F.regexp_replace(part("sectionNum"), r"\.$", "").alias("section"))


def index_tokens(text: Column) -> Column:
    """Lower-case words of two letters or more, hyphenated ones whole and then in parts; control characters divide.

    The text should be composed (NFC).
    """
    plain = F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]", " ")
    found = F.regexp_extract_all(F.lower(plain), F.lit("[A-Za-z\u00c0-\u00ff]+(?:-[A-Za-z\u00c0-\u00ff]+)*"), 0)
    parts = F.flatten(F.transform(found, lambda w: F.when(w.contains("-"), F.concat(F.array(w), F.split(w, "-"))).otherwise(F.array(w))))
    return F.filter(parts, lambda w: F.length(w) >= 2)
