"""Roman and misread numerals as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}
CANONICAL = "^(M{0,3})(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$"
#: Additive spellings such as VIIII are plausible too.
ADDITIVE = "^M{0,4}(CM|CD|D?C{0,4})(XC|XL|L?X{0,4})(IX|IV|V?I{0,4})$"
LARGEST = 5000


def _digit(c: Column) -> Column:
    out = F.lit(0)
    for letter, value in ROMAN.items():
        out = F.when(c == letter, value).otherwise(out)
    return out


def roman_to_int(text: Column) -> Column:
    """From right to left, a smaller digit before a larger one is taken off; other characters count as 0."""
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("last"))

    def step(s, c):
        v = _digit(c)
        return F.struct((s["total"] + F.when(v < s["last"], -v).otherwise(v)).alias("total"), F.greatest(v, s["last"]).alias("last"))

    letters = F.reverse(F.filter(F.split(F.upper(text), ""), lambda c: c != ""))
    return F.aggregate(letters, start, step, lambda s: s["total"])


def int_to_roman(n: Column) -> Column:
    """For 1 to 3999, else null."""
    place = lambda digits, div: F.element_at(F.array(*map(F.lit, digits)), (F.floor(n / div) % 10 + 1).cast("int"))
    ones = ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"]
    tens = ["", "X", "XX", "XXX", "XL", "L", "LX", "LXX", "LXXX", "XC"]
    hundreds = ["", "C", "CC", "CCC", "CD", "D", "DC", "DCC", "DCCC", "CM"]
    thousands = ["", "M", "MM", "MMM", "", "", "", "", "", ""]
    return F.when(n.between(1, 3999), F.concat(place(thousands, 1000), place(hundreds, 100), place(tens, 10), place(ones, 1)))


def canonical_roman(text: Column) -> Column:
    """The value of a well-formed numeral, else null."""
    up = F.upper(F.trim(text))
    return F.when((up != "") & up.rlike(CANONICAL), roman_to_int(up))


def misread_numeral(text: Column) -> Column:
    """The value of a numeral in which look-alikes stand for letters; 0 if there is none or it is over ``LARGEST``.

    Digits are taken as they are; otherwise ``l J T 1 ! |`` are read as I, and an L at the end after an I as I.
    """
    bare = F.regexp_replace(F.trim(text), r"[.,;:]+$", "")
    roman = F.regexp_replace(F.upper(F.translate(bare, "lJT1!|", "IIIIII")), "(I+)L$", "$1I")
    value = F.when(bare.rlike("^[0-9]{1,9}$"), bare.try_cast("int")).when(roman.rlike("^[IVXLCDM]+$"), roman_to_int(roman)).otherwise(0)
    return F.when(value.between(1, LARGEST), value).otherwise(0)


def plausible(text: Column) -> Column:
    """Whether a numeral is 1 to ``LARGEST`` in digits or an additive Roman numeral."""
    up = F.upper(F.trim(text))
    digits = up.try_cast("int")
    return F.coalesce(F.when(up.rlike("^[0-9]+$"), F.coalesce(digits.between(1, LARGEST), F.lit(False))).otherwise((up != "") & up.rlike(ADDITIVE)), F.lit(False))


def clean(raw: Column, n: Column) -> Column:
    """Whether a raw numeral, Arabic or Roman, evaluates to n itself."""
    up = F.upper(F.trim(raw))
    return F.coalesce(F.when(up.rlike("^[0-9]{1,9}$"), up.try_cast("int") == n).otherwise(canonical_roman(up) == n), F.lit(False))


def one_digit_too_many(raw: Column, n: Column) -> Column:
    """Whether leaving out one character of ``raw`` gives n."""
    size = F.length(raw)
    cut = lambda i: F.concat(F.substring(raw, F.lit(1), i - 1), F.substring(raw, i + 1, size))
    return F.when(size > 1, F.exists(F.sequence(F.lit(1), size), lambda i: cut(i) == n.cast("string"))).otherwise(False)
