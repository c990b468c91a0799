"""Text, vector and display expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: letters with accents and what they are folded to
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
PLAIN = "aaaaaeeeeiiiiooooouuuucnAAAAAEEEEIIIIOOOOOUUUUCN"


def fold(c: Column) -> Column:
    """Lower case without accents, anything else squeezed to single blanks."""
    return F.trim(F.regexp_replace(F.lower(F.translate(c, ACCENTED, PLAIN)), r"[^a-z0-9]+", " "))


def word_count(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t == "", 0).otherwise(F.size(F.split(t, r"\s+")))


def token_estimate(c: Column, ratio: float) -> Column:
    return F.ceil(word_count(c) * F.lit(ratio))


def first_words(c: Column, n: int) -> Column:
    return F.array_join(F.slice(F.split(F.trim(c), r"\s+"), 1, n), " ")


def clean_label(c: Column, default: str) -> Column:
    return F.coalesce(F.nullif(F.upper(F.trim(c)), F.lit("")), F.lit(default))


def price_text(c: Column) -> Column:
    """1234.5 -> R$ 1.234,50"""
    return F.concat(F.lit("R$ "), F.translate(F.format_number(c, 2), ",.", ".,"))


def unit_text(c: Column, default: str) -> Column:
    """'R$ / 13 kg' -> '13 kg'"""
    return F.when(F.instr(c, "/") > 0, F.trim(F.substring_index(c, "/", -1))).otherwise(F.lit(default))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine_distance(a: Column, query: list[float]) -> Column:
    """Distance of a vector column to a constant vector; the constant's norm is taken once."""
    q = F.array(*(F.lit(float(x)) for x in query))
    norm = math.sqrt(sum(x * x for x in query))
    return F.lit(1.0) - dot(a, q) / (F.sqrt(dot(a, a)) * F.lit(norm))


# fixed values: roman numerals
_ROMAN = [(1000, "M"), (900, "CM"), (500, "D"), (400, "CD"), (100, "C"), (90, "XC"), (50, "L"), (40, "XL"), (10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I")]


def to_roman(n: int) -> str:
    out = ""
    for value, sign in _ROMAN:
        while n >= value:
            out, n = out + sign, n - value
    return out


def from_roman(text: str | None) -> int | None:
    t, total, k = (text or "").upper(), 0, 0
    for value, sign in _ROMAN:
        while t.startswith(sign, k):
            total, k = total + value, k + len(sign)
    return total if t and k == len(t) and to_roman(total) == t else None
