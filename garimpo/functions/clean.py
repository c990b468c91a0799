"""Column expressions for codes, dates and numbers that arrive as free text (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What may stand around a value without meaning.
BLANKS = r"^[\s\u00A0]+|[\s\u00A0]+$"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, BLANKS, "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def cnpj14(c: Column) -> Column:
    """The 14 digits, or null if there are not exactly 14."""
    d = digits(c)
    return F.when(F.length(d) == 14, d)


def number_key(c: Column) -> Column:
    """Codes compared as numbers: digits only, no leading zeros; null if there is no digit."""
    return F.nullif(F.regexp_replace(digits(c.cast("string")), r"^0+(?=.)", ""), F.lit(""))


PRICE = r"^[+-]?[0-9]+(?:[.,][0-9]+)?$"


def price_ok(c: Column) -> Column:
    """Null, blank, or an optionally signed run of digits with at most one decimal mark between digits."""
    s = strip(c)
    return c.isNull() | (s == "") | s.rlike(PRICE)


def price(c: Column) -> Column:
    s = strip(c)
    return F.when(s.rlike(PRICE), F.replace(s, F.lit(","), F.lit(".")).cast("double"))


def date_br(c: Column) -> Column:
    """A real calendar date written dd/MM/yyyy, else null."""
    s = strip(c)
    return F.when(s.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), F.try_to_date(s, "dd/MM/yyyy"))


def zfill(c: Column, n: int) -> Column:
    """Pad with zeros on the left; unlike lpad it never truncates."""
    return F.when(F.length(c) < n, F.lpad(c, n, "0")).otherwise(c)
