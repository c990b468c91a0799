"""Keys and check digits as column expressions (JVM-side)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: what a null part of a surrogate key is written as
NULL_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column) -> Column:
    """md5 of the parts joined by '-', nulls as a sentinel."""
    return F.md5(F.concat_ws("-", *(F.coalesce(c.cast("string"), F.lit(NULL_PART)) for c in cols)))


def version_key(document: Column, *attributes: Column) -> Column:
    """Key of a version of a document: changes when any attribute does. Null without a document."""
    return F.md5(F.concat(document, F.lit("|"), F.md5(F.concat_ws("|", *attributes))))


def natural_key(*cols: Column) -> Column:
    return F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in cols))


def chunk_id(source: str, version: Column, text: Column) -> Column:
    return F.concat(F.lit(source + ":"), F.substring(F.md5(F.concat(version, F.lit("|"), text)), 1, 16))


def mod11(body: Column) -> Column:
    """Check digit over characters (their code less 48), weights 2 to 9 from the right."""
    terms = F.transform(F.sequence(F.lit(1), F.length(body)), lambda i: (F.ascii(F.substr(body, F.length(body) - i + 1, F.lit(1))) - 48) * (F.lit(2) + (i - 1) % 8))
    rest = F.aggregate(terms, F.lit(0), lambda s, x: s + x) % 11
    return F.when(rest < 2, 0).otherwise(11 - rest)


def access_key_ok(key: Column) -> Column:
    """44 characters whose last is the check digit of the others."""
    return F.coalesce((F.length(key) == 44) & key.rlike("^[0-9A-Z]{43}[0-9]$") & (mod11(F.substring(key, 1, 43)) == F.substring(key, 44, 1).cast("int")), F.lit(False))


def cnpj_ok(cnpj: Column) -> Column:
    """12 digits or letters and two check digits."""
    first, second = mod11(F.substring(cnpj, 1, 12)), mod11(F.substring(cnpj, 1, 13))
    return F.coalesce(cnpj.rlike("^[0-9A-Z]{12}[0-9]{2}$") & (first == F.substring(cnpj, 13, 1).cast("int")) & (second == F.substring(cnpj, 14, 1).cast("int")), F.lit(False))


def row_hash(*cols: Column) -> Column:
    """Content hash in which null differs from blank."""
    return F.md5(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}))


def too_long(limits: dict[str, int], schema) -> Column:
    """The flag of shifted rows: some text is longer than its column allows. Columns that are missing or no text are left out."""
    kinds = {f.name: f.dataType.typeName() for f in schema}
    parts = [F.coalesce(F.length(F.col(c)), F.lit(0)) > n for c, n in limits.items() if kinds.get(c) == "string"]
    return reduce(lambda a, b: a | b, parts, F.lit(False))
