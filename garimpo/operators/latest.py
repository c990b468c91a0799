"""Latest-per-key, previous values and set synchronisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order`` (a total order: end it with a tie-breaker). Keeps all columns.

    Spark prunes this window to one row per key before the shuffle (WindowGroupLimit), so a hot key costs one row per map task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def newest(df: DataFrame, keys: list[str], by: list[str], keep: list[str]) -> DataFrame:
    """The same by a hash aggregate: greatest ``by`` wins (nulls lowest). No sort; for few kept columns."""
    top = F.max(F.struct(*by, *(c for c in keep if c not in by))).alias("__top")
    return df.groupBy(*keys).agg(top).select(*keys, *(F.col("__top")[c].alias(c) for c in keep))


def latest_and_previous(df: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    """One row per key: latest and previous value, their difference, number of rows; one window, one aggregate."""
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.select(*keys, F.col(value).alias("__v"), F.row_number().over(w).alias("__rn"))
    pick = lambda n: F.max(F.when(F.col("__rn") == n, F.col("__v")))
    out = ranked.groupBy(*keys).agg(pick(1).alias("atual"), pick(2).alias("anterior"), F.count(F.lit(1)).alias("linhas"))
    return out.withColumn("variacao", F.col("atual") - F.col("anterior"))


def set_sync(wanted: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """keys and ``acao``: nova (only wanted), obsoleta (only stored), mantida (both). One full outer join on distinct keys."""
    a = wanted.select(*keys).distinct().withColumn("__a", F.lit(True))
    b = stored.select(*keys).distinct().withColumn("__b", F.lit(True))
    return a.join(b, keys, "full").select(*keys, F.when(F.col("__b").isNull(), "nova").when(F.col("__a").isNull(), "obsoleta").otherwise("mantida").alias("acao"))
