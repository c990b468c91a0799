"""Registry of named queries: each plan function is stored with the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Attribute access to the tables of a folder: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``plan(tables) -> DataFrame`` as a named query."""

    def keep(plan: Callable[[Tables], DataFrame]) -> Callable:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: plan(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return keep
