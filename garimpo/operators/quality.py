"""Data tests as plans that return failing rows, anomaly checks, and the configured check runner.

A test never collects: it is a DataFrame of failures, empty if the table is sound; ``quarantine`` stores it. The check runner reduces
scalars to a status on the driver (one row per check).
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once; nulls do not count as equal."""
    return df.dropna(subset=columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Null passes."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    rows = child.filter(F.col(column).isNotNull())
    keys = parent.select(F.col(key).alias("__key")).distinct()
    return rows.join(keys, rows[column] == keys["__key"], "left_anti")


def expression_is_true(df: DataFrame, test: Column) -> DataFrame:
    """A null result is no failure."""
    return df.filter(~test)


def accepted_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    c, bad = F.col(column), F.lit(False)
    if low is not None:
        bad = bad | ((c < low) if inclusive else (c <= low))
    if high is not None:
        bad = bad | ((c > high) if inclusive else (c >= high))
    return df.filter(bad)


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], tolerance: float = 0.0) -> DataFrame:
    """Keys whose ``valor`` differs between both sides or is on one side only."""
    both = left.select(*keys, F.col("valor").alias("esquerda")).join(right.select(*keys, F.col("valor").alias("direita")), keys, "full")
    return both.filter(F.col("esquerda").isNull() | F.col("direita").isNull() | (F.abs(F.col("esquerda") - F.col("direita")) > tolerance))


def zscore(series: DataFrame, by: list[str], at: str, value: str, training: int = 60, limit: float = 3.0) -> DataFrame:
    """Points that lie more than ``limit`` standard deviations off the mean of the ``training`` points before them."""
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(at).rowsBetween(-training, -1)
    scored = series.withColumn("media", F.avg(value).over(w)).withColumn("desvio", F.stddev_samp(value).over(w))
    z = (F.col(value) - F.col("media")) / F.nullif(F.col("desvio"), F.lit(0.0))
    return scored.withColumn("z", z).filter(F.abs("z") > limit)


def quarantine(failures: DataFrame, path: str) -> int:
    failures.write.mode("overwrite").parquet(path)
    return failures.sparkSession.read.schema(failures.schema).parquet(path).count()


# --- rules on scalars ----------------------------------------------------------------------------------------------------


def freshness(hours: float | None, warn: float, error: float) -> str:
    return "fail" if hours is None or hours > error else "warn" if hours > warn else "pass"


def threshold(value: float | None, low: float | None = None, high: float | None = None) -> str:
    return "fail" if value is None or (low is not None and value < low) or (high is not None and value > high) else "pass"


def reconciliation(left: float | None, right: float | None, tolerance: float) -> str:
    if left is None or right is None:
        return "fail"
    return "pass" if abs(left - right) / max(abs(left), 1) * 100 <= tolerance else "fail"


def gate(metrics: dict[str, float], baseline: dict[str, float], n: int, tolerance: int = 1) -> list[str]:
    """Metrics that fall below baseline by more than ``tolerance`` cases of ``n``. Better never fails; a missing baseline does."""
    return [m for m, v in metrics.items() if m not in baseline or v < baseline[m] - tolerance / n - 1e-12]


@dataclass
class Check:
    """measure: spark -> one or two scalars; rule: scalars -> status."""

    name: str
    measure: Callable[[SparkSession], tuple]
    rule: Callable[..., str]
    severity: str = "error"
    suspended: bool = False
    requires: str | None = None
    heavy: bool = False
    timeout: float = 300.0


def run_checks(spark: SparkSession, checks: list[Check], with_heavy: bool = True) -> list[dict]:
    """One dict per check. A missing relation is skipped; an error or timeout is reported; severity caps a failure."""
    out, status_of = [], {}
    for c in checks:
        began, value, message = time.time(), None, None
        if c.suspended or (c.heavy and not with_heavy) or (c.requires and status_of.get(c.requires) != "pass"):
            status = "skipped"
        else:
            group = f"check-{c.name}-{id(c)}"
            spark.sparkContext.setJobGroup(group, c.name, interruptOnCancel=True)
            timer = threading.Timer(c.timeout, spark.sparkContext.cancelJobGroup, [group])
            timer.start()
            try:
                scalars = c.measure(spark)
                value, status = scalars[0], c.rule(*scalars)
                if status == "fail" and c.severity == "warn":
                    status = "warn"
            except AnalysisException as e:
                missing = "TABLE_OR_VIEW_NOT_FOUND" in str(e) or "PATH_NOT_FOUND" in str(e)
                status, message = ("skipped" if missing else "error"), str(e)[:200]
            except Exception as e:
                status, message = "error", str(e)[:200]
            finally:
                timer.cancel()
                spark.sparkContext.setJobGroup("", "")
        status_of[c.name] = status
        out.append({"check": c.name, "status": status, "value": None if value is None else float(value), "message": message, "seconds": time.time() - began})
    return out
