"""Structured Streaming flows: files that arrive, late data, windows, stale runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.operators import shred
from garimpo.operators.upsert import Target
from garimpo.workspace import fresh


def run_available(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Everything that is there, in micro-batches, then stop; the checkpoint makes the next call go on from there."""
    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(batch).trigger(availableNow=True).start().awaitTermination()


def ingest_documents(spark: SparkSession, source: str, schema: str, target: Target, quarantine: str, checkpoint: str, keys: list[str], content: str, files_per_batch: int = 5000) -> None:
    """Arriving files of documents: well-formed ones are upserted by key, the others go to quarantine. A batch that is repeated
    after a failure leaves the same target (upsert) and the same quarantine folder (one per batch id)."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def batch(df: DataFrame, number: int) -> None:
        df = df.persist()
        try:
            found = shred.shred(df, keys, content, payload=False)
            bad = shred.rejects(found, keys).distinct()
            bad.write.mode("overwrite").parquet(f"{quarantine}/lote={number}")
            target.upsert(df.join(bad.select(*keys), keys, "left_anti").dropDuplicates(keys), keys)
        finally:
            df.unpersist()

    run_available(stream, batch, checkpoint)


def tumbling(events: DataFrame, at: str, by: list[str], size: str = "6 hours", late: str = "1 day") -> DataFrame:
    return events.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))


def once_within(events: DataFrame, id_: str, at: str, late: str = "1 day") -> DataFrame:
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark([id_])


def stale(runs: DataFrame, started: str, finished: str, now, hours: int = 6) -> DataFrame:
    """Runs without an end that began more than ``hours`` ago."""
    return runs.filter(F.col(finished).isNull() & (F.col(started) < now - F.expr(f"interval {hours} hours")))


def replay(df: DataFrame, name: str, parts: int) -> str:
    """A folder with the table in ``parts`` files: what a stream reads in tests and queries."""
    at = fresh(df.sparkSession, name)
    df.repartition(parts).write.parquet(at)
    return at
