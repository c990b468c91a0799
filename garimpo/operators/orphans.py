"""References to records that are missing, deleted or not there yet, as keyed state that is maintained incrementally.

State (Parquet below one folder, partitioned by period, see ``Versions``):

* ``index``: changes of the parent index, (dominio, periodo, chave, delta); a key is live while its deltas sum to more than 0;
* ``pending``: the orphans, (tabela, campo, periodo, linha_id, dominio, chave);
* ``snapshots``: the counts of orphans after each batch that asked for one.

``apply`` takes one batch of arrivals: new references probe the index, arriving parents resolve waiting orphans, deleted
parents reopen the references that used them. A key belongs to one period, so a batch reads and writes the periods it touches and
no others: what earlier loads left behind costs it nothing. A period's changes are merged once there are ``MERGE`` parts of them.

Cost of a batch: the distinct keys of the batch are shuffled once (counted on the map side first, so that a key with a third of
all rows is one row per map task), not the references. Only the keys found to be orphans travel back to the references;
that join's small side is broadcast by AQE if its measured size allows it, else shuffled, where AQE may split a hot key on
the references' side.

Defined cases: null periods are a period of their own; a null or empty key refers to nothing; a parent listed several times
is live until as many deletions have come; repeated references stay repeated; empty batches change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.workspace import Versions, fresh

KEY = ["dominio", "periodo", "chave"]
REFERENCE = ["tabela", "campo", "periodo", "linha_id", "dominio", "chave"]


def _same(a: DataFrame, b: DataFrame):
    """Null-safe on the period, plain on the rest."""
    return (a["dominio"] == b["dominio"]) & (a["chave"] == b["chave"]) & a["periodo"].eqNullSafe(b["periodo"])


#: parts of a period's index that are read side by side before they become one
MERGE = 8
INDEX = "dominio string, chave string, delta bigint, periodo int"
PENDING = "tabela string, campo string, linha_id bigint, dominio string, chave string, periodo int"
SNAPSHOT = "carga string, tabela string, campo string, periodo int, orfaos bigint, chaves bigint"


class OrphanState:
    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.versions = Versions(spark, path or fresh(spark, "orphans"))

    def _read(self, parts: list, ddl: str, periods: list | None = None) -> DataFrame:
        """parts: [folder, periods it is valid for]; periods: those wanted (all, if None). Other partitions are never opened."""
        out = None
        for at, valid in parts:
            wanted = valid if periods is None else [p for p in valid if p in periods]
            if wanted:
                known = [p for p in wanted if p is not None]
                test = F.col("periodo").isin(known) if known else F.lit(False)
                part = self.spark.read.schema(ddl).parquet(at).filter(test | F.col("periodo").isNull() if None in wanted else test)
                out = part if out is None else out.unionByName(part)
        return self.spark.createDataFrame([], ddl) if out is None else out

    def index(self) -> DataFrame:
        return self._read(self.versions.current()["tables"].get("index", []), INDEX)

    def pending(self) -> DataFrame:
        return self._read(self.versions.current()["tables"].get("pending", []), PENDING)

    def apply(self, arrived: DataFrame | None = None, references: DataFrame | None = None, deleted: DataFrame | None = None, history: DataFrame | None = None, load: str | None = None) -> None:
        """arrived, deleted: parents (dominio, periodo, chave); references: REFERENCE columns.

        history: all references up to now, read only where parents were deleted, to find those that must be reopened. load: a name under which
        the counts after this batch are kept (``snapshots``)."""
        if deleted is not None and history is None:
            raise ValueError("deletions reopen references: pass the references seen so far as history")
        old = self.versions.current()
        number = old["version"] + 1
        index_parts, pending_parts = old["tables"].get("index", []), old["tables"].get("pending", [])
        changes = None
        for part, sign in ((arrived, 1), (deleted, -1)):
            if part is not None:
                p = part.filter(F.col("chave").isNotNull()).groupBy(*KEY).agg((F.count(F.lit(1)) * sign).alias("delta"))
                changes = p if changes is None else changes.unionByName(p)
        touched: set = set()
        if changes is not None:
            at = self.versions.stage("index", number)
            changes.write.partitionBy("periodo").parquet(at)
            changed = {r[0] for r in self.spark.read.schema(INDEX).parquet(at).select("periodo").distinct().collect()}  # periods: a calendar's worth
            touched |= changed
            changes = self.spark.read.schema(INDEX).parquet(at)
            index_parts = [*index_parts, [at, sorted(changed, key=str)]]
        asked = None
        if references is not None:
            # written: the probe and the way back read it, and a batch is the smaller side of everything here
            asked = references.filter(F.col("chave").isNotNull()).select(*KEY).distinct()
            touched |= {r[0] for r in asked.select("periodo").distinct().collect()}
        index = self._read(index_parts, INDEX, list(touched))

        pending = None
        if references is not None:
            live = index.groupBy(*KEY).agg(F.sum("delta").alias("n")).filter("n > 0")
            lost = asked.join(live, _same(asked, live), "left_anti")
            new = references.filter(F.col("chave").isNotNull()).select(*REFERENCE)
            pending = new.join(lost, _same(new, lost), "left_semi")
        waiting = self._read(pending_parts, PENDING, list(touched)).select(*REFERENCE)
        if changes is not None:
            keys = changes.select(*KEY).distinct()
            now = index.join(keys, _same(index, keys), "left_semi").groupBy(*KEY).agg(F.sum("delta").alias("n")).filter("n > 0")
            waiting = waiting.join(now, _same(waiting, now), "left_anti")
        pending = waiting if pending is None else pending.unionByName(waiting)
        if deleted is not None:
            gone = changes.groupBy(*KEY).agg(F.sum("delta").alias("by"))
            total = index.join(gone, _same(index, gone), "left_semi").groupBy(*KEY).agg(F.sum("delta").alias("n"))
            dead = total.join(gone, _same(total, gone)).filter("n <= 0 and n - by > 0").select(total["dominio"], total["periodo"], total["chave"])
            again = history.filter(F.col("chave").isNotNull()).select(*REFERENCE)
            pending = pending.unionByName(again.join(dead, _same(again, dead), "left_semi"))
        at = self.versions.stage("pending", number)
        pending.write.partitionBy("periodo").parquet(at)
        pending_parts = [[p, left] for p, valid in pending_parts if (left := [v for v in valid if v not in touched])] + [[at, sorted(touched, key=str)]]

        # periods whose index lies in many parts become one part
        many = [p for p in touched if sum(p in valid for _, valid in index_parts) >= MERGE]
        if many:
            merged = self.versions.stage("merged", number)
            self._read(index_parts, INDEX, many).groupBy(*KEY).agg(F.sum("delta").alias("delta")).filter("delta <> 0").write.partitionBy("periodo").parquet(merged)
            index_parts = [[p, left] for p, valid in index_parts if (left := [v for v in valid if v not in many])] + [[merged, sorted(many, key=str)]]
        tables = {"index": index_parts, "pending": pending_parts}
        if load is not None:
            counted = self.versions.stage("snapshot", number)
            self._counts(self._read(pending_parts, PENDING)).withColumn("carga", F.lit(load)).coalesce(1).write.parquet(counted)  # tables x fields x periods
            tables["snapshots"] = [*old["tables"].get("snapshots", []), counted]
        self.versions.publish(tables)

    @staticmethod
    def _counts(pending: DataFrame) -> DataFrame:
        return pending.groupBy("tabela", "campo", "periodo").agg(F.count(F.lit(1)).alias("orfaos"), F.countDistinct("chave").alias("chaves"))

    def snapshot(self) -> DataFrame:
        """The counts as they are now."""
        return self._counts(self.pending())

    def snapshots(self) -> DataFrame:
        """The counts after each load that was given a name."""
        at = self.versions.current()["tables"].get("snapshots", [])
        names = [f.split()[0] for f in SNAPSHOT.split(", ")]
        return (self.spark.read.parquet(*at) if at else self.spark.createDataFrame([], SNAPSHOT)).select(*names)
