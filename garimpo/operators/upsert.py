"""Incremental materialisation without a table format: keyed upserts, partition replacement, snapshots, history.

Plain functions give the new content of a table as a DataFrame; ``Target`` writes it as a new version and swaps the pointer
(``Versions``), so a reader never sees half a table and a plan may read the table it replaces.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from garimpo.workspace import Versions


def _match(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[k]) for k in keys))


def keyed_upsert(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` without the keys of ``delta``, and ``delta``. Only the delta's distinct keys meet the target."""
    touched = delta.select(*keys).distinct()
    return target.join(touched, _match(target, touched, keys), "left_anti").unionByName(delta, allowMissingColumns=True)


def replace_groups(target: DataFrame, source: DataFrame, affected: DataFrame, group: list[str], rebuild) -> DataFrame:
    """Recompute only the affected groups: ``rebuild(rows of source in them)`` takes the place of the target's rows."""
    touched = affected.select(*group).distinct()
    fresh = rebuild(source.join(touched, _match(source, touched, group), "left_semi"))
    return target.join(touched, _match(target, touched, group), "left_anti").unionByName(fresh)


def snapshot(current: DataFrame, source: DataFrame, keys: list[str], check: list[str], at: Column) -> DataFrame:
    """Slowly changing snapshot: rows whose checked columns changed or that are gone get a closing time, new ones are opened.

    current: keys, check, valid_from, valid_to (null while open). Closed rows are kept as they are."""
    closed, opened = current.filter("valid_to is not null"), current.filter("valid_to is null")
    s = source.select(*keys, *check).withColumn("__in", F.lit(True))
    both = opened.select(*keys, *(F.col(c).alias(f"__{c}") for c in check), "valid_from").withColumn("__was", F.lit(True)).join(s, keys, "full")
    same = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in check))
    kept = F.coalesce(F.col("__was") & F.col("__in") & same, F.lit(False))
    old = F.when(F.col("__was"), F.struct(*(F.col(f"__{c}").alias(c) for c in check), F.col("valid_from"), F.when(~kept, at).alias("valid_to")))
    new = F.when(F.col("__in") & ~kept, F.struct(*(F.col(c) for c in check), at.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to")))
    rows = both.select(*keys, F.explode(F.array_compact(F.array(old, new))).alias("r")).select(*keys, "r.*")
    return closed.select(rows.columns).unionByName(rows)


def versions_from_history(events: DataFrame, entity: str, attributes: list[str], at: str, first: Column, last: Column) -> DataFrame:
    """Event-time history: one row per (entity, version key) with its interval; late events widen or reorder the right version."""
    key = F.md5(F.concat_ws("|", *attributes))
    per = events.filter(F.col(entity).isNotNull()).groupBy(entity, key.alias("hash_atributos")).agg(*(F.max(a).alias(a) for a in attributes), F.min(at).alias("primeira"), F.max(at).alias("ultima"), F.count(F.lit(1)).alias("qtd"))
    w = Window.partitionBy(entity).orderBy("primeira", "hash_atributos")
    following = F.lead("primeira").over(w)
    number = F.row_number().over(w)
    return per.select(
        F.md5(F.concat(F.col(entity), F.lit("|"), F.col("hash_atributos"))).alias("sk"), entity, *attributes, number.alias("nr_versao"), F.when(number == 1, first).otherwise(F.col("primeira")).alias("inicio"), F.coalesce(following, last).alias("fim"), following.isNull().alias("vigente"), "primeira", "ultima", "qtd"
    )


def classify(stored: DataFrame, wanted: DataFrame, keys: list[str], content: list[str], stamp: list[str]) -> DataFrame:
    """keys and ``acao``: inserida, alterada (content hash), recarimbada (only the stamp differs), igual, removida."""
    hashed = lambda df, p: df.select(*keys, F.md5(F.to_json(F.struct(*content), {"ignoreNullFields": "false"})).alias(f"{p}h"), F.md5(F.to_json(F.struct(*stamp), {"ignoreNullFields": "false"})).alias(f"{p}s"))
    both = hashed(stored, "a").join(hashed(wanted, "b"), keys, "full")
    return both.select(*keys, F.when(F.col("ah").isNull(), "inserida").when(F.col("bh").isNull(), "removida").when(F.col("ah") != F.col("bh"), "alterada").when(F.col("as") != F.col("bs"), "recarimbada").otherwise("igual").alias("acao"))


class MassDelete(RuntimeError):
    pass


def guard_mass_delete(actions: DataFrame, limit: float = 0.05) -> dict[str, int]:
    """Counts by action; raises when more than ``limit`` of the stored rows would leave."""
    counts = {r["acao"]: r["n"] for r in actions.groupBy("acao").agg(F.count(F.lit(1)).alias("n")).collect()}  # five rows
    before = sum(n for a, n in counts.items() if a != "inserida")
    if before and counts.get("removida", 0) > limit * before:
        raise MassDelete(f"{counts['removida']} of {before} rows would leave")
    return counts


class Target:
    """A table of versions below one folder, kept as tiers: a base and a few deltas, each smaller than the one before.

    An upsert writes its delta only; two tiers are merged when the newer one has grown to half of the older one, so that a row is
    rewritten a number of times that grows with the logarithm of the loads, and a reader overlays as few tiers."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.versions = spark, Versions(spark, path)

    def read(self) -> DataFrame | None:
        now = self.versions.current()
        tiers = now["tables"].get("data", [])
        return self._overlay(tiers, now["keys"]) if tiers else None

    def _overlay(self, tiers: list[str], keys: list[str]) -> DataFrame:
        return reduce(lambda below, above: keyed_upsert(below, above, keys), (self.spark.read.parquet(t) for t in tiers))

    def write(self, df: DataFrame, **stamp) -> None:
        at = self.versions.stage("data", self.versions.current()["version"] + 1)
        df.write.parquet(at)
        self.versions.publish({"data": [at]}, stamp=stamp, keys=[], rows=[self.spark.read.parquet(at).count()])

    def upsert(self, delta: DataFrame, keys: list[str], **stamp) -> None:
        """delta's keys replace the rows of these keys; ``delta`` may have several rows of a key."""
        now = self.versions.current()
        number = now["version"] + 1
        tiers, rows = list(now["tables"].get("data", [])), list(now.get("rows", []))
        if tiers and now["keys"] not in ([], keys):
            raise ValueError(f"upserts by {now['keys']} and by {keys}")
        at = self.versions.stage("delta", number)
        delta.write.parquet(at)
        tiers.append(at)
        rows.append(self.spark.read.parquet(at).count())  # from the footers
        k = len(tiers) - 1
        weight = rows[k]
        while k and 2 * weight >= rows[k - 1]:
            k -= 1
            weight += rows[k]
        if k < len(tiers) - 1:  # one merge of all tiers that have come that near
            at = self.versions.stage("merged", number)
            self._overlay(tiers[k:], keys).write.parquet(at)
            tiers, rows = [*tiers[:k], at], [*rows[:k], self.spark.read.parquet(at).count()]
        self.versions.publish({"data": tiers}, stamp=stamp, keys=keys, rows=rows)

    def up_to_date(self, **stamp) -> bool:
        """Skip work by fingerprint: the last write carried the same stamp."""
        now = self.versions.current()
        return now["version"] > 0 and now.get("stamp") == stamp
