"""Exactly one copy of every message, by exact identifier dictionaries and sharded compressed bitmaps of seen identifiers.

Identifiers are dictionary-encoded exactly (no fingerprints): identifier -> (shard, code), codes dense within a shard. A
shard's seen identifiers are bits in blocks of 32,768 (Spark's bitmap functions; Parquet compresses the blocks). One batch:

1. one winner per identifier: a partial aggregate on the map side, so that an identifier with a third of all rows costs one
   row per map task, then one shuffle of narrow rows;
2. winners get their codes from the dictionary, new identifiers new codes;
3. a winner whose bit is unset is selected; the blocks with new bits are written, to be or-ed with the old ones;
4. dictionary, bitmaps and kept rows become visible together (one pointer swap).

Policies: ``first`` keeps what an earlier batch kept and refuses later copies (a stream). Inside a batch the row with the
greatest ``order`` wins; in bulk (one batch, or batches from the newest to the oldest) that is the last one overall.

Defined cases: rows without identifier are no copies of anything and are always kept; nulls in ``order`` sort lowest; rows equal in
all ``order`` columns are one arrival (``copies`` counts them): they stay or go together. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from garimpo.workspace import Versions, cut, fresh

#: Bits in a block of Spark's bitmap functions (fixed there).
BLOCK_BITS = 32768
#: parts of the bitmaps that are read side by side before they become one
MERGE = 8


def _bit(bitmap, position):
    """The bit at ``position`` of a block."""
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


class SeenState:
    """shards: more of them allow more identifiers at once to get codes; one shard's new identifiers are numbered by one task."""

    def __init__(self, spark: SparkSession, path: str | None = None, shards: int = 256):
        self.spark, self.versions = spark, Versions(spark, path or fresh(spark, "seen"))
        self.shards = self.versions.current().get("shards", shards)

    def dictionary(self) -> DataFrame:
        t = self.versions.table("dictionary")
        return self.spark.createDataFrame([], "id string, shard int, code bigint") if t is None else t.select("id", "shard", "code")

    def bitmaps(self) -> DataFrame:
        parts = self.versions.current()["tables"].get("bitmaps", [])
        if not parts:
            return self.spark.createDataFrame([], "shard int, block bigint, bits binary")
        t = self.spark.read.parquet(*parts)
        return t if len(parts) == 1 else t.groupBy("shard", "block").agg(F.bitmap_or_agg("bits").alias("bits"))

    def admit(self, rows: DataFrame, identifier: str, order: list[str]) -> DataFrame:
        """rows: the batch. Returns the kept rows (identifier and order columns) after publishing the new state."""
        old = self.versions.current()
        number = old["version"] + 1
        known = rows.filter(F.col(identifier).isNotNull())
        winners = known.groupBy(F.col(identifier).cast("string").alias("id")).agg(F.max(F.struct(*order)).alias("o"), F.count(F.lit(1)).alias("copies"))
        shard = F.pmod(F.xxhash64("id"), F.lit(self.shards)).cast("int")
        tables: dict = {}
        if old["tables"].get("dictionary"):
            have = self.dictionary()
            coded = cut(winners.join(have, "id", "left"), "coded")
            base = have.groupBy("shard").agg((F.max("code") + 1).alias("base"))
            new = coded.filter(F.col("code").isNull()).drop("shard", "code").withColumn("shard", shard).join(F.broadcast(base), "shard", "left")  # at most one row a shard
        else:
            new = winners.withColumn("shard", shard).withColumn("base", F.lit(0).cast("bigint"))
        numbered = new.withColumn("code", F.coalesce("base", F.lit(0)) + F.row_number().over(Window.partitionBy("shard").orderBy("id")) - 1).drop("base")
        at = self.versions.stage("admitted", number)
        numbered.select("id", "shard", "code", "o", "copies").write.parquet(at)
        numbered = self.spark.read.schema(T.StructType([*(f for f in numbered.select("id", "shard", "code", "o", "copies").schema)])).parquet(at)
        tables["dictionary"] = [*old["tables"].get("dictionary", []), at]
        if old["tables"].get("dictionary"):
            # identifiers the dictionary knows: only those whose bit is unset are new
            prior = coded.filter(F.col("code").isNotNull()).withColumn("block", F.bitmap_bucket_number(F.col("code") + 1)).withColumn("__pos", F.bitmap_bit_position(F.col("code") + 1))
            unseen = prior.join(self.bitmaps(), ["shard", "block"], "left").filter(F.col("bits").isNull() | ~_bit(F.col("bits"), F.col("__pos"))).select("id", "shard", "code", "o", "copies")
            selected = numbered.unionByName(unseen)
        else:
            selected = numbered
        fresh_bits = selected.groupBy("shard", F.bitmap_bucket_number(F.col("code") + 1).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("code") + 1)).alias("bits"))
        # a batch writes the blocks with new bits only; a reader ors the parts, and they become one when there are many
        parts, bits_at = old["tables"].get("bitmaps", []), self.versions.stage("bitmaps", number)
        if len(parts) >= MERGE:
            fresh_bits, parts = fresh_bits.unionByName(self.bitmaps()).groupBy("shard", "block").agg(F.bitmap_or_agg("bits").alias("bits")), []
        fresh_bits.write.parquet(bits_at)
        tables["bitmaps"] = [*parts, bits_at]
        self.versions.publish(tables, shards=self.shards)
        return selected.select(F.col("id").alias(identifier), "o.*", "copies")


def deduplicate(rows: DataFrame, identifier: str, order: list[str], state: SeenState | None = None, shards: int = 256, batch: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped) as identifier and order columns; ``order`` must end in columns that tell the rows apart.

    ``batch``: the load of a row, growing with ``order`` (a list as long as there are loads is held on the driver). Loads go to the state from the newest
    to the oldest, nulls last, so that the bits of newer ones refuse the copies in older ones; without it all rows are one batch.

    The dropped rows are found by the rows' own key (``order``), never by the identifier: no hot identifier meets in one task."""
    spark = rows.sparkSession
    state = state or SeenState(spark, shards=shards)
    if batch is None:
        narrow = cut(rows.select(identifier, *order), "arrivals")
        kept = state.admit(narrow, identifier, order).select(identifier, *order)
    else:
        loads, path = rows.select(identifier, *order, batch.alias("__batch")), fresh(spark, "arrivals")
        loads.write.partitionBy("__batch").parquet(path)  # each batch reads its own rows
        narrow = spark.read.schema(loads.schema).parquet(path)
        numbers = sorted((r[0] for r in narrow.select("__batch").distinct().collect()), key=lambda n: (n is not None, n or 0), reverse=True)
        kept = spark.createDataFrame([], rows.select(identifier, *order).withColumn(identifier, F.col(identifier).cast("string")).schema)
        for n in numbers:
            kept = kept.unionByName(state.admit(narrow.filter(F.col("__batch").eqNullSafe(F.lit(n))).drop("__batch"), identifier, order).select(identifier, *order))
        kept, narrow = cut(kept, "kept"), narrow.drop("__batch")
    same = None
    left, right = narrow.filter(F.col(identifier).isNotNull()), kept.select(*(F.col(c).alias(f"__{c}") for c in order))
    for c in order:
        e = left[c].eqNullSafe(right[f"__{c}"])
        same = e if same is None else same & e
    dropped = left.join(right, same, "left_anti").select(identifier, *order)
    return kept.unionByName(narrow.filter(F.col(identifier).isNull()).select(identifier, *order)), dropped
