"""Mixing sources to target weights, in blocks of equal token counts.

1. Every document's tokens are counted once by a public tokenizer, on its executor; what travels from there on is (document,
   source, tokens), written out once.
2. A source's documents are spread over shards by a seeded hash, as many shards as ``shard_tokens`` asks for, so a source with a
   third of all rows is many tasks. Within a shard documents stand in seeded order and its tokens are cut into blocks of ``block``.
3. Sainte-Laguë apportionment gives each source its blocks: the next block always goes to the source with the highest
   quotient share / (2 blocks + 1), capped at ``repeats`` times the blocks it has; what a capped source cannot take goes to the
   others by the same rule. Then each source's quota goes to its shards by the same method.
4. In a shard with b blocks and quota q each block is taken q div b times, and q mod b blocks, by seeded rank, once more.

The apportionment works on one number per source and one per shard (a shard is ``shard_tokens`` tokens), never on documents. It
finds the divisor by bisection and then gives out the last few blocks one by one: exact, and independent of the number of blocks.

Defined cases: null and empty texts have no tokens; documents of sources without a target count in the total and are never
taken; sources without documents get nothing and their share goes to the others; all sources capped: the mix is smaller than asked for;
ties go to the source that sorts first; the last incomplete block of a shard (fewer than ``block`` tokens) is no block: it is never taken
and reported as ``resto``, so a source with fewer tokens than a block gives nothing; repeated documents are separate documents; a target of 0 or less, or null, gets nothing.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from garimpo.workspace import cut


@dataclass(frozen=True)
class Mix:
    #: vocabulary of a public tokenizer (rank file)
    vocabulary: str = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
    #: tokens in a block
    block: int = 256
    #: tokens a shard holds, about
    shard_tokens: int = 20_000_000
    seed: int = 17


def encoder(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def source_key(c):
    """Spellings of a source: case, blanks around, hyphens for underscores."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(c)), r"[\s-]+", "_"), F.lit(""))


def count_tokens(docs: DataFrame, doc_id: str, text: str, source: str, p: Mix) -> DataFrame:
    """(doc_id, fonte, tokens)"""
    kind = docs.select(doc_id).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(p.vocabulary).encode_ordinary
        for batch in batches:
            tokens = [len(encode(t)) if t else 0 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tokens, pa.int64())], names=["doc_id", "fonte", "tokens"])

    return docs.select(doc_id, source_key(F.col(source)).alias("fonte"), text).mapInArrow(run, f"doc_id {kind}, fonte string, tokens bigint")


def sainte_lague(weights: list[float], seats: int, caps: list[int]) -> list[int]:
    """Seats by highest quotients weight / (2 given + 1), none above its cap. Ties go to the first."""
    caps = [c if w > 0 else 0 for w, c in zip(weights, caps)]
    seats = min(seats, sum(caps))
    if seats <= 0:
        return [0] * len(weights)
    given = lambda divisor: [min(c, int(w / divisor + 0.5)) if c else 0 for w, c in zip(weights, caps)]
    high = 2.0 * max(w for w, c in zip(weights, caps) if c) + 1  # high gives nothing
    low = min(w for w, c in zip(weights, caps) if c) / (2.0 * max(caps) + 2)  # low gives everyone the cap
    for _ in range(200):
        middle = (low + high) / 2
        if sum(given(middle)) > seats:
            low = middle
        else:
            high = middle
    out = given(high * (1 + 1e-9))  # a little less, so that ties are settled by the rule below
    heap = [(-w / (2 * out[k] + 1), k) for k, w in enumerate(weights) if out[k] < caps[k]]
    heapq.heapify(heap)
    for _ in range(seats - sum(out)):
        _, k = heapq.heappop(heap)
        out[k] += 1
        if out[k] < caps[k]:
            heapq.heappush(heap, (-weights[k] / (2 * out[k] + 1), k))
    return out


@dataclass(frozen=True)
class Plan:
    """pieces: (fonte, shard, block, doc_id, de, ate); quotas: (fonte, shard, blocks, quota); sources: one dict per target."""

    pieces: DataFrame
    quotas: DataFrame
    sources: list[dict]
    total: int


def plan(docs: DataFrame, doc_id: str, text: str, source: str, targets: DataFrame, p: Mix = Mix()) -> Plan:
    """targets: (source, share_alvo, max_repeticoes)."""
    spark = docs.sparkSession
    counted = cut(count_tokens(docs, doc_id, text, source, p), "tokens")
    wanted: dict[str, tuple[float, int]] = {}
    for name, share, most in targets.select(source_key(F.col("source")), "share_alvo", "max_repeticoes").collect():  # one row per source
        if name and name not in wanted:
            wanted[name] = (share or 0.0, most or 0)
    names = sorted(wanted)
    total = counted.agg(F.sum("tokens")).first()[0] or 0
    have = {r["fonte"]: r["n"] for r in counted.filter(F.col("fonte").isin(names)).groupBy("fonte").agg(F.sum("tokens").alias("n")).collect()}
    shards = F.create_map(*(x for n in names for x in (F.lit(n), F.lit(max(1, -(-have.get(n, 0) // p.shard_tokens)))))) if names else F.create_map().cast("map<string,int>")
    usable = counted.filter(F.col("fonte").isin(names) & (F.col("tokens") > 0)).withColumn("shard", F.pmod(F.xxhash64(F.lit(p.seed), "doc_id"), shards[F.col("fonte")].cast("bigint")).cast("int"))
    order = Window.partitionBy("fonte", "shard").orderBy(F.xxhash64(F.lit(p.seed + 1), "doc_id"), "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut(usable.withColumn("at", F.coalesce(F.sum("tokens").over(order), F.lit(0))), "placed")
    sizes = placed.groupBy("fonte", "shard").agg((F.sum("tokens") / p.block).cast("bigint").alias("blocks")).orderBy("fonte", "shard").collect()  # one row per shard
    blocks = {n: [(r["shard"], r["blocks"]) for r in sizes if r["fonte"] == n] for n in names}
    caps = [wanted[n][1] * sum(b for _, b in blocks[n]) for n in names]
    quotas = sainte_lague([wanted[n][0] for n in names], total // p.block, caps)
    rows, report = [], []
    for n, quota in zip(names, quotas):
        each = sainte_lague([float(b) for _, b in blocks[n]], quota, [wanted[n][1] * b for _, b in blocks[n]])
        rows += [(n, s, b, q) for (s, b), q in zip(blocks[n], each)]
        report.append({"source": n, "share_alvo": wanted[n][0], "tokens_disponiveis": have.get(n, 0), "resto": have.get(n, 0) - p.block * sum(b for _, b in blocks[n]), "tokens": quota * p.block, "max_repeticoes": wanted[n][1], "repeticoes": max((-(-q // b) for (_, b), q in zip(blocks[n], each) if b), default=0)})
    pieces = placed.withColumn("block", F.explode(F.sequence(F.expr(f"at div {p.block}"), F.expr(f"(at + tokens - 1) div {p.block}"))))
    start = F.col("block") * p.block
    pieces = pieces.select("fonte", "shard", "block", "doc_id", (F.greatest(start, F.col("at")) - F.col("at")).alias("de"), (F.least(start + p.block, F.col("at") + F.col("tokens")) - F.col("at")).alias("ate"))
    return Plan(pieces, spark.createDataFrame(rows, "fonte string, shard int, blocks bigint, quota bigint"), report, total)


def select(made: Plan, p: Mix = Mix()) -> DataFrame:
    """The mix: (source, shard, block, copia, doc_id, de, ate), tokens ``de`` to ``ate`` of the document."""
    every = made.quotas.filter("blocks > 0 and quota > 0").select("fonte", "shard", "blocks", "quota", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"))
    rank = F.row_number().over(Window.partitionBy("fonte", "shard").orderBy(F.xxhash64(F.lit(p.seed + 2), "shard", "block"), "block"))
    times = every.withColumn("copias", F.expr("quota div blocks") + F.when(rank <= F.col("quota") % F.col("blocks"), 1).otherwise(0)).filter("copias > 0").select("fonte", "shard", "block", F.explode(F.sequence(F.lit(1).cast("bigint"), "copias")).alias("copia"))
    return made.pieces.join(times, ["fonte", "shard", "block"]).select(F.col("fonte").alias("source"), "shard", "block", "copia", "doc_id", "de", "ate")


def texts(made: Plan, docs: DataFrame, doc_id: str, text: str, p: Mix = Mix()) -> DataFrame:
    """The mix as text: (source, shard, block, copia, doc_id, de, texto) of each piece, each document tokenized once for all of its pieces.

    A piece may begin or end within a character: its broken bytes become U+FFFD. A document's pieces are as many as its blocks and copies.
    ``doc_id`` should tell documents apart: pieces of a repeated id are cut from each of its rows."""
    fields = ["source", "shard", "block", "copia", "de", "ate"]
    of_doc = select(made, p).groupBy("doc_id").agg(F.collect_list(F.struct(*fields)).alias("pieces"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")).join(of_doc, "doc_id")
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *fields[:5], "texto"]
    types = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(p.vocabulary)
        for batch in batches:
            row, out = [], []
            for k, (t, pieces) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                tokens = e.encode_ordinary(t or "")
                for x in pieces:
                    row.append(k)
                    out.append((*(x[f] for f in fields[:5]), e.decode(tokens[x["de"] : x["ate"]])))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), *(pa.array([r[k] for r in out], ty) for k, ty in enumerate(types))], names=names)

    return rows.select("doc_id", "t", "pieces").mapInArrow(run, f"doc_id {kind}, source string, shard int, block bigint, copia bigint, de bigint, texto string")


def shares(made: Plan, p: Mix = Mix()) -> DataFrame:
    """Per source, from the pieces that were taken: tokens, actual share of the mix, greatest number of repetitions."""
    taken = select(made, p)
    got = taken.groupBy("source").agg(F.sum(F.col("ate") - F.col("de")).alias("tokens"), F.max("copia").alias("repeticoes"), F.countDistinct("shard", "block").alias("blocos"))
    asked = _targets(made)
    whole = F.sum(F.coalesce("tokens", F.lit(0))).over(Window.partitionBy(F.lit(0)))  # one row per source
    return asked.join(got, "source", "left").select("source", "share_alvo", "max_repeticoes", "tokens_disponiveis", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.round(F.coalesce("tokens", F.lit(0)) / F.when(whole > 0, whole), 6).alias("share_real"), F.coalesce("repeticoes", F.lit(0)).alias("repeticoes"), F.coalesce("blocos", F.lit(0)).alias("blocos"), "resto", F.lit(made.total).cast("bigint").alias("total"))


def _targets(made: Plan) -> DataFrame:
    spark = made.quotas.sparkSession
    return spark.createDataFrame([(r["source"], r["share_alvo"], r["max_repeticoes"], r["tokens_disponiveis"], r["resto"]) for r in made.sources], "source string, share_alvo double, max_repeticoes int, tokens_disponiveis bigint, resto bigint")
