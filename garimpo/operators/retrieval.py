"""Vector search, chunk rows, context under a budget, and retrieval and answer metrics."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from garimpo.functions.keys import chunk_id
from garimpo.functions.text import cosine_distance


class Encoder(Protocol):
    """Anything that turns texts into vectors of one length."""

    def encode(self, texts: list[str]) -> list[list[float]]: ...


def embed(df: DataFrame, text: str, make: Callable[[], Encoder], prefix: str = "passage: ") -> DataFrame:
    """Adds ``embedding``, normalised to length 1; the encoder is built once per Python worker."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = make()
        for s in batches:
            v = np.asarray(encoder.encode([prefix + (x or "") for x in s]), dtype=np.float32).reshape(len(s), -1)
            norms = np.linalg.norm(v, axis=1, keepdims=True)
            yield pd.Series(list(v / np.where(norms > 0, norms, 1)))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn("embedding", F.pandas_udf(run, T.ArrayType(T.FloatType()))(F.col(text)))


def top_k(vectors: DataFrame, vector: str, id_: str, query: list[float], k: int, where: Column | None = None) -> DataFrame:
    """Exact nearest rows; ties by id. One scan, at most k rows leave each task."""
    rows = vectors if where is None else vectors.filter(where)
    return rows.withColumn("distancia", cosine_distance(F.col(vector), query)).orderBy("distancia", id_).limit(k)


def top_k_many(vectors: DataFrame, vector: str, id_: str, queries: DataFrame, k: int, block: int = 2000) -> DataFrame:
    """Exact nearest rows of a stated query set: (q, id, semelhanca, posicao); a row is no neighbour of its own id.

    queries: (q, v), read in blocks of ``block`` (the most that is held in memory and sent along), each block against all rows in one
    pass of matrix products. A task keeps k rows per query and Arrow batch, the window prunes again before its shuffle."""
    kind = vectors.select(id_).schema[0].dataType.simpleString()
    out, held = None, []

    def one(part: list) -> DataFrame:
        ids = np.array([r[0] for r in part])
        m = np.array([r[1] for r in part], np.float64)
        m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
        shared = vectors.sparkSession.sparkContext.broadcast((ids, m))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            q, mine = shared.value
            for b in batches:
                b = b[b["v"].notna()]
                if not len(b):
                    continue
                x = np.array(b["v"].tolist(), np.float64)
                x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
                near, other = mine @ x.T, b["i"].to_numpy()
                near[q[:, None] == other[None, :]] = -np.inf
                order = np.lexsort((np.broadcast_to(other, near.shape), -near), axis=1)[:, :k]
                rows = np.repeat(np.arange(len(q)), order.shape[1])
                found = pd.DataFrame({"q": q[rows], "id": other[order.ravel()], "semelhanca": near[rows, order.ravel()]})
                yield found[np.isfinite(found["semelhanca"])]

        return vectors.select(F.col(id_).alias("i"), F.col(vector).alias("v")).mapInPandas(run, f"q {kind}, id {kind}, semelhanca double")

    for row in queries.select("q", "v").filter("v is not null").toLocalIterator():
        held.append(row)
        if len(held) == block:
            out = one(held) if out is None else out.unionByName(one(held))
            held = []
    if held or out is None:
        last = one(held) if held else vectors.sparkSession.createDataFrame([], f"q {kind}, id {kind}, semelhanca double")
        out = last if out is None else out.unionByName(last)
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("semelhanca"), "id"))
    return out.withColumn("posicao", rank).filter(F.col("posicao") <= k)


def diversify(hits: DataFrame, rank: str, text: str, k: int, prefix: int = 80) -> DataFrame:
    """Of over-fetched hits the first of each text opening, then repeats to fill up to k. (hits: a top-k, small)"""
    rn = F.row_number().over(Window.partitionBy(F.substring(F.lower(text), 1, prefix)).orderBy(rank))
    return hits.withColumn("__again", rn > 1).orderBy("__again", rank).limit(k).drop("__again")


def sentence_chunks(facts: DataFrame, source: str, version: str, parts: list[tuple[str, str]], metadata: list[str]) -> DataFrame:
    """One sentence per fact: (label, column) pairs, missing values left out; deterministic id and JSON metadata."""
    said = [F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.concat(F.lit(label), F.col(c).cast("string"))) for label, c in parts]
    text = F.concat_ws(", ", *said)
    return facts.select(text.alias("texto"), F.to_json(F.struct(*metadata)).alias("metadados")).withColumn("chunk_id", chunk_id(source, F.lit(version), F.col("texto")))


def retrieval_metrics(results: DataFrame, k: int) -> DataFrame:
    """results: esperados array, obtidos array (in rank order). success@k (all found), hit@k (any), recall@k, MRR; means over the questions."""
    top = F.slice("obtidos", 1, k)
    found = F.array_intersect(F.col("esperados"), top)
    ranks = F.filter(F.transform("esperados", lambda e: F.array_position(F.col("obtidos"), e)), lambda x: x > 0)
    rank = F.array_min(ranks)
    n = F.size("esperados")
    return results.agg(
        F.avg((F.size(found) == n).cast("int")).alias("success"), F.avg((F.size(found) > 0).cast("int")).alias("hit"), F.avg(F.size(found) / n).alias("recall"), F.avg(F.coalesce(F.lit(1.0) / rank, F.lit(0.0))).alias("mrr"), F.count(F.lit(1)).alias("n")
    )


def answer_metrics(answers: DataFrame) -> DataFrame:
    """answers: respondivel, recusou boolean; citados, esperados array; segundos."""
    return answers.agg(
        F.avg((F.col("recusou") != F.col("respondivel")).cast("int")).alias("acerto_recusa"),
        F.count_if(~F.col("respondivel") & ~F.col("recusou")).alias("falsas_respostas"),
        F.count_if(F.col("respondivel") & F.col("recusou")).alias("falsas_recusas"),
        F.avg(F.when(F.size("citados") > 0, F.size(F.array_intersect("citados", "esperados")) / F.size("citados"))).alias("validade"),
        F.avg(F.when(F.size("esperados") > 0, F.size(F.array_intersect("citados", "esperados")) / F.size("esperados"))).alias("cobertura"),
        F.percentile("segundos", 0.5).alias("p50"),
        F.max("segundos").alias("pior"),
    )


def assemble(blocks: list[dict], anchors: list[str], budget: int, count: Callable[[str], int]) -> tuple[list[dict], list[str]]:
    """Context under a token budget: anchors first, then hits by rank, one block per article; a block too big tries its shorter
    forms (``formas``, longest first). Returns (kept, ids that were dropped). Works on a top-k."""
    order = sorted(range(len(blocks)), key=lambda k: (anchors.index(blocks[k]["art_id"]) if blocks[k]["art_id"] in anchors else len(anchors), k))
    kept, dropped, used, seen = [], [], 0, set()
    for k in order:
        b = blocks[k]
        if b["art_id"] in seen:
            continue
        fit = next((f for f in b["formas"] if used + count(f) <= budget), None)
        if fit is None:
            dropped.append(b["art_id"])
            continue
        seen.add(b["art_id"])
        used += count(fit)
        kept.append({"art_id": b["art_id"], "texto": fit, "inteiro": fit == b["formas"][0]})
    return kept, [d for d in dropped if d not in seen]


def pages(text: str, words: int = 400) -> list[str]:
    w = re.findall(r"[^ \t\n\r\f\v]+", text)
    return [" ".join(w[k : k + words]) for k in range(0, len(w), words)] or [""]


def read_reply(reply: str, allowed: set[str]) -> dict:
    """A model's reply: JSON anywhere in it, citations checked against the context; no valid citation is a refusal."""
    m = re.search(r"\{.*\}", reply or "", re.S)
    try:
        data = json.loads(m[0]) if m else {}
    except ValueError:
        data = {}
    cited = [c for c in data.get("citacoes", []) if isinstance(c, str)] if isinstance(data.get("citacoes", []), list) else []
    valid = [c for c in dict.fromkeys(cited) if c in allowed]
    text = data.get("resposta") if isinstance(data.get("resposta"), str) else None
    barrier = "formato" if not data else "sem resposta" if not (text or "").strip() else "sem citacao" if not valid else None
    return {"recusou": barrier is not None, "motivo": barrier, "resposta": text if barrier is None else None, "citacoes": valid, "invalidas": [c for c in cited if c not in allowed]}


def drift(before: DataFrame, now: DataFrame, key: str, verdict: str) -> DataFrame:
    """(key, situacao): igual, mudou, novo or sumiu, by one full outer join of two runs; null verdicts are equal."""
    a, b = before.select(F.col(key), F.col(verdict).alias("__a"), F.lit(True).alias("__was")), now.select(F.col(key), F.col(verdict).alias("__b"), F.lit(True).alias("__is"))
    same = F.when(F.col("__was").isNull(), "novo").when(F.col("__is").isNull(), "sumiu").when(F.col("__a").eqNullSafe(F.col("__b")), "igual").otherwise("mudou")
    return a.join(b, key, "full").select(key, same.alias("situacao"))
