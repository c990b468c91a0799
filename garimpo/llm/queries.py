"""The queries p5_, p7_, p8_ and p9_."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.functions.clean import cnpj14
from garimpo.llm import addresses, langid, leakage, mixing
from garimpo.plans.problems import anp_ok
from garimpo.plans.tables import table


def _stations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "anp_landing_semanal").filter(anp_ok()).withColumn("__cnpj", cnpj14(F.col("cnpj_da_revenda")))


def p5_locations(spark: SparkSession, d: str) -> DataFrame:
    """One row per CNPJ and location that it shares with another: pairs are what this is joined with itself."""
    found = addresses.locations(_stations(spark, d), "__cnpj", ["estado_sigla", "municipio"], "nome_da_rua", "numero_rua", "complemento")
    return found.select(F.col("owner").alias("cnpj"), F.col("component").alias("local"))


def p5_units(spark: SparkSession, d: str) -> DataFrame:
    """As p5_found, but two different known units (shop, block, room) are two places."""
    return addresses.same_location(_stations(spark, d), "__cnpj", ["estado_sigla", "municipio"], "nome_da_rua", "numero_rua", "complemento", unit_veto=True).select(F.col("a").alias("cnpj_a"), F.col("b").alias("cnpj_b"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    rows = _stations(spark, d)
    return addresses.same_location(rows, "__cnpj", ["estado_sigla", "municipio"], "nome_da_rua", "numero_rua", "complemento").select(F.col("a").alias("cnpj_a"), F.col("b").alias("cnpj_b"))


def p7_scores(spark: SparkSession, d: str) -> DataFrame:
    """Every candidate pair that shares enough words, with the share of the item it holds."""
    found = leakage.scores(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_itens"), "item_id", "texto")
    return found.select("doc_id", "item_id", F.round("coberto", 6).alias("coberto"), F.round("proprio", 6).alias("proprio"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_itens"), "item_id", "texto")


def _languages(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return langid.stretches(docs, "doc_id", "text", "lang", langid.fit(docs, "doc_id", "text", "lang"))


def _verdict(lang, confidence):
    return F.when(confidence >= langid.Settings().reject, lang).otherwise("und").alias("veredito")


def p9_segments(spark: SparkSession, d: str) -> DataFrame:
    """Each stretch of each document with its language and confidence; a language below the calibrated bound is refused ("und")."""
    return _languages(spark, d).select("doc_id", F.explode("trechos").alias("t")).select("doc_id", "t.inicio", "t.fim", "t.lang", F.round("t.confianca", 4).alias("confianca"), _verdict(F.col("t.lang"), F.col("t.confianca")))


def p9_documents(spark: SparkSession, d: str) -> DataFrame:
    return _languages(spark, d).select("doc_id", "rotulo", "lang", F.round("confianca", 4).alias("confianca"), _verdict(F.col("lang"), F.col("confianca")), F.size("trechos").alias("trechos"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    found = _languages(spark, d).filter(F.col("lang").isNotNull())
    wrong = F.when(~F.col("nomeia").eqNullSafe(F.col("lang")), F.array(F.struct(F.lit(-1).alias("inicio"), F.col("lang").alias("lang"))))
    several = F.when(F.size("trechos") > 1, F.transform("trechos", lambda t: F.struct(t["inicio"].alias("inicio"), t["lang"].alias("lang"))))
    none = F.array().cast("array<struct<inicio:int,lang:string>>")
    return found.select("doc_id", F.explode(F.concat(F.coalesce(wrong, none), F.coalesce(several, none))).alias("t")).select("doc_id", "t.inicio", "t.lang").distinct()


def _mix(spark: SparkSession, d: str) -> mixing.Plan:
    return mixing.plan(table(spark, d, "documents"), "doc_id", "text", "source", table(spark, d, "mix_alvos"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """The mix itself: which tokens of which document, how often."""
    return mixing.select(_mix(spark, d))


def p8_texts(spark: SparkSession, d: str) -> DataFrame:
    """The mix as text, piece by piece."""
    return mixing.texts(_mix(spark, d), table(spark, d, "documents"), "doc_id", "text")


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual shares."""
    return mixing.shares(_mix(spark, d))


QUERIES = {f.__name__: f for f in (p5_found, p5_locations, p5_units, p7_found, p7_scores, p8_mix, p8_texts, p8_shares, p9_found, p9_segments, p9_documents)}
ORACLES: dict[str, str] = {}
