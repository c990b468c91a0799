"""The queries p1_, p2_, p3_, p4_ and p6_: the core's operators over their whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.functions.clean import cnpj14, date_br, number_key, price, price_ok, strip
from garimpo.operators import control_chart, once, orphans, rejects, shred
from garimpo.plans.tables import table
from garimpo.workspace import cut, fresh

NFE_KEYS = ["lote_id", "arquivo"]


# --- 1: nested records -------------------------------------------------------------------------------------------------


def _shredded(spark: SparkSession, d: str, payload: bool) -> DataFrame:
    return shred.shred(table(spark, d, "nfe_xml"), NFE_KEYS, "conteudo", payload=payload)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return shred.bridge(_shredded(spark, d, False)).filter(F.col("grupo") != shred.NFE.root).select(*NFE_KEYS, "grupo", "ordem1", "ordem2", "ordem3")


def _stored(spark: SparkSession, d: str) -> DataFrame:
    return shred.store(table(spark, d, "nfe_xml"), NFE_KEYS, "conteudo")


def p1_store(spark: SparkSession, d: str) -> DataFrame:
    """Each distinct object of all invoices, once and whole."""
    return shred.objects(_stored(spark, d))


def p1_links(spark: SparkSession, d: str) -> DataFrame:
    """Every occurrence of every object with its parent's."""
    return shred.links(_stored(spark, d))


def p1_objects(spark: SparkSession, d: str) -> DataFrame:
    """How often the stored objects of each name occur, and the characters they are stored in."""
    each = _stored(spark, d).filter(F.col("erro").isNull()).groupBy("nome", "objeto").agg(F.count(F.lit(1)).alias("usos"), F.max(F.length("canonico")).alias("tamanho"))
    return each.groupBy("nome").agg(F.count(F.lit(1)).alias("objetos"), F.sum("usos").alias("usos"), F.max("usos").alias("mais_usos"), F.sum("tamanho").alias("caracteres"))


def p1_reuse(spark: SparkSession, d: str) -> DataFrame:
    """Distinct objects and occurrences of the nine groups."""
    rows = shred.bridge(_shredded(spark, d, False)).filter(F.col("grupo") != shred.NFE.root)
    each = rows.groupBy("grupo", "objeto").agg(F.count(F.lit(1)).alias("usos"))
    return each.groupBy("grupo").agg(F.count(F.lit(1)).alias("objetos"), F.sum("usos").alias("usos"), F.max("usos").alias("mais_usos"))


#: group -> (column -> field); every table has all fields of the object in ``campos`` as well
GROUP_FIELDS = {
    "det": {"n_item": "@nItem", "c_prod": "prod.cProd", "x_prod": "prod.xProd", "cfop": "prod.CFOP", "ncm": "prod.NCM"},
    "rastro": {"n_lote": "nLote", "q_lote": "qLote"},
    "di": {"n_di": "nDI", "d_di": "dDI"},
    "adi": {"n_adicao": "nAdicao", "c_fabricante": "cFabricante"},
    "nfref": {"ref_nfe": "refNFe"},
    "dup": {"n_dup": "nDup", "d_venc": "dVenc", "v_dup": "vDup"},
    "detpag": {"t_pag": "tPag", "v_pag": "vPag"},
    "vol": {"q_vol": "qVol"},
    "lacres": {"n_lacre": "nLacre"},
}


def _flat(group: str):
    def plan(spark: SparkSession, d: str) -> DataFrame:
        found = shred.shred(table(spark, d, "nfe_xml"), NFE_KEYS, "conteudo", groups=[group])
        return shred.flat_table(found, NFE_KEYS, group, GROUP_FIELDS[group])

    plan.__name__ = "p1_items" if group == "det" else f"p1_{group}"
    return plan


def p1_fields(spark: SparkSession, d: str) -> DataFrame:
    """The named fields of all nine flat tables as (keys, grupo, ordinals, campo, valor), from one parse."""
    found = shred.shred(table(spark, d, "nfe_xml"), NFE_KEYS, "conteudo", groups=list(GROUP_FIELDS)).filter("erro is null")
    named = F.map_from_entries(F.array(*(F.struct(F.lit(g).alias("g"), F.array(*(F.struct(F.lit(c).alias("campo"), F.lit(path).alias("em")) for c, path in fields.items())).alias("l")) for g, fields in GROUP_FIELDS.items())))
    rows = found.select(*NFE_KEYS, "grupo", "ordem1", "ordem2", "ordem3", "campos", F.inline(named[F.col("grupo")]))
    return rows.select(*NFE_KEYS, "grupo", "ordem1", "ordem2", "ordem3", "campo", F.col("campos")[F.col("em")].alias("valor")).filter("valor is not null")


P1_TABLES = [_flat(group) for group in GROUP_FIELDS]


def p1_rejects(spark: SparkSession, d: str) -> DataFrame:
    return shred.rejects(_shredded(spark, d, False), NFE_KEYS).select(*NFE_KEYS)


# --- 2: orphans --------------------------------------------------------------------------------------------------------

#: child table -> (field -> parent domain)
REFERENCES = {
    "rfb_empresas": {"natureza_juridica": "naturezas", "qualificacao_responsavel": "qualificacoes"},
    "rfb_estabelecimentos": {"cnpj_basico": "empresas", "municipio": "municipios", "cnae_fiscal_principal": "cnaes"},
    "rfb_socios": {"cnpj_basico": "empresas", "qualificacao_socio": "qualificacoes"},
}


def empresas_ok():
    """The contract of rfb_empresas as one predicate inside codegen (rejects.EMPRESAS_FIELDS is the same for the reader)."""
    rules = None
    for c, (_, pattern, empty) in rejects.EMPRESAS_FIELDS.rules.items():
        s = strip(F.col(c))
        ok = F.coalesce(s.rlike(f"^(?:{pattern})$"), F.lit(False))
        ok = (F.col(c).isNull() | (s == "") | ok) if empty else ok
        rules = ok if rules is None else rules & ok
    return rules


def _month(name: str = "_inserted_at"):
    return F.date_format(name, "yyyyMM").cast("int")


def _parents(spark: SparkSession, d: str) -> DataFrame:
    companies = table(spark, d, "rfb_empresas").filter(empresas_ok()).select(F.lit("empresas").alias("dominio"), F.col("referencia_mes").alias("periodo"), number_key(F.col("cnpj_basico")).alias("chave"), _month().alias("carga"))
    codes = table(spark, d, "rfb_dominios").select("dominio", F.col("referencia_mes").alias("periodo"), number_key(F.col("codigo")).alias("chave"), _month().alias("carga"))
    return companies.unionByName(codes)


def _references(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for name, fields in REFERENCES.items():
        rows = table(spark, d, name)
        if name == "rfb_empresas":
            rows = rows.filter(empresas_ok())
        each = F.array(*(F.struct(F.lit(c).alias("campo"), F.lit(parent).alias("dominio"), number_key(F.col(c)).alias("chave")) for c, parent in fields.items()))
        part = rows.select("linha_id", F.col("referencia_mes").alias("periodo"), _month().alias("carga"), F.inline(each)).withColumn("tabela", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.select(*orphans.REFERENCE, "carga")


def _by_load(df: DataFrame, name: str) -> DataFrame:
    """Written in partitions by load, so that a load's batch reads its own rows only."""
    path = fresh(df.sparkSession, name)
    df.write.partitionBy("carga").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def orphan_state(spark: SparkSession, d: str, snapshots: bool = False) -> orphans.OrphanState:
    """All loads, replayed in the order of their months (a list as long as the history has months)."""
    state = orphans.OrphanState(spark)
    parents, references = _by_load(_parents(spark, d), "parents"), _by_load(_references(spark, d), "references")
    months = sorted({r[0] for t in (parents, references) for r in t.select("carga").distinct().collect()}, key=lambda m: (m is not None, m or 0))
    for month in months:
        same = F.col("carga").eqNullSafe(F.lit(month))
        state.apply(parents.filter(same).drop("carga"), references.filter(same).drop("carga"), load=str(month) if snapshots else None)
    return state


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return orphan_state(spark, d).pending().select("tabela", "campo", F.col("periodo").alias("referencia_mes"), "linha_id")


def p2_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return orphan_state(spark, d).snapshot().withColumnRenamed("periodo", "referencia_mes")


def p2_history(spark: SparkSession, d: str) -> DataFrame:
    """The same counts after each load."""
    return orphan_state(spark, d, snapshots=True).snapshots().withColumnRenamed("periodo", "referencia_mes").withColumn("carga", F.col("carga").cast("int"))


# --- 3: messages delivered more than once ------------------------------------------------------------------------------


def message_key():
    """The 44 digits of infNFe's Id, else those of the key column, else null. A comment before infNFe is cut out first."""
    content = F.col("conteudo")
    clean = F.when(F.expr("instr(conteudo, '<!--') between 1 and instr(conteudo, 'infNFe')"), F.regexp_replace(content, r"(?s)<!--.*?-->", "")).otherwise(content)
    found = F.regexp_extract(clean, r"""<(?:[\w.-]+:)?infNFe\s[^>]*?\bId\s*=\s*["']\s*NFe([0-9]{44})\s*["']""", 1)
    column = F.regexp_replace(F.col("chave_acesso"), r"[^0-9]", "")
    return F.coalesce(F.nullif(found, F.lit("")), F.when(F.length(column) == 44, column))


def _deduplicated(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, d, "nfe_xml").select(message_key().alias("chave"), "carregado_em", "lote_id", "arquivo")
    return once.deduplicate(rows, "chave", ["carregado_em", "lote_id", "arquivo"], batch=_month("carregado_em"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _deduplicated(spark, d)[1].select("lote_id", "arquivo")


def p3_kept(spark: SparkSession, d: str) -> DataFrame:
    return _deduplicated(spark, d)[0].select("chave", "lote_id", "arquivo")


# --- 4: implausible readings -------------------------------------------------------------------------------------------


def anp_ok():
    """The contract of anp_landing_semanal as one predicate inside codegen."""
    return price_ok(F.col("valor_de_venda")) & date_br(F.col("data_da_coleta")).isNotNull()


def readings(spark: SparkSession, d: str) -> DataFrame:
    """The typed readings, written out: a price or date that is no case of p6 parses, so the nulls are what must not be judged.

    The texts are parsed once, in one projection; both passes of the charts then read narrow typed columns."""
    rows = table(spark, d, "anp_landing_semanal")
    typed = rows.select("linha_id", cnpj14(F.col("cnpj_da_revenda")).alias("cnpj"), F.upper(strip(F.col("produto"))).alias("produto"), date_br(F.col("data_da_coleta")).alias("dia"), price(F.col("valor_de_venda")).alias("valor"))
    return cut(typed, "readings").filter(F.col("valor").isNotNull() & F.col("dia").isNotNull())


def p4_flags(spark: SparkSession, d: str) -> DataFrame:
    return control_chart.flag(readings(spark, d), ["cnpj", "produto"], "dia", "valor").select("linha_id", "motivo", F.round("usual", 4).alias("usual"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return control_chart.flag(readings(spark, d), ["cnpj", "produto"], "dia", "valor").select("linha_id")


# --- 6: rows that fail to parse ----------------------------------------------------------------------------------------


def p6_reasons(spark: SparkSession, d: str) -> DataFrame:
    """tabela, linha_id, motivo"""
    landing = rejects.reject_fields(table(spark, d, "anp_landing_semanal"), ["linha_id"], rejects.ANP_FIELDS)
    companies = rejects.reject_fields(table(spark, d, "rfb_empresas"), ["linha_id"], rejects.EMPRESAS_FIELDS)
    lines = rejects.read_lines(table(spark, d, "anp_csv_bruto"), ["linha_id"], "linha").filter(F.col("motivo").isNotNull()).select("linha_id", "motivo")
    out = None
    for name, part in (("anp_landing_semanal", landing), ("anp_csv_bruto", lines), ("rfb_empresas", companies)):
        part = part.select(F.lit(name).alias("tabela"), "linha_id", "motivo")
        out = part if out is None else out.unionByName(part)
    return out


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_reasons(spark, d).select("tabela", "linha_id")


def p6_displaced(spark: SparkSession, d: str) -> DataFrame:
    """The load's flag of displaced rows against the reader's verdict, by month: what it caught, missed and accused wrongly."""
    rows = table(spark, d, "rfb_empresas").select("linha_id", "referencia_mes", F.coalesce("_suspeita_deslocamento", F.lit(False)).alias("s"))
    refused = rejects.reject_fields(table(spark, d, "rfb_empresas"), ["linha_id"], rejects.EMPRESAS_FIELDS).select("linha_id", F.lit(True).alias("r"))
    both = rows.join(refused, "linha_id", "left").withColumn("r", F.coalesce("r", F.lit(False)))
    return both.groupBy("referencia_mes").agg(F.count_if(F.col("s") & F.col("r")).alias("apanhadas"), F.count_if(~F.col("s") & F.col("r")).alias("perdidas"), F.count_if(F.col("s") & ~F.col("r")).alias("acusadas"), F.count(F.lit(1)).alias("linhas"))


def p6_loaded(spark: SparkSession, d: str) -> DataFrame:
    """The lines that load, typed."""
    ok = rejects.read_lines(table(spark, d, "anp_csv_bruto"), ["linha_id"], "linha").filter(F.col("motivo").isNull())
    return ok.select("linha_id", cnpj14(F.col("cnpj_da_revenda")).alias("cnpj"), strip(F.col("produto")).alias("produto"), date_br(F.col("data_da_coleta")).alias("dia"), price(F.col("valor_de_venda")).alias("valor"))


QUERIES = {f.__name__: f for f in (p1_found, p1_objects, p1_store, p1_links, p1_reuse, p1_fields, *P1_TABLES, p1_rejects, p2_found, p2_snapshot, p2_history, p3_found, p3_kept, p4_found, p4_flags, p6_found, p6_reasons, p6_displaced, p6_loaded)}
