"""The health checks of all sources as data: each is a scalar of SQL that both engines read, a rule and its limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from garimpo.operators import quality as q
from garimpo.plans.catalog import query

#: the moment the checks are asked at
NOW = "2026-06-01 00:00:00"


def _share(table: str, bad: str) -> str:
    return f"select sum(case when {bad} then 1.0 else 0.0 end) / count(*) from {table}"


def _count(table: str, where: str = "1 = 1") -> str:
    return f"select cast(count(*) as double) from {table} where {where}"


#: name, kind, measure(s), limits, severity. freshness: hours of (warning, error) on (table, column); threshold: (least, most); reconciliation: percent
CHECKS = (
    ("anp recente", "freshness", ("anp_landing_semanal", "ingestion_timestamp"), (24 * 21, 24 * 60), "error"),
    ("notas recentes", "freshness", ("nfe_xml", "carregado_em"), (24 * 7, 24 * 30), "error"),
    ("lotes recentes", "freshness", ("nfe_lote", "recebido_em"), (24 * 7, 24 * 90), "error"),
    ("empresas recentes", "freshness", ("rfb_empresas", "_inserted_at"), (24 * 35, 24 * 400), "error"),
    ("socios recentes", "freshness", ("rfb_socios", "_inserted_at"), (24 * 10, 24 * 35), "warn"),
    ("textos recentes", "freshness", ("documents", "coletado_em"), (24 * 1, 24 * 2), "warn"),
    ("anp volume", "threshold", _count("anp_landing_semanal"), (1000, None), "error"),
    ("anp sem preco", "threshold", _share("anp_landing_semanal", "valor_de_venda is null or trim(valor_de_venda) = ''"), (None, 0.2), "warn"),
    ("anp sem cnpj", "threshold", _share("anp_landing_semanal", "cnpj_da_revenda is null or trim(cnpj_da_revenda) = ''"), (None, 0.01), "error"),
    ("anp sem cep", "threshold", _share("anp_landing_semanal", "cep is null or trim(cep) = ''"), (None, 0.01), "warn"),
    ("anp estados", "threshold", "select cast(count(distinct estado_sigla) as double) from anp_landing_semanal", (5, 27), "error"),
    ("anp produtos", "threshold", "select cast(count(distinct produto) as double) from anp_landing_semanal", (5, None), "error"),
    ("linhas cruas", "threshold", _count("anp_csv_bruto"), (1, None), "error"),
    ("linhas em branco", "threshold", _share("anp_csv_bruto", "linha is null or trim(linha) = ''"), (None, 0.05), "warn"),
    ("notas sem chave", "threshold", _share("nfe_xml", "chave_acesso is null"), (None, 0.0), "warn"),
    ("notas sem conteudo", "threshold", _count("nfe_xml", "conteudo is null or trim(conteudo) = ''"), (None, 0), "error"),
    ("lotes processados", "threshold", _share("nfe_lote", "processado_em is null"), (None, 0.5), "error"),
    ("lotes sem contagem", "threshold", _count("nfe_lote", "qtd_arquivos is null"), (None, 0), "warn"),
    ("empresas deslocadas", "threshold", _share("rfb_empresas", "_suspeita_deslocamento"), (None, 0.05), "error"),
    ("meses de empresas", "threshold", "select cast(count(distinct referencia_mes) as double) from rfb_empresas", (3, None), "error"),
    ("dominios", "threshold", "select cast(count(distinct dominio) as double) from rfb_dominios", (6, 6), "error"),
    ("textos sem idioma", "threshold", _share("documents", "lang is null or trim(lang) = ''"), (None, 0.05), "warn"),
    ("pedidos e linhas", "reconciliation", ("select cast(count(distinct l_orderkey) as double) from lineitem", _count("orders")), 5.0, "error"),
    ("notas por lote", "reconciliation", ("select cast(sum(qtd_arquivos) as double) from nfe_lote", _count("nfe_xml", "lote_id in (select lote_id from nfe_lote where qtd_arquivos is not null)")), 1.0, "error"),
    ("lotes com notas", "reconciliation", ("select cast(count(distinct lote_id) as double) from nfe_xml", _count("nfe_lote")), 0.0, "error"),
    ("meses de socios", "reconciliation", ("select cast(count(distinct referencia_mes) as double) from rfb_socios", "select cast(count(distinct referencia_mes) as double) from rfb_estabelecimentos"), 0.0, "error"),
)


def _sql(name: str, kind: str, measure, limits, severity: str) -> str:
    bad = "warn" if severity == "warn" else "fail"
    if kind == "freshness":
        table, column = measure
        value = f"select (epoch(timestamp '{NOW}') - epoch(max({column}))) / 3600 as v from {table}"
        status = f"case when v is null then '{bad}' when v > {limits[1]} then '{bad}' when v > {limits[0]} then 'warn' else 'pass' end"
    elif kind == "threshold":
        value = f"select ({measure}) as v"
        broken = " or ".join(["v is null", *(f"v {sign} {x}" for sign, x in (("<", limits[0]), (">", limits[1])) if x is not None)])
        status = f"case when {broken} then '{bad}' else 'pass' end"
    else:
        value = f"select ({measure[0]}) as v, ({measure[1]}) as w"
        status = f"case when v is null or w is null or abs(v - w) / greatest(abs(v), 1) * 100 > {limits} then '{bad}' else 'pass' end"
    return f"select '{name}' as checagem, {status} as status, round(v, 6) as valor from ({value})"


def _measured(t, kind: str, measure):
    """What is measured, read when the check runs."""
    def run(spark):
        if kind == "freshness":
            table, column = measure
            newest = getattr(t, table).agg(((F.unix_micros(F.lit(NOW).cast("timestamp")) - F.unix_micros(F.max(column).cast("timestamp"))) / 3.6e9).alias("v"))
            return (newest.first()[0],)
        return tuple(spark.sql(f"select ({m})").first()[0] for m in ([measure] if kind == "threshold" else measure))

    return run


def _rule(kind: str, limits):
    if kind == "freshness":
        return lambda v: q.freshness(v, *limits)
    return (lambda v: q.threshold(v, *limits)) if kind == "threshold" else (lambda v, w: q.reconciliation(v, w, limits))


@query("d20_check_runner", " union all ".join(_sql(*c) for c in CHECKS))
def runner(t):
    """All checks; a few scalars come back, each from its own aggregate."""
    for table in ("anp_landing_semanal", "anp_csv_bruto", "nfe_xml", "nfe_lote", "rfb_empresas", "rfb_socios", "rfb_estabelecimentos", "rfb_dominios", "documents", "orders", "lineitem"):
        getattr(t, table).createOrReplaceTempView(table)
    done = q.run_checks(t.spark, [q.Check(name, _measured(t, kind, measure), _rule(kind, limits), severity=severity) for name, kind, measure, limits, severity in CHECKS])
    return t.spark.createDataFrame([(r["check"], r["status"], None if r["value"] is None else round(r["value"], 6)) for r in done], "checagem string, status string, valor double")
