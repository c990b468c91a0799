"""Data tests, reconciliations, anomaly and health checks as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from garimpo.functions import keys
from garimpo.operators import quality as q
from garimpo.operators import shred
from garimpo.plans.catalog import query
from garimpo.plans.scalars import MOD11_SQL
from garimpo.plans.warehouse import CLEAN_SQL, CURRENT_XML, ITEMS_SQL, headers, items, price_fact, shredded, silver, stations, tag


@query("d01_not_null", "select linha_id from rfb_dominios where descricao is null")
def not_null(t):
    return q.not_null(t.rfb_dominios, "descricao").select("linha_id")


@query("d01_unique", "select dominio, codigo, referencia_mes, count(*) as n from rfb_dominios group by 1, 2, 3 having count(*) > 1")
def unique(t):
    return q.unique(t.rfb_dominios, ["dominio", "codigo", "referencia_mes"])


@query("d02_accepted_values", "select linha_id, unidade_de_medida from anp_landing_semanal where unidade_de_medida not in ('R$ / litro', 'R$ / 13 kg', 'R$ / m³')")
def accepted(t):
    return q.accepted_values(t.anp_landing_semanal, "unidade_de_medida", ["R$ / litro", "R$ / 13 kg", "R$ / m³"]).select("linha_id", "unidade_de_medida")


@query("d03_relationships", "select distinct cnpj_basico from rfb_socios where cnpj_basico is not null and cnpj_basico not in (select cnpj_basico from rfb_empresas where cnpj_basico is not null)")
def relations(t):
    return q.relationships(t.rfb_socios, "cnpj_basico", t.rfb_empresas, "cnpj_basico").select("cnpj_basico").distinct()


@query("d04_expression", "select lote_id from nfe_lote where not (qtd_carregados + qtd_rejeitados <= qtd_arquivos)")
def expression(t):
    return q.expression_is_true(t.nfe_lote, F.col("qtd_carregados") + F.col("qtd_rejeitados") <= F.col("qtd_arquivos")).select("lote_id")


@query("d04_accepted_range", "select c_custkey from customer where c_acctbal <= 0 or c_acctbal >= 9000")
def ranges(t):
    return q.accepted_range(t.customer, "c_acctbal", 0, 9000, inclusive=False).select("c_custkey")


@query("d05_unique_combination", "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def combination(t):
    return q.unique(t.lineitem, ["l_orderkey", "l_linenumber"])


KEY_SQL = "(select lote_id, arquivo, regexp_replace(coalesce(chave_acesso, ''), '[^0-9]', '', 'g') as c from nfe_xml)"


@query(
    "d06_access_key",
    f"select lote_id, arquivo from (select *, {MOD11_SQL.format(e='left(c, 43)')} as s from {KEY_SQL}) where not (length(c) = 44 and cast(right(c, 1) as varchar) = cast(case when s % 11 < 2 then 0 else 11 - s % 11 end as varchar))",
)
def access_key(t):
    key = F.regexp_replace(F.coalesce("chave_acesso", F.lit("")), "[^0-9]", "")
    return t.nfe_xml.select("lote_id", "arquivo", key.alias("c")).filter(~keys.access_key_ok(F.col("c"))).select("lote_id", "arquivo")


def _dv(e: str) -> str:
    return f"(case when {MOD11_SQL.format(e=e)} % 11 < 2 then 0 else 11 - {MOD11_SQL.format(e=e)} % 11 end)"


@query(
    "d07_cnpj",
    f"select linha_id from (select linha_id, coalesce(cnpj_completo, '') as c from rfb_estabelecimentos) where not case when regexp_full_match(c, '[0-9A-Z]{{12}}[0-9]{{2}}') then {_dv('left(c, 12)')} = cast(substr(c, 13, 1) as int) and {_dv('left(c, 13)')} = cast(substr(c, 14, 1) as int) else false end",
)
def cnpj(t):
    return t.rfb_estabelecimentos.filter(~keys.cnpj_ok(F.coalesce("cnpj_completo", F.lit("")))).select("linha_id")


@query(
    "d08_class_prefix",
    f"select chave, n from (select chave, cast(regexp_extract(x, 'nItem=\"([0-9]+)\"', 1) as int) as n, {tag('CST', 'i')} as cst, {tag('cClassTrib', 'i')} as c from (select chave, x, regexp_extract(x, '(?s)<(?:n:)?IBSCBS>.*</(?:n:)?IBSCBS>') as i from (select chave, unnest(regexp_extract_all(conteudo, '(?s)<(?:n:)?det .*?</(?:n:)?det>')) as x from {CURRENT_XML}))) where left(c, 3) <> cst",
)
def class_prefix(t):
    rows = shred.flat_table(shredded(t), ["chave"], "det", {"n": "@nItem", "cst": "imposto.IBSCBS.CST", "c": "imposto.IBSCBS.cClassTrib"})
    return rows.filter(F.left("c", F.lit(3)) != F.col("cst")).select("chave", F.col("n").cast("int").alias("n"))


@query("d09_reconcile_totals", f"with {CLEAN_SQL} select count(*) as fato, (select count(*) from silver) as silver from fato")
def totals(t):
    s = silver(t)
    return price_fact(s).agg(F.count(F.lit(1)).alias("fato")).crossJoin(s.agg(F.count(F.lit(1)).alias("silver")))


@query(
    "d10_covers_fact",
    f"with {CLEAN_SQL} select id_posto_sk from (select id_posto_sk, count(*) as n from fato where id_posto_sk is not null group by 1) a full join (select id_posto_sk, 1 as m from postos) b using (id_posto_sk) where n is null or m is null",
)
def covers(t):
    s = silver(t)
    a = price_fact(s).filter("id_posto_sk is not null").groupBy("id_posto_sk").agg(F.count(F.lit(1)).alias("n"))
    return a.join(stations(s).select("id_posto_sk", F.lit(1).alias("m")), "id_posto_sk", "full").filter("n is null or m is null").select("id_posto_sk")


@query(
    "d11_header_equals_items",
    f"select chave, v as esquerda, s as direita from (select chave, sum(vprod) as s from {ITEMS_SQL} group by 1) join (select chave, cast({tag('vNF')} as decimal(15, 2)) as v from {CURRENT_XML}) using (chave) where v <> s",
)
def header_items(t):
    found = shredded(t)
    h = headers(t, found).select("chave", F.col("v_nf").cast("decimal(15,2)").alias("valor"))
    s = items(t, found).groupBy("chave").agg(F.sum("vprod").cast("decimal(18,2)").alias("valor"))
    return q.reconcile(h, s, ["chave"]).filter("esquerda is not null and direita is not null")


@query(
    "d12_base_rule",
    f"select chave, n_item from {ITEMS_SQL} where vbc is not null and vbc <> vprod",
)
def base_rule(t):
    return q.expression_is_true(items(t), F.col("vbc") == F.col("vprod")).select("chave", "n_item")


@query("d13_scoped_warning", "select lote_id from nfe_lote where status = 'CARREGADO' and processado_em is not null")
def scoped(t):
    return q.expression_is_true(t.nfe_lote.filter("status = 'CARREGADO'"), F.col("processado_em").isNull()).select("lote_id")


DAYS = "select cast(ts as date) as dia, count(*) as n, avg(value) as m, max(ts) as ultimo from events group by 1"


@query(
    "d14_volume_anomaly",
    f"select dia, n from (select *, avg(n) over w as a, stddev_samp(n) over w as s from ({DAYS}) window w as (order by dia rows between 60 preceding and 1 preceding)) where abs((n - a) / nullif(s, 0)) > 2",
)
def volume(t):
    daily = t.events.groupBy(F.to_date("ts").alias("dia")).agg(F.count(F.lit(1)).alias("n"))
    return q.zscore(daily, [], "dia", "n", limit=2.0).select("dia", "n")


@query(
    "d15_freshness_anomaly",
    "with g as (select user_id, ts, epoch(ts - lag(ts) over (partition by user_id order by ts, event_id)) as gap from events), z as (select *, avg(gap) over w as a, stddev_samp(gap) over w as s from g where gap is not null window w as (partition by user_id order by ts rows between 60 preceding and 1 preceding)) select user_id, ts from z where abs((gap - a) / nullif(s, 0)) > 3",
)
def gaps(t):
    before = F.lag("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    gap = t.events.select("user_id", "ts", before.alias("b")).filter("b is not null").withColumn("gap", F.expr("timestampdiff(MICROSECOND, b, ts)") / 1e6)
    return q.zscore(gap, ["user_id"], "ts", "gap").select("user_id", "ts")


@query(
    "d16_column_anomaly",
    f"select dia from (select *, avg(m) over w as a, stddev_samp(m) over w as s from ({DAYS}) window w as (order by dia rows between 60 preceding and 1 preceding)) where abs((m - a) / nullif(s, 0)) > 2",
)
def columns(t):
    daily = t.events.groupBy(F.to_date("ts").alias("dia")).agg(F.avg("value").alias("m"))
    return q.zscore(daily, [], "dia", "m", limit=2.0).select("dia")


@query("d17_freshness", "select case when max(carregado_em) is null or epoch(timestamp '2026-05-05' - max(carregado_em)) / 3600 > 240 then 'fail' when epoch(timestamp '2026-05-05' - max(carregado_em)) / 3600 > 24 then 'warn' else 'pass' end as situacao from nfe_lote")
def fresh(t):
    hours = F.expr("timestampdiff(SECOND, max(carregado_em), timestamp_ntz'2026-05-05 00:00:00') / 3600")
    return t.nfe_lote.agg(F.when(hours.isNull() | (hours > 240), "fail").when(hours > 24, "warn").otherwise("pass").alias("situacao"))


@query("d18_threshold", "select case when count(*) filter (where valor_de_venda = '') * 100.0 / count(*) > 5 then 'fail' else 'pass' end as situacao from anp_landing_semanal")
def thresholds(t):
    return t.anp_landing_semanal.agg(F.when(F.count_if(F.col("valor_de_venda") == "") * 100.0 / F.count(F.lit(1)) > 5, "fail").otherwise("pass").alias("situacao"))


@query("d19_reconciliation", "select case when abs(a - b) / greatest(abs(a), 1) * 100 <= 2 then 'pass' else 'fail' end as situacao from (select count(*) as a, count(distinct lote_id || arquivo) as b from nfe_xml)")
def reconciled(t):
    rows = t.nfe_xml.groupBy("lote_id", "arquivo").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("a"), F.count(F.lit(1)).alias("b"))
    return rows.select(F.when(F.abs(F.col("a") - F.col("b")) / F.greatest(F.abs("a"), F.lit(1)) * 100 <= 2, "pass").otherwise("fail").alias("situacao"))


@query(
    "d21_contiguous_sequence",
    "select l_orderkey, l_linenumber from (select *, lag(l_linenumber) over (partition by l_orderkey order by l_linenumber, l_partkey) as p from lineitem) where l_linenumber <> coalesce(p, 0) + 1",
)
def contiguous(t):
    before = F.lag("l_linenumber").over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey"))
    return t.lineitem.select("l_orderkey", "l_linenumber", before.alias("p")).filter(F.col("l_linenumber") != F.coalesce("p", F.lit(0)) + 1).select("l_orderkey", "l_linenumber")


@query(
    "d22_golden_labels_exist",
    "select item_id, dominio from (select item_id, unnest(['naturezas', 'leis']) as dominio from eval_itens) where dominio not in (select distinct dominio from rfb_dominios)",
)
def golden(t):
    wanted = t.eval_itens.select("item_id", F.explode(F.array(F.lit("naturezas"), F.lit("leis"))).alias("dominio"))
    return wanted.join(t.rfb_dominios, "dominio", "left_anti")


@query("d23_regression_gate", "select metrica from (select 'fechados' as metrica, avg((o_orderstatus = 'F')::int) as v, 0.9 as base from orders union all select 'abertos', avg((o_orderstatus = 'O')::int), 0.1 from orders) where v < base - 1.0 / (select count(*) from orders)")
def gated(t):
    row = t.orders.agg(F.avg((F.col("o_orderstatus") == "F").cast("int")).alias("fechados"), F.avg((F.col("o_orderstatus") == "O").cast("int")).alias("abertos"), F.count(F.lit(1)).alias("n")).first()
    failed = q.gate({"fechados": row["fechados"], "abertos": row["abertos"]}, {"fechados": 0.9, "abertos": 0.1}, row["n"])
    return t.spark.createDataFrame([(m,) for m in failed], "metrica string")
