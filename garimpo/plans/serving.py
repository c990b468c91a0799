"""Serving and dashboard queries: price board, run health, checks, invoices, usage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from garimpo.functions import text
from garimpo.operators.latest import latest_per_key, newest
from garimpo.plans.catalog import query
from garimpo.plans.warehouse import CLEAN_SQL, CURRENT_SQL, CURRENT_XML, current, current_of, daily, headers, silver, tag
from garimpo.workspace import cut

# fixed values: order in which products are shown
PRODUCT_ORDER = ["GASOLINA", "GASOLINA ADITIVADA", "ETANOL", "DIESEL S10", "DIESEL", "GNV", "GLP", "DIESEL S50"]
# fixed values: products with a column of their own in the matrix; all further ones share a list
MATRIX_PRODUCTS = [*PRODUCT_ORDER, "GASOLINA C ESPECIAL"]
# fixed values: rows of the matrix at each level
LEVELS = {
    "estado": ["uf"],
    "cidade": ["uf", "municipio"],
    "bairro": ["uf", "municipio", "bairro"],
    "posto": ["uf", "municipio", "bairro", "revenda", "bandeira", "cnpj", "endereco"],
}
DAILY_SQL = f"{CLEAN_SQL}, diario as (select data_coleta, estado_sigla as uf, upper(trim(municipio)) as municipio, produto, count(*) as qtd_postos, sum(valor_venda) as soma, min(valor_venda) as preco_min, max(valor_venda) as preco_max from fato join postos using (id_posto_sk) join produtos using (id_produto_sk) group by 1, 2, 3, 4)"


def product_rank(c):
    return F.coalesce(F.create_map(*(F.lit(x) for k, p in enumerate(PRODUCT_ORDER) for x in (p, k)))[c], F.lit(1_000_000))


@query("b01_current", f"with {CURRENT_SQL} select cnpj, produto, valor_venda, data_coleta from atual where uf = 'SP'")
def current_scope(t):
    return current(t).filter("uf = 'SP'").select("cnpj", "produto", "valor_venda", "data_coleta")


@query("b01_history", f"with {DAILY_SQL} select data_coleta, produto, sum(qtd_postos) as qtd_postos, round(sum(soma), 4) as soma, min(preco_min) as preco_min, max(preco_max) as preco_max from diario where uf = 'SP' group by 1, 2")
def history_scope(t):
    return daily(t).filter("uf = 'SP'").groupBy("data_coleta", "produto").agg(F.sum("qtd_postos").alias("qtd_postos"), F.round(F.sum("soma_valor_venda"), 4).alias("soma"), F.min("preco_min").alias("preco_min"), F.max("preco_max").alias("preco_max"))


def recent(rows: DataFrame, days: int) -> DataFrame:
    """Rows at most ``days`` older than the newest one of the data."""
    top = rows.agg(F.max("data_coleta").alias("m"))
    return rows.join(F.broadcast(top), F.col("data_coleta") >= F.date_sub(F.col("m"), days)).drop("m")


RECENT = "(select * from atual where data_coleta >= (select max(data_coleta) from atual) - 30)"


@query("b02_kpis", f"with {CURRENT_SQL} select produto, round(avg(valor_venda), 10) as media, min(valor_venda) as minimo, max(valor_venda) as maximo, count(distinct cnpj) as postos, round(avg(variacao), 10) as variacao, max(data_coleta) as ultima from {RECENT} group by 1")
def kpis(t):
    v = F.col("valor_venda")
    rows = recent(current(t), 30).groupBy("produto").agg(F.round(F.avg(v), 10).alias("media"), F.min(v).alias("minimo"), F.max(v).alias("maximo"), F.countDistinct("cnpj").alias("postos"), F.round(F.avg("variacao"), 10).alias("variacao"), F.max("data_coleta").alias("ultima"))
    return rows.orderBy(product_rank(F.col("produto")), "produto")


@query(
    "b02_matrix",
    f"with {CURRENT_SQL} select uf, municipio, " + ", ".join(f"round(avg(valor_venda) filter (where produto = '{p}'), 10) as \"{p}\"" for p in PRODUCT_ORDER[:3]) + f", count(distinct cnpj) as postos from {RECENT} group by 1, 2",
)
def matrix(t):
    rows = recent(current(t), 30)
    cells = [F.round(F.avg(F.when(F.col("produto") == p, F.col("valor_venda"))), 10).alias(p) for p in PRODUCT_ORDER[:3]]
    return rows.groupBy("uf", "municipio").agg(*cells, F.countDistinct("cnpj").alias("postos")).orderBy(F.asc_nulls_last(PRODUCT_ORDER[0]), "municipio")


def level_sql(level: str) -> str:
    """The matrix at one level; its main product is the first one present, known products before further ones."""
    keys = ", ".join(LEVELS[level])
    on = " and ".join(f"r.{k} is not distinct from {{0}}.{k}" for k in LEVELS[level])
    rank = "case produto " + " ".join(f"when '{p}' then {k}" for k, p in enumerate(PRODUCT_ORDER)) + " else 1000000 end"
    known = ", ".join(f"'{p}'" for p in MATRIX_PRODUCTS)
    cells = ", ".join(f"round(avg(valor_venda) filter (where produto = '{p}'), 10) as \"{p}\"" for p in MATRIX_PRODUCTS)
    names = ", ".join(f'"{p}"' for p in MATRIX_PRODUCTS)
    city = level == "posto"
    return (
        f"with {CURRENT_SQL}, recente as (select * from {RECENT}), principal as (select produto from recente where produto is not null order by {rank}, produto limit 1), "
        f"linhas as (select {keys}, {cells}, count(distinct cnpj) as qtd_postos, max(data_coleta) as ultima_coleta, avg(valor_venda) filter (where produto = (select produto from principal)) as p from recente group by all), "
        f"demais as (select {keys}, produto, round(avg(valor_venda), 10) as preco from recente where produto is null or produto not in ({known}) group by all), "
        f"outros as (select {keys}, list({{'produto': produto, 'preco': preco}} order by produto nulls first) as outros from demais group by all)"
        + (", cidades as (select uf, municipio, avg(valor_venda) as media from recente where produto = (select produto from principal) group by 1, 2)" if city else "")
        + f" select {', '.join(f'r.{k}' for k in LEVELS[level])}, qtd_postos, ultima_coleta, {names}, coalesce(outros, []) as outros"
        + (", round((p / nullif(media, 0) - 1) * 100, 6) as vs_media_cidade" if city else "")
        + f" from linhas r left join outros o on {on.format('o')}"
        + (" left join cidades c on r.uf is not distinct from c.uf and r.municipio is not distinct from c.municipio" if city else "")
    )


def same(left: DataFrame, right: DataFrame, keys: list[str]):
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(right[f"__{k}"])
    return on


def level_matrix(rows: DataFrame, level: str, main: str | None = None) -> DataFrame:
    """One row per place of ``level``, a mean price per known product, further products in ``outros``, cheapest first on the main
    product (``main``, else the first one present); stations are held against the mean of their city."""
    keys, v, city = LEVELS[level], F.col("valor_venda"), level == "posto"
    rows = cut(rows.select(*dict.fromkeys([*keys, "cnpj", "produto", "data_coleta", "valor_venda"])), "matrix")
    first = rows.filter(F.col("produto").isNotNull()).agg(F.max(F.col("produto") == main).alias("asked"), F.min(F.struct(product_rank(F.col("produto")).alias("k"), "produto")).alias("first"))
    first = first.select(F.when(F.col("asked"), F.lit(main)).otherwise(F.col("first.produto")).alias("__main"))
    rows = rows.join(F.broadcast(first))  # one row
    price = F.avg(F.when(F.col("produto") == F.col("__main"), v))
    cells = [F.round(F.avg(F.when(F.col("produto") == p, v)), 10).alias(p) for p in MATRIX_PRODUCTS]
    out = rows.groupBy(*keys).agg(F.countDistinct("cnpj").alias("qtd_postos"), F.max("data_coleta").alias("ultima_coleta"), *cells, price.alias("__price"))
    rest = rows.filter(F.col("produto").isNull() | ~F.col("produto").isin(MATRIX_PRODUCTS)).groupBy(*keys, "produto").agg(F.round(F.avg(v), 10).alias("preco"))
    rest = rest.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.array_sort(F.collect_list(F.struct("produto", "preco"))).alias("outros"))
    out = out.join(rest, same(out, rest, keys), "left").select(*out.columns, F.coalesce("outros", F.array().cast("array<struct<produto:string,preco:double>>")).alias("outros"))
    if city:
        means = rows.groupBy(F.col("uf").alias("__uf"), F.col("municipio").alias("__municipio")).agg(price.alias("__mean"))
        versus = (F.col("__price") / F.nullif(F.col("__mean"), F.lit(0.0)) - 1) * 100
        out = out.join(means, same(out, means, ["uf", "municipio"]), "left").select(*out.columns, F.round(versus, 6).alias("vs_media_cidade"))
    return out.orderBy(F.asc_nulls_last("__price"), *(F.asc_nulls_last(k) for k in keys)).drop("__price")


def current_once(t) -> DataFrame:
    """The current prices as a written table, from a written silver table: the matrix reads both more than once, and each reading
    shuffles all rows again otherwise."""
    s = silver(t).select("chave", "cnpj", "produto", "id_produto", "unidade_de_medida", "data_coleta", "valor_venda", "ingestion_timestamp", "revenda", "bandeira", "estado_sigla", "municipio", "bairro", "cep", "nome_da_rua", "numero_rua", "linha_id")
    return cut(current_of(cut(s, "silver")), "current")


for _level in LEVELS:
    query(f"b02_matrix_{_level}", level_sql(_level))(lambda t, level=_level: level_matrix(recent(current_once(t), 30), level))


@query("b02_history", f"with {DAILY_SQL} select cast(date_trunc('week', data_coleta) as date) as semana, produto, round(sum(soma) / sum(qtd_postos), 10) as media from diario where data_coleta is not null group by 1, 2")
def history(t):
    return daily(t).filter("data_coleta is not null").groupBy(F.date_trunc("week", "data_coleta").cast("date").alias("semana"), "produto").agg(F.round(F.sum("soma_valor_venda") / F.sum("qtd_postos"), 10).alias("media"))


@query("b02_coverage", f"with {CURRENT_SQL} select uf, count(distinct municipio) as municipios, count(distinct cnpj) as postos, sum(qtd_coletas) as coletas from atual group by 1")
def coverage(t):
    return current(t).groupBy("uf").agg(F.countDistinct("municipio").alias("municipios"), F.countDistinct("cnpj").alias("postos"), F.sum("qtd_coletas").alias("coletas"))


@query("b02_price_text", f"with {CURRENT_SQL} select cnpj, produto, 'R$ ' || translate(format('{{:,.2f}}', max(valor_venda)), ',.', '.,') as preco from atual where valor_venda is not null group by 1, 2")
def price_texts(t):
    return current(t).filter("valor_venda is not null").groupBy("cnpj", "produto").agg(F.max("valor_venda").alias("v")).select("cnpj", "produto", text.price_text(F.col("v")).alias("preco"))


# --- runs: events stand for steps (type: pipeline, user: step, value: seconds) --------------------------------------------

RUN = "(select *, case when event_type = 'error' then 'failed' else 'success' end as status from events)"


def run_rows(t) -> DataFrame:
    return t.events.withColumn("status", F.when(F.col("event_type") == "error", "failed").otherwise("success"))


@query("b03_health", f"select cast(ts as date) as dia, round(100.0 * count(*) filter (where status = 'success') / count(*), 4) as pct, count(*) filter (where status = 'failed') as falhas, round(sum(value), 2) as linhas from {RUN} group by 1")
def health(t):
    return run_rows(t).groupBy(F.to_date("ts").alias("dia")).agg(F.round(F.lit(100.0) * F.count_if(F.col("status") == "success") / F.count(F.lit(1)), 4).alias("pct"), F.count_if(F.col("status") == "failed").alias("falhas"), F.round(F.sum("value"), 2).alias("linhas"))


@query("b03_last_run", f"select user_id, event_id, status from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from {RUN}) where rn = 1")
def last_run(t):
    return newest(run_rows(t), ["user_id"], ["ts", "event_id"], ["event_id", "status"])


@query("b03_baseline_change", f"with d as (select event_type, cast(ts as date) as dia, count(*) as n from events group by 1, 2), r as (select *, row_number() over (partition by event_type order by dia desc) as rn from d) select event_type, round(100.0 * (max(n) filter (where rn = 1) - median(n) filter (where rn between 2 and 11)) / nullif(median(n) filter (where rn between 2 and 11), 0), 4) as desvio from r group by 1 order by abs(desvio) desc")
def baseline_change(t):
    d = t.events.groupBy("event_type", F.to_date("ts").alias("dia")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("event_type").orderBy(F.desc("dia"))
    r = d.select("event_type", "n", F.percentile("n", 0.5).over(w.rowsBetween(1, 10)).alias("m"), F.row_number().over(w).alias("rn")).filter("rn = 1")
    return r.select("event_type", F.round(F.lit(100.0) * (F.col("n") - F.col("m")) / F.nullif(F.col("m"), F.lit(0.0)), 4).alias("desvio")).orderBy(F.desc(F.abs("desvio")))


@query("b04_check_status", "select event_type, user_id, max(event_id) as ultimo, case when max(value) > 95 then 0 when max(value) > 80 then 1 else 2 end as gravidade from events group by 1, 2 order by 4, 1, 2")
def check_status(t):
    top = F.max("value")
    return t.events.groupBy("event_type", "user_id").agg(F.max("event_id").alias("ultimo"), F.when(top > 95, 0).when(top > 80, 1).otherwise(2).alias("gravidade")).orderBy("gravidade", "event_type", "user_id")


@query("b04_non_passing_buckets", "select time_bucket(interval '1 day', ts, timestamp '1970-01-01') as inicio, count(*) as n from events where event_type = 'error' group by 1")
def non_passing(t):
    return t.events.filter("event_type = 'error'").groupBy(F.window("ts", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("inicio"), "n")


@query("b05_slowest_models", "select user_id, round(avg(value), 10) as media, max(value) as pior, count(*) as execucoes from events group by 1 order by 2 desc, 1 limit 10")
def slowest(t):
    return t.events.groupBy("user_id").agg(F.round(F.avg("value"), 10).alias("media"), F.max("value").alias("pior"), F.count(F.lit(1)).alias("execucoes")).orderBy(F.desc("media"), "user_id").limit(10)


@query("b05_latest_per_test", "select event_type, user_id, event_id, value from (select *, row_number() over (partition by event_type, user_id order by ts desc, event_id desc) as rn from events) where rn = 1")
def latest_test(t):
    return latest_per_key(t.events, ["event_type", "user_id"], [F.desc("ts"), F.desc("event_id")]).select("event_type", "user_id", "event_id", "value")


@query("b06_durations", "select event_type, cast(date_trunc('hour', ts) as timestamp) as hora, round(avg(value), 10) as media, round(percentile_cont(0.95) within group (order by value), 10) as p95 from events group by 1, 2")
def durations(t):
    return t.events.groupBy("event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hora")).agg(F.round(F.avg("value"), 10).alias("media"), F.round(F.percentile("value", 0.95), 10).alias("p95"))


@query("b07_quality_series", "select cast(ts as date) as dia, 'k' as metrica, round(avg(cast(json_extract_string(props, '$.k') as int)), 10) as valor from events where list_contains(json_keys(props), 'k') group by 1")
def quality_series(t):
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.filter(k.isNotNull()).groupBy(F.to_date("ts").alias("dia")).agg(F.round(F.avg(k), 10).alias("valor")).select("dia", F.lit("k").alias("metrica"), "valor")


@query("b09_invoice_operation", "select status, count(*) as lotes, sum(qtd_arquivos) as arquivos, round(avg(epoch(processado_em - recebido_em)) / 60, 4) as minutos from nfe_lote group by 1")
def invoice_operation(t):
    minutes = F.avg(F.expr("timestampdiff(MICROSECOND, recebido_em, processado_em)") / 1e6) / 60
    return t.nfe_lote.groupBy("status").agg(F.count(F.lit(1)).alias("lotes"), F.sum("qtd_arquivos").alias("arquivos"), F.round(minutes, 4).alias("minutos"))


@query("b09_top_issuers", f"select {tag('CNPJ')} as emit_cnpj, count(*) as notas, cast(sum(cast({tag('vNF')} as decimal(15, 2))) as decimal(18, 2)) as valor from {CURRENT_XML} group by 1 order by 3 desc, 1 limit 10")
def top_issuers(t):
    h = headers(t).groupBy("emit_cnpj").agg(F.count(F.lit(1)).alias("notas"), F.sum(F.col("v_nf").cast("decimal(15,2)")).cast("decimal(18,2)").alias("valor"))
    return h.orderBy(F.desc("valor"), "emit_cnpj").limit(10)


@query(
    "b10_ethanol_ratio",
    f"with {CLEAN_SQL}, s as (select cast(date_trunc('week', data_coleta) as date) as semana, estado_sigla as uf, avg(valor_venda) filter (where produto = 'ETANOL') as e, avg(valor_venda) filter (where produto = 'GASOLINA') as g from fato join postos using (id_posto_sk) join produtos using (id_produto_sk) group by 1, 2) select semana, uf, round(e / nullif(g, 0), 10) as razao from s where e is not null and g is not null",
)
def ratio(t):
    from garimpo.plans.warehouse import star

    mean = lambda p: F.avg(F.when(F.col("produto") == p, F.col("valor_venda")))
    s = star(t).groupBy(F.date_trunc("week", "data_coleta").cast("date").alias("semana"), F.col("estado_sigla").alias("uf")).agg(mean("ETANOL").alias("e"), mean("GASOLINA").alias("g"))
    return s.filter("e is not null and g is not null").select("semana", "uf", F.round(F.col("e") / F.nullif(F.col("g"), F.lit(0.0)), 10).alias("razao"))


@query(
    "b10_week_over_week",
    f"with {DAILY_SQL}, s as (select cast(date_trunc('week', data_coleta) as date) as semana, produto, sum(soma) / sum(qtd_postos) as media from diario where data_coleta is not null group by 1, 2), l as (select *, lag(media) over w as antes, row_number() over (partition by produto order by semana desc) as rn from s window w as (partition by produto order by semana)) select produto, round(100 * (media - antes) / nullif(antes, 0), 4) as variacao from l where rn = 1",
)
def week_over_week(t):
    s = daily(t).filter("data_coleta is not null").groupBy(F.date_trunc("week", "data_coleta").cast("date").alias("semana"), "produto").agg((F.sum("soma_valor_venda") / F.sum("qtd_postos")).alias("media"))
    w = Window.partitionBy("produto").orderBy(F.desc("semana"))
    r = s.select("produto", "media", F.lead("media").over(w).alias("antes"), F.row_number().over(w).alias("rn")).filter("rn = 1")
    return r.select("produto", F.round(100 * (F.col("media") - F.col("antes")) / F.nullif(F.col("antes"), F.lit(0.0)), 4).alias("variacao"))


@query("b11_sync_board", "select cast(_inserted_at as date) as dia, dominio, count(*) as n, count(distinct codigo) as codigos from rfb_dominios group by 1, 2")
def sync_board(t):
    return t.rfb_dominios.groupBy(F.to_date("_inserted_at").alias("dia"), "dominio").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("codigo").alias("codigos"))


@query("b12_gate_margin", "select user_id, round(least(avg(value) - 40, max(value) - 90, 100 - min(value)), 10) as margem from events group by 1")
def gate_margin(t):
    return t.events.groupBy("user_id").agg(F.round(F.least(F.avg("value") - 40, F.max("value") - 90, 100 - F.min("value")), 10).alias("margem"))


@query("b13_usage", "select cast(ts as date) as dia, event_type, count(*) as chamadas, round(percentile_cont(0.5) within group (order by value), 10) as p50, round(avg((event_type = 'error')::int), 10) as erro, round(100.0 * sum(value) / sum(sum(value)) over (partition by cast(ts as date)), 10) as pct from events group by 1, 2")
def usage(t):
    per = t.events.groupBy(F.to_date("ts").alias("dia"), "event_type").agg(F.count(F.lit(1)).alias("chamadas"), F.round(F.percentile("value", 0.5), 10).alias("p50"), F.round(F.avg((F.col("event_type") == "error").cast("int")), 10).alias("erro"), F.sum("value").alias("s"))
    return per.select("dia", "event_type", "chamadas", "p50", "erro", F.round(F.lit(100.0) * F.col("s") / F.sum("s").over(Window.partitionBy("dia")), 10).alias("pct"))


# --- counters and histograms ---------------------------------------------------------------------------------------------


def counter_increase(df: DataFrame, series: list[str], at: str, value: str) -> DataFrame:
    """Increase of a counter between samples; a drop is a reset and counts from zero."""
    before = F.lag(value).over(Window.partitionBy(*series).orderBy(at))
    return df.withColumn("aumento", F.when(before.isNull(), None).when(F.col(value) < before, F.col(value)).otherwise(F.col(value) - before))


@query(
    "a25_counter_rate",
    "with c as (select user_id, ts, event_id, floor(value) as v from events), d as (select *, lag(v) over (partition by user_id order by event_id) as p from c) select user_id, sum(case when v < p then v else v - p end) as aumento from d where p is not null group by 1",
)
def counter_rate(t):
    c = t.events.select("user_id", "event_id", F.floor("value").cast("double").alias("v"))
    return counter_increase(c, ["user_id"], "event_id", "v").filter("aumento is not null").groupBy("user_id").agg(F.sum("aumento").alias("aumento"))


BOUNDS = [5.0, 10.0, 25.0, 50.0, 100.0, 1e9]


def histogram_quantile(q: float, counts: DataFrame, by: list[str]) -> DataFrame:
    """Quantile from cumulative buckets (le, n), linear within the bucket; the open bucket gives its lower bound."""
    w = Window.partitionBy(*by).orderBy("le")
    rows = counts.select(*by, "le", "n", F.lag("n", 1, 0).over(w).alias("below"), F.lag("le", 1, 0.0).over(w).alias("lower"), F.max("n").over(Window.partitionBy(*by)).alias("total"))
    hit = rows.filter((F.col("n") >= q * F.col("total")) & (F.col("below") < q * F.col("total")))
    inside = F.col("lower") + (F.col("le") - F.col("lower")) * (q * F.col("total") - F.col("below")) / (F.col("n") - F.col("below"))
    return hit.select(*by, F.when(F.col("le") >= 1e9, F.col("lower")).otherwise(inside).alias("quantil"))


@query(
    "a25_hist_quantile",
    "with b as (select event_type, le, count(*) filter (where value <= le) as n from events cross join (select unnest([5.0, 10.0, 25.0, 50.0, 100.0, 1e9]) as le) group by 1, 2), r as (select *, lag(n, 1, 0) over w as below, lag(le, 1, 0) over w as lower, max(n) over (partition by event_type) as total from b window w as (partition by event_type order by le)) select event_type, round(case when le >= 1e9 then lower else lower + (le - lower) * (0.9 * total - below) / (n - below) end, 10) as quantil from r where n >= 0.9 * total and below < 0.9 * total",
)
def hist_quantile(t):
    counts = t.events.groupBy("event_type").agg(*(F.count_if(F.col("value") <= b).alias(f"b{k}") for k, b in enumerate(BOUNDS)))
    long = counts.select("event_type", F.inline(F.array(*(F.struct(F.lit(b).alias("le"), F.col(f"b{k}").alias("n")) for k, b in enumerate(BOUNDS)))))
    return histogram_quantile(0.9, long, ["event_type"]).select("event_type", F.round("quantil", 10).alias("quantil"))
