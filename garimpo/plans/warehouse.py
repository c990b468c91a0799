"""The warehouse tables: fuel prices, company registry, invoices; each a function of the bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from garimpo.functions import clean, keys, text
from garimpo.operators import shred
from garimpo.operators.latest import latest_per_key
from garimpo.operators.upsert import keyed_upsert, replace_groups, snapshot, versions_from_history
from garimpo.plans.catalog import query
from garimpo.plans.scalars import PRODUCTS, product_id
from garimpo.workspace import cut, once_a_load

# --- fuel prices ---------------------------------------------------------------------------------------------------------


def anp_clean(landing: DataFrame) -> DataFrame:
    """Typed landing rows with the natural key; unreadable values are null."""
    strip = lambda c: F.regexp_replace(c, "[-./ ]", "")
    typed = landing.select(
        "produto", product_id(F.col("produto")).alias("id_produto"), clean.price(F.col("valor_de_venda")).alias("valor_venda"), clean.price(F.col("valor_de_compra")).alias("valor_compra"), "unidade_de_medida",
        clean.date_br(F.col("data_da_coleta")).alias("data_coleta"), "regiao_sigla", "estado_sigla", "municipio", "revenda", strip(F.col("cnpj_da_revenda")).alias("cnpj"), "nome_da_rua", "numero_rua", "complemento", "bairro", strip(F.col("cep")).alias("cep"), "bandeira", "arquivo", "ingestion_timestamp", "linha_id",
    )
    day = F.date_format("data_coleta", "yyyyMMdd")
    return typed.withColumn("chave", keys.natural_key(day, F.col("produto"), F.col("cnpj")))


CLEAN_SQL = (
    "clean as (select produto, case produto " + " ".join(f"when '{p}' then {k}" for p, k in PRODUCTS.items()) + " else 0 end as id_produto, "
    "case when regexp_full_match(trim(valor_de_venda), '[+-]?[0-9]+([.,][0-9]+)?') then cast(replace(trim(valor_de_venda), ',', '.') as double) end as valor_venda, unidade_de_medida, "
    "case when regexp_full_match(trim(data_da_coleta), '[0-9]{2}/[0-9]{2}/[0-9]{4}') then cast(try_strptime(trim(data_da_coleta), '%d/%m/%Y') as date) end as data_coleta, estado_sigla, municipio, revenda, "
    "regexp_replace(cnpj_da_revenda, '[-./ ]', '', 'g') as cnpj, nome_da_rua, numero_rua, bairro, regexp_replace(cep, '[-./ ]', '', 'g') as cep, bandeira, arquivo, ingestion_timestamp, linha_id from anp_landing_semanal), "
    "keyed as (select *, coalesce(strftime(data_coleta, '%Y%m%d'), '') || '|' || coalesce(produto, '') || '|' || coalesce(cnpj, '') as chave from clean), "
    "silver as (select * exclude (rn) from (select *, row_number() over (partition by chave order by ingestion_timestamp desc, arquivo desc, linha_id desc) as rn from keyed) where rn = 1), "
    "postos as (select * exclude (rn) from (select md5(cnpj) as id_posto_sk, cnpj, revenda, bandeira, estado_sigla, municipio, bairro, cep, nome_da_rua, numero_rua, row_number() over (partition by cnpj order by data_coleta desc nulls last, linha_id desc) as rn from silver where cnpj is not null) where rn = 1), "
    "produtos as (select md5(produto) as id_produto_sk, max(id_produto) as id_produto_origem, produto, max(unidade_de_medida) as unidade_de_medida from silver where produto is not null group by produto), "
    "fato as (select md5(chave) as id_fato, md5(cnpj) as id_posto_sk, md5(produto) as id_produto_sk, data_coleta, valor_venda, ingestion_timestamp from silver) "
)


def silver(t) -> DataFrame:
    """Newest row of each natural key, written once a load: the marts read what they need of it and never the landing table again."""
    return once_a_load(t.anp_landing_semanal, "silver", lambda: silver_of(t))


def silver_of(t) -> DataFrame:
    return latest_per_key(anp_clean(t.anp_landing_semanal), ["chave"], [F.desc("ingestion_timestamp"), F.desc("arquivo"), F.desc("linha_id")])


def stations(s: DataFrame) -> DataFrame:
    rows = s.filter(F.col("cnpj").isNotNull()).select("cnpj", "revenda", "bandeira", "estado_sigla", "municipio", "bairro", "cep", "nome_da_rua", "numero_rua", "data_coleta", "linha_id")
    return latest_per_key(rows, ["cnpj"], [F.desc_nulls_last("data_coleta"), F.desc("linha_id")]).withColumn("id_posto_sk", F.md5("cnpj"))


def products(s: DataFrame) -> DataFrame:
    return s.filter(F.col("produto").isNotNull()).groupBy("produto").agg(F.max("id_produto").alias("id_produto_origem"), F.max("unidade_de_medida").alias("unidade_de_medida")).withColumn("id_produto_sk", F.md5("produto"))


def price_fact(s: DataFrame) -> DataFrame:
    return s.select(F.md5("chave").alias("id_fato"), F.md5("cnpj").alias("id_posto_sk"), F.md5("produto").alias("id_produto_sk"), "data_coleta", "valor_venda", "ingestion_timestamp")


def star(t) -> DataFrame:
    s = silver(t)
    return price_fact(s).join(stations(s).select("id_posto_sk", "cnpj", "revenda", "bandeira", "estado_sigla", "municipio", "bairro", "nome_da_rua", "numero_rua"), "id_posto_sk").join(products(s), "id_produto_sk")


@query("m02_anp_silver", f"with {CLEAN_SQL} select chave, linha_id, id_produto, valor_venda, data_coleta, cnpj, cep from silver")
def anp_silver(t):
    return silver(t).select("chave", "linha_id", "id_produto", "valor_venda", "data_coleta", "cnpj", "cep")


@query("m02_dm_postos", f"with {CLEAN_SQL} select id_posto_sk, cnpj, revenda, bandeira, municipio from postos")
def dm_stations(t):
    return stations(silver(t)).select("id_posto_sk", "cnpj", "revenda", "bandeira", "municipio")


@query("m02_dm_produtos", f"with {CLEAN_SQL} select * from produtos")
def dm_products(t):
    return products(silver(t))


@query("m04_ft_anp", f"with {CLEAN_SQL} select id_fato, id_posto_sk, id_produto_sk, data_coleta, valor_venda from fato")
def ft_prices(t):
    """Incremental build: first load up to a watermark, then the rows at or after it (late files included), delete and insert by key."""
    s = price_fact(silver(t))
    mark = s.agg(F.percentile_approx(F.unix_micros(F.col("ingestion_timestamp").cast("timestamp")), 0.5).alias("m"))
    at = F.unix_micros(F.col("ingestion_timestamp").cast("timestamp"))
    first = s.crossJoin(F.broadcast(mark)).filter(at <= F.col("m")).drop("m")
    delta = s.crossJoin(F.broadcast(mark)).filter(at >= F.col("m")).drop("m")
    return keyed_upsert(first, delta, ["id_fato"]).drop("ingestion_timestamp")


@query(
    "m02_ag_semanal",
    f"""with {CLEAN_SQL} select cast(date_trunc('week', data_coleta) as date) as semana, estado_sigla as uf, produto, count(*) as qtd_coletas, count(distinct id_posto_sk) as qtd_postos, count(distinct municipio) as qtd_municipios,
        round(avg(valor_venda), 9) as preco_medio, min(valor_venda) as preco_min, max(valor_venda) as preco_max, round(percentile_cont(0.5) within group (order by valor_venda), 10) as preco_mediano
        from fato join postos using (id_posto_sk) join produtos using (id_produto_sk) group by 1, 2, 3""",
)
def weekly_mart(t):
    v = F.col("valor_venda")
    return star(t).groupBy(F.date_trunc("week", "data_coleta").cast("date").alias("semana"), F.col("estado_sigla").alias("uf"), "produto").agg(
        F.count(F.lit(1)).alias("qtd_coletas"), F.countDistinct("id_posto_sk").alias("qtd_postos"), F.countDistinct("municipio").alias("qtd_municipios"), F.round(F.avg(v), 9).alias("preco_medio"), F.min(v).alias("preco_min"), F.max(v).alias("preco_max"), F.round(F.percentile(v, 0.5), 10).alias("preco_mediano")
    )


@query(
    "m02_ag_municipio_diario",
    f"""with {CLEAN_SQL} select data_coleta, estado_sigla as uf, upper(trim(municipio)) as municipio, produto, count(*) as qtd_postos, round(sum(valor_venda), 4) as soma_valor_venda, min(valor_venda) as preco_min, max(valor_venda) as preco_max
        from fato join postos using (id_posto_sk) join produtos using (id_produto_sk) group by 1, 2, 3, 4""",
)
def daily_mart(t):
    return daily(t).withColumn("soma_valor_venda", F.round("soma_valor_venda", 4))


def daily(t) -> DataFrame:
    v = F.col("valor_venda")
    return star(t).groupBy("data_coleta", F.col("estado_sigla").alias("uf"), F.upper(F.trim("municipio")).alias("municipio"), "produto").agg(F.count(F.lit(1)).alias("qtd_postos"), F.sum(v).alias("soma_valor_venda"), F.min(v).alias("preco_min"), F.max(v).alias("preco_max"))


CURRENT_SQL = f"""{CLEAN_SQL}, col as (select *, row_number() over (partition by id_posto_sk, id_produto_sk order by data_coleta desc nulls last, id_fato) as rn, count(*) over (partition by id_posto_sk, id_produto_sk) as n from fato),
   ult as (select id_posto_sk, id_produto_sk, max(data_coleta) filter (where rn = 1) as data_coleta, max(valor_venda) filter (where rn = 1) as valor_venda, max(valor_venda) filter (where rn = 2) as anterior, max(n) as qtd_coletas from col where rn <= 2 group by 1, 2),
   atual as (select produto, cnpj, revenda, coalesce(nullif(upper(trim(bandeira)), ''), 'NAO INFORMADA') as bandeira, estado_sigla as uf, upper(trim(municipio)) as municipio, coalesce(nullif(upper(trim(bairro)), ''), 'NAO INFORMADO') as bairro,
   concat_ws(', ', nullif(trim(nome_da_rua), ''), nullif(trim(numero_rua), '')) as endereco, data_coleta, valor_venda, round(valor_venda - anterior, 10) as variacao, qtd_coletas from ult join postos using (id_posto_sk) join produtos using (id_produto_sk)) """


@query("m02_ag_posto_atual", f"with {CURRENT_SQL} select * from atual")
def current_mart(t):
    return current(t)


def current(t) -> DataFrame:
    """The newest prices, written once a load as well."""
    return once_a_load(t.anp_landing_semanal, "current", lambda: current_of(silver(t)))


def current_of(s: DataFrame) -> DataFrame:
    """Latest price of each station and product with the one before: dimensions are joined after the fact is one row per key."""
    w = Window.partitionBy("id_posto_sk", "id_produto_sk").orderBy(F.desc_nulls_last("data_coleta"), "id_fato")
    ranked = price_fact(s).select("id_posto_sk", "id_produto_sk", "data_coleta", "valor_venda", F.row_number().over(w).alias("rn"))
    pick = lambda c, n: F.max(F.when(F.col("rn") == n, F.col(c)))
    last = ranked.groupBy("id_posto_sk", "id_produto_sk").agg(pick("data_coleta", 1).alias("data_coleta"), pick("valor_venda", 1).alias("valor_venda"), pick("valor_venda", 2).alias("anterior"), F.count(F.lit(1)).alias("qtd_coletas"))
    wide = last.join(stations(s).drop("data_coleta", "linha_id"), "id_posto_sk").join(products(s), "id_produto_sk")
    part = lambda c: F.nullif(F.trim(c), F.lit(""))
    return wide.select(
        "produto", "cnpj", "revenda", text.clean_label(F.col("bandeira"), "NAO INFORMADA").alias("bandeira"), F.col("estado_sigla").alias("uf"), F.upper(F.trim("municipio")).alias("municipio"), text.clean_label(F.col("bairro"), "NAO INFORMADO").alias("bairro"),
        F.concat_ws(", ", part("nome_da_rua"), part("numero_rua")).alias("endereco"), "data_coleta", "valor_venda", F.round(F.col("valor_venda") - F.col("anterior"), 10).alias("variacao"), "qtd_coletas",
    )


# --- company registry ----------------------------------------------------------------------------------------------------


def newest_month(df: DataFrame, key: list[str]) -> DataFrame:
    """A second loaded month may not double the keys: the newest month's last row stays."""
    return latest_per_key(df, key, [F.desc("referencia_mes"), F.desc("_inserted_at"), F.desc("linha_id")])


NEWEST = "(select * exclude (rn) from (select *, row_number() over (partition by {k} order by referencia_mes desc, _inserted_at desc, linha_id desc) as rn from {t}) where rn = 1)"


@query(
    "m06_dm_empresas",
    f"select md5(coalesce(cnpj_basico, '{keys.NULL_PART}')) as sk_empresa, cnpj_basico, razao_social, cast(capital_social as decimal(18, 2)) as capital_social, porte_empresa, referencia_mes from {NEWEST.format(k='cnpj_basico', t='rfb_empresas')} where cnpj_basico is not null",
)
def dm_companies(t):
    rows = newest_month(t.rfb_empresas.filter("cnpj_basico is not null"), ["cnpj_basico"])
    return rows.select(keys.surrogate_key(F.col("cnpj_basico")).alias("sk_empresa"), "cnpj_basico", "razao_social", F.col("capital_social").cast("decimal(18,2)").alias("capital_social"), "porte_empresa", "referencia_mes")


@query(
    "m06_ft_receita_federal",
    f"select md5(coalesce(cnpj_completo, '{keys.NULL_PART}')) as sk_estabelecimento, md5(coalesce(cnpj_basico, '{keys.NULL_PART}')) as sk_empresa, cnae_fiscal_principal as codg_cnae, municipio as codg_municipio, situacao_cadastral, 1 as qtd_estabelecimentos from {NEWEST.format(k='cnpj_completo', t='rfb_estabelecimentos')} where cnpj_completo is not null",
)
def ft_registry(t):
    """The newest month's row of each key, by one window: what month after month of upserts leaves behind."""
    built = newest_month(t.rfb_estabelecimentos.filter("cnpj_completo is not null"), ["cnpj_completo"])
    return built.select(keys.surrogate_key(F.col("cnpj_completo")).alias("sk_estabelecimento"), keys.surrogate_key(F.col("cnpj_basico")).alias("sk_empresa"), F.col("cnae_fiscal_principal").alias("codg_cnae"), F.col("municipio").alias("codg_municipio"), "situacao_cadastral", F.lit(1).alias("qtd_estabelecimentos"))


@query(
    "m06_dm_socios",
    f"""with q as (select codigo, descricao from (select ltrim(trim(codigo), '0') as codigo, descricao, row_number() over (partition by ltrim(trim(codigo), '0') order by referencia_mes desc, _inserted_at desc, linha_id desc) as rn from rfb_dominios where dominio = 'qualificacoes') where rn = 1)
        select sk_socio_empresa, nome_socio_razao_social, qualificacao_socio, descricao as desc_qualificacao, data_entrada_sociedade from (select md5(coalesce(cnpj_basico, '{keys.NULL_PART}') || '-' || coalesce(cnpj_cpf_socio, '{keys.NULL_PART}') || '-' || coalesce(nome_socio_razao_social, '{keys.NULL_PART}')) as sk_socio_empresa, *,
        row_number() over (partition by cnpj_basico, cnpj_cpf_socio, nome_socio_razao_social order by data_entrada_sociedade desc nulls first, referencia_mes desc, linha_id desc) as rn from rfb_socios where cnpj_basico is not null) left join q on q.codigo = cast(qualificacao_socio as varchar) where rn = 1""",
)
def dm_partners(t):
    code = F.regexp_replace(F.trim("codigo"), "^0+", "")
    domain = t.rfb_dominios.filter("dominio = 'qualificacoes'").select(code.alias("codigo"), "descricao", "referencia_mes", "_inserted_at", "linha_id")
    q = newest_month(domain, ["codigo"]).select("codigo", F.col("descricao").alias("desc_qualificacao"))
    rows = t.rfb_socios.filter("cnpj_basico is not null")
    one = latest_per_key(rows, ["cnpj_basico", "cnpj_cpf_socio", "nome_socio_razao_social"], [F.desc_nulls_first("data_entrada_sociedade"), F.desc("referencia_mes"), F.desc("linha_id")])
    return one.join(q, F.col("codigo") == F.col("qualificacao_socio").cast("string"), "left").select(keys.surrogate_key(F.col("cnpj_basico"), F.col("cnpj_cpf_socio"), F.col("nome_socio_razao_social")).alias("sk_socio_empresa"), "nome_socio_razao_social", "qualificacao_socio", "desc_qualificacao", "data_entrada_sociedade")


@query(
    "m06_dm_endereco",
    f"select md5(coalesce(cnpj_completo, '{keys.NULL_PART}')) as sk_estabelecimento, tipo_logradouro, logradouro, nullif(trim(numero), '') as numero, nullif(trim(bairro), '') as bairro, cep, uf from {NEWEST.format(k='cnpj_completo', t='rfb_estabelecimentos')} where cnpj_completo is not null",
)
def dm_address(t):
    rows = newest_month(t.rfb_estabelecimentos.filter("cnpj_completo is not null"), ["cnpj_completo"])
    return rows.select(keys.surrogate_key(F.col("cnpj_completo")).alias("sk_estabelecimento"), "tipo_logradouro", "logradouro", clean.blank_to_null(F.col("numero")).alias("numero"), clean.blank_to_null(F.col("bairro")).alias("bairro"), "cep", "uf")


@query("m01_dominios", f"select dominio, codigo, descricao from {NEWEST.format(k='dominio, codigo', t='(select * replace (trim(codigo) as codigo) from rfb_dominios)')}")
def domains(t):
    return newest_month(t.rfb_dominios.withColumn("codigo", F.trim("codigo")), ["dominio", "codigo"]).select("dominio", "codigo", "descricao")


# --- invoices ------------------------------------------------------------------------------------------------------------

CURRENT_XML = "(select * exclude (rn) from (select *, row_number() over (partition by chave order by lote_id desc, arquivo desc) as rn from (select lote_id, arquivo, regexp_extract(conteudo, 'Id=\"NFe([0-9]{44})\"', 1) as chave, conteudo from nfe_xml where regexp_matches(rtrim(conteudo, ' \n\r\t'), '(nfeProc|NFe)>$'))) where rn = 1)"


def current_invoices(t) -> DataFrame:
    """The newest sending of each whole invoice. The document itself does not go through the window: its keys do."""
    whole = t.nfe_xml.filter(F.rtrim("conteudo").rlike(r"(nfeProc|NFe)>\s*$")).select("lote_id", "arquivo", F.regexp_extract("conteudo", 'Id="NFe([0-9]{44})"', 1).alias("chave"))
    last = whole.groupBy("chave").agg(F.max(F.struct("lote_id", "arquivo")).alias("m")).select("chave", "m.*")
    return t.nfe_xml.select("lote_id", "arquivo", "conteudo", "carregado_em").join(last, ["lote_id", "arquivo"])


@query("m12_nfe_vigente", f"select lote_id, arquivo, chave from {CURRENT_XML}")
def invoices_current(t):
    return current_invoices(t).select("lote_id", "arquivo", "chave")


HEADER = {"c_uf": "ide.cUF", "nat_op": "ide.natOp", "n_nf": "ide.nNF", "dh_emissao": "ide.dhEmi", "emit_cnpj": "emit.CNPJ", "emit_uf": "emit.enderEmit.UF", "dest_cnpj": "dest.CNPJ", "dest_uf": "dest.enderDest.UF", "v_nf": "total.ICMSTot.vNF", "xmun": "emit.enderEmit.xMun"}
ITEM = {"n_item": "@nItem", "cprod": "prod.cProd", "ncm": "prod.NCM", "cfop": "prod.CFOP", "vprod": "prod.vProd", "cst_ibscbs": "imposto.IBSCBS.CST", "v_ibs": "imposto.IBSCBS.gIBSCBS.vIBS", "v_cbs": "imposto.IBSCBS.gIBSCBS.gCBS.vCBS", "vbc": "imposto.IBSCBS.gIBSCBS.vBC"}


def shredded(t) -> DataFrame:
    """The current invoices, parsed once a load and written: headers, items and marts are plain reads of it."""
    return once_a_load(t.nfe_xml, "invoices", lambda: parsed(t))


def parsed(t) -> DataFrame:
    return shred.shred(current_invoices(t), ["chave", "lote_id"], "conteudo", groups=["infNFe", "det"])


def headers(t, found: DataFrame | None = None) -> DataFrame:
    return shred.flat_table(parsed(t) if found is None else found, ["chave", "lote_id"], "infNFe", HEADER)


def items(t, found: DataFrame | None = None) -> DataFrame:
    rows = shred.flat_table(parsed(t) if found is None else found, ["chave", "lote_id"], "det", ITEM)
    money = lambda c: F.col(c).cast("decimal(15,2)").alias(c)
    return rows.select("chave", "lote_id", F.col("n_item").cast("int").alias("n_item"), "cprod", "ncm", "cfop", "cst_ibscbs", *(money(c) for c in ("vprod", "v_ibs", "v_cbs", "vbc")))


def tag(name: str, of: str = "conteudo") -> str:
    return f"nullif(regexp_extract({of}, '<(?:n:)?{name}>([^<]*)<', 1), '')"


@query(
    "j12_nfe_nota",
    f"select chave, {tag('cUF')} as c_uf, {tag('natOp')} as nat_op, cast({tag('nNF')} as bigint) as n_nf, cast(timezone('UTC', cast({tag('dhEmi')} as timestamptz)) as timestamp) as dh_emissao, cast({tag('vNF')} as decimal(15, 2)) as v_nf from {CURRENT_XML}",
)
def invoice_headers(t):
    h = headers(t)
    return h.select("chave", "c_uf", "nat_op", F.col("n_nf").cast("bigint").alias("n_nf"), F.col("dh_emissao").cast("timestamp").cast("timestamp_ntz").alias("dh_emissao"), F.col("v_nf").cast("decimal(15,2)").alias("v_nf"))


ITEMS_SQL = f"""(select chave, lote_id, cast(regexp_extract(x, 'nItem="([0-9]+)"', 1) as int) as n_item, {tag('cProd', 'x')} as cprod, {tag('NCM', 'x')} as ncm, {tag('CFOP', 'x')} as cfop, cast({tag('vProd', 'x')} as decimal(15, 2)) as vprod,
   {tag('CST', 'i')} as cst_ibscbs, cast({tag('vIBS', 'i')} as decimal(15, 2)) as v_ibs, cast({tag('vCBS', 'i')} as decimal(15, 2)) as v_cbs, cast({tag('vBC', 'i')} as decimal(15, 2)) as vbc
   from (select chave, lote_id, x, regexp_extract(x, '(?s)<(?:n:)?IBSCBS>.*</(?:n:)?IBSCBS>') as i from (select chave, lote_id, unnest(regexp_extract_all(conteudo, '(?s)<(?:n:)?det .*?</(?:n:)?det>')) as x from {CURRENT_XML})))"""


@query("j12_nfe_item", f"select chave, n_item, cprod, ncm, cfop, vprod, cst_ibscbs, v_ibs, v_cbs, vbc from {ITEMS_SQL}")
def invoice_items(t):
    return items(t).drop("lote_id")


def monthly(rows: DataFrame) -> DataFrame:
    total = lambda c: F.sum(c).cast("decimal(18,2)").alias(c)
    rate = F.round(F.lit(100) * F.sum(F.col("v_ibs") + F.col("v_cbs")).cast("double") / F.nullif(F.sum("vbc"), F.lit(0).cast("decimal(25,2)")).cast("double"), 4)
    return rows.groupBy("ano_mes", "c_uf", "cst_ibscbs").agg(F.countDistinct("chave").alias("qtd_notas"), F.count(F.lit(1)).alias("qtd_itens"), total("vprod"), total("v_ibs"), total("v_cbs"), rate.alias("carga"))


@query(
    "m07_ag_nfe_mensal",
    f"""select ano_mes, c_uf, cst_ibscbs, count(distinct chave) as qtd_notas, count(*) as qtd_itens, cast(sum(vprod) as decimal(18, 2)) as vprod, cast(sum(v_ibs) as decimal(18, 2)) as v_ibs, cast(sum(v_cbs) as decimal(18, 2)) as v_cbs,
        round(100 * cast(sum(v_ibs + v_cbs) as double) / nullif(cast(sum(vbc) as double), 0), 4) as carga
        from {ITEMS_SQL} join (select chave, cast(strftime(cast({tag('dhEmi')} as timestamptz) at time zone 'UTC' - interval 3 hour, '%Y%m') as int) as ano_mes, {tag('cUF')} as c_uf from {CURRENT_XML}) using (chave) group by 1, 2, 3""",
)
def monthly_mart(t):
    """Only the months that the newest batch touches are recomputed; the others keep their rows."""
    found = shredded(t)
    h = headers(t, found).select("chave", "lote_id", "c_uf", F.date_format(F.from_utc_timestamp(F.col("dh_emissao").cast("timestamp"), "America/Sao_Paulo"), "yyyyMM").cast("int").alias("ano_mes"))
    rows = cut(items(t, found).drop("lote_id").join(h, "chave"), "invoice-items")
    newest = h.agg(F.max("lote_id").alias("lote_id"))
    affected = h.join(F.broadcast(newest), "lote_id", "left_semi").select("ano_mes")
    return replace_groups(monthly(rows), rows, affected, ["ano_mes"], monthly)


PARTY = ["xmun", "emit_uf"]


@query(
    "m09_participante_scd2",
    f"""with h as (select {tag('CNPJ')} as doc, {tag('xMun')} as xmun, nullif(regexp_extract(conteudo, '(?s)<(?:n:)?enderEmit>.*?<(?:n:)?UF>([^<]*)<', 1), '') as emit_uf, cast(timezone('UTC', cast({tag('dhEmi')} as timestamptz)) as timestamp) as quando from {CURRENT_XML}),
        p as (select doc, md5(concat_ws('|', xmun, emit_uf)) as hash_atributos, max(xmun) as xmun, max(emit_uf) as emit_uf, min(quando) as primeira, max(quando) as ultima, count(*) as qtd from h where doc is not null group by 1, 2)
        select md5(doc || '|' || hash_atributos) as sk, doc, xmun, emit_uf, row_number() over w as nr_versao, case when row_number() over w = 1 then timestamp '1900-01-01' else primeira end as inicio,
        coalesce(lead(primeira) over w, timestamp '9999-12-31') as fim, lead(primeira) over w is null as vigente, primeira, ultima, qtd from p window w as (partition by doc order by primeira, hash_atributos)""",
)
def parties(t):
    events = headers(t).select(F.col("emit_cnpj").alias("doc"), *PARTY, F.col("dh_emissao").cast("timestamp").cast("timestamp_ntz").alias("at"))
    return versions_from_history(events, "doc", PARTY, "at", F.expr("timestamp_ntz'1900-01-01 00:00:00'"), F.expr("timestamp_ntz'9999-12-31 00:00:00'"))


@query(
    "m02_dm_nfe_tempo",
    """select cast(strftime(d, '%Y%m%d') as int) as sk_data, cast(d as date) as data, year(d) as ano, quarter(d) as trimestre, month(d) as mes, cast(strftime(d, '%Y%m') as int) as ano_mes,
       (['janeiro','fevereiro','marco','abril','maio','junho','julho','agosto','setembro','outubro','novembro','dezembro'])[month(d)] as nome_mes, isodow(d) as dia_semana, isodow(d) in (6, 7) as fl_fim_de_semana
       from (select unnest(generate_series(date '2025-01-01', date '2027-12-31', interval 1 day)) as d)""",
)
def calendar(t):
    days = t.spark.range(1).select(F.explode(F.expr("sequence(date'2025-01-01', date'2027-12-31', interval 1 day)")).alias("data"))
    names = F.array(*(F.lit(x) for x in "janeiro fevereiro marco abril maio junho julho agosto setembro outubro novembro dezembro".split()))
    weekday = F.extract(F.lit("dayofweek_iso"), F.col("data"))
    return days.select(
        F.date_format("data", "yyyyMMdd").cast("int").alias("sk_data"), "data", F.year("data").alias("ano"), F.quarter("data").alias("trimestre"), F.month("data").alias("mes"), F.date_format("data", "yyyyMM").cast("int").alias("ano_mes"), F.element_at(names, F.month("data")).alias("nome_mes"), weekday.alias("dia_semana"), weekday.isin(6, 7).alias("fl_fim_de_semana")
    )


# --- incremental operators on the star-schema tables ---------------------------------------------------------------------

SPLIT = "1998-01-01"


def _split(t):
    at = F.expr(f"timestamp_ntz'{SPLIT} 00:00:00'")
    base = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    # the delta: late orders, and earlier ones whose price was corrected
    late = base.filter(F.col("o_orderdate") >= at)
    fixed = base.filter((F.col("o_orderdate") < at) & (F.col("o_custkey") % 7 == 0)).withColumn("o_totalprice", F.round(F.col("o_totalprice") + 1, 2))
    return base.filter(F.col("o_orderdate") < at), late.unionByName(fixed)


@query(
    "m05_merge",
    f"select o_orderkey, o_custkey, case when o_orderdate < timestamp '{SPLIT}' and o_custkey % 7 = 0 then round(o_totalprice + 1, 2) else o_totalprice end as o_totalprice from orders",
)
def merge(t):
    base, delta = _split(t)
    return keyed_upsert(base, delta, ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "m08_snapshot",
    """with cur as (select c_custkey, c_mktsegment, timestamp '2026-01-01' as valid_from from customer where c_custkey % 5 <> 0), src as (select c_custkey, case when c_custkey % 3 = 0 then 'NOVO' else c_mktsegment end as c_mktsegment from customer where c_custkey % 4 <> 0)
       select c.c_custkey, c.c_mktsegment, c.valid_from, case when s.c_custkey is null or s.c_mktsegment <> c.c_mktsegment then timestamp '2026-02-01' end as valid_to from cur c left join src s using (c_custkey)
       union all select s.c_custkey, s.c_mktsegment, timestamp '2026-02-01', null from src s left join cur c using (c_custkey) where c.c_custkey is null or s.c_mktsegment <> c.c_mktsegment""",
)
def snapshots(t):
    ntz = lambda x: F.expr(f"timestamp_ntz'{x} 00:00:00'")
    cur = t.customer.filter("c_custkey % 5 <> 0").select("c_custkey", "c_mktsegment", ntz("2026-01-01").alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    src = t.customer.filter("c_custkey % 4 <> 0").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "NOVO").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    return snapshot(cur, src, ["c_custkey"], ["c_mktsegment"], ntz("2026-02-01"))


@query(
    "m10_batch_queue",
    "select lote_id from nfe_lote where status <> 'PROCESSADO' and lote_id <= (select max(lote_id) - 1 from nfe_lote) order by lote_id limit 3",
)
def batch_queue(t):
    top = t.nfe_lote.agg((F.max("lote_id") - 1).alias("ate"))
    return t.nfe_lote.filter("status <> 'PROCESSADO'").crossJoin(F.broadcast(top)).filter("lote_id <= ate").select("lote_id").orderBy("lote_id").limit(3)


@query(
    "m11_batch_lifecycle",
    "select lote_id, case when x.ok > 0 then 'CARREGADO' else 'PROCESSADO' end as status, coalesce(x.n, 0) as qtd_arquivos, coalesce(x.ok, 0) as qtd_carregados from nfe_lote left join (select lote_id, count(*) as n, count(*) filter (where regexp_matches(rtrim(conteudo, ' \n\r\t'), '(nfeProc|NFe)>$')) as ok from nfe_xml group by 1) x using (lote_id)",
)
def lifecycle(t):
    whole = F.rtrim("conteudo").rlike(r"(nfeProc|NFe)>\s*$")
    counts = t.nfe_xml.groupBy("lote_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(whole).alias("ok"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return t.nfe_lote.join(counts, "lote_id", "left").select("lote_id", F.when(zero("ok") > 0, "CARREGADO").otherwise("PROCESSADO").alias("status"), zero("n").alias("qtd_arquivos"), zero("ok").alias("qtd_carregados"))


@query(
    "m13_hash_upsert",
    "select acao, count(*) as n from (select case when a.p_partkey is null then 'inserida' when b.p_partkey is null then 'removida' when a.p_size <> b.p_size then 'alterada' when a.s <> b.s then 'recarimbada' else 'igual' end as acao from (select p_partkey, p_size, 1 as s from part where p_partkey % 50 <> 0) a full join (select p_partkey, case when p_partkey % 9 = 0 then p_size + 1 else p_size end as p_size, case when p_partkey % 4 = 0 then 2 else 1 end as s from part where p_partkey % 60 <> 1) b on a.p_partkey = b.p_partkey) group by 1",
)
def hash_upsert(t):
    from garimpo.operators.upsert import classify

    stored = t.part.filter("p_partkey % 50 <> 0").select("p_partkey", "p_size", F.lit(1).alias("s"))
    wanted = t.part.filter("p_partkey % 60 <> 1").select("p_partkey", F.when(F.col("p_partkey") % 9 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")).alias("p_size"), F.when(F.col("p_partkey") % 4 == 0, 2).otherwise(1).alias("s"))
    return classify(stored, wanted, ["p_partkey"], ["p_size"], ["s"]).groupBy("acao").agg(F.count(F.lit(1)).alias("n"))


@query(
    "m15_vector_sync",
    "select case when b.k is null then 'nova' when a.k is null then 'obsoleta' else 'mantida' end as acao, count(*) as n from (select distinct md5(text) as k from documents where lang = 'pt') a full join (select distinct md5(text) as k from documents where n_chars > 800) b on a.k = b.k group by 1",
)
def vector_sync(t):
    from garimpo.operators.latest import set_sync

    return set_sync(t.documents.filter("lang = 'pt'").select(F.md5("text").alias("k")), t.documents.filter("n_chars > 800").select(F.md5("text").alias("k")), ["k"]).groupBy("acao").agg(F.count(F.lit(1)).alias("n"))


@query("m18_two_output_guard", "select count(distinct referencia_mes) = 1 as consistente, count(distinct referencia_mes) as versoes from (select referencia_mes from rfb_empresas union all select referencia_mes from rfb_socios)")
def two_outputs(t):
    v = t.rfb_empresas.select("referencia_mes").unionByName(t.rfb_socios.select("referencia_mes")).agg(F.countDistinct("referencia_mes").alias("versoes"))
    return v.select((F.col("versoes") == 1).alias("consistente"), "versoes")
