"""Sources and sinks as named queries: each writes to the shared folder and reads back what a reader would see."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from garimpo.operators.upsert import Target
from garimpo.plans.catalog import query
from garimpo.sources import files
from garimpo.workspace import fresh

COLUMNS = ["p_partkey", "p_name", "p_brand"]


@query("s01_csv_contract", "select cast(p_partkey as varchar) as p_partkey, p_name, p_brand, false as lossy from part")
def csv_contract(t):
    """Header with a byte order mark, blanks and another spelling; an extra column."""
    at = fresh(t.spark, "csv")
    t.part.select(F.col("p_partkey").alias("﻿P PartKey"), F.col("p_name").alias(" P - Name "), F.col("p_brand").alias("P Brand"), F.lit("x").alias("Extra")).write.csv(at, sep=";", header=True, ignoreLeadingWhiteSpace=False)
    return files.read_contract_csv(t.spark, at, COLUMNS)


def unlike_files(t) -> str:
    """Files of one folder with unlike headers: as agreed, in another order, with an extra column, without a column."""
    at = fresh(t.spark, "csv")
    part = lambda k: t.part.filter(F.col("p_partkey") % 4 == k)
    shapes = ([c for c in COLUMNS], COLUMNS[::-1], ["p_size", *COLUMNS], COLUMNS[:2])
    for k, columns in enumerate(shapes):
        part(k).select(*(F.col(c).cast("string").alias(c.replace("_", " - ").title() if k == 1 else c) for c in columns)).coalesce(1).write.csv(f"{at}/mensal/{k}", sep=";", header=True)
    return at


@query("s03_contract_missing", "select cast(p_partkey as varchar) as p_partkey, p_name, p_brand, false as lossy from part where p_partkey % 4 <> 3")
def missing(t):
    """The file without a column is refused alone; the others load by their own headers."""
    rows, refused = files.land_csv(t.spark, [p for p, _ in files.list_files(t.spark, f"{unlike_files(t)}/mensal", ".csv")], COLUMNS)
    if [why for _, why in refused] != ["falta p_brand"]:
        raise ValueError(refused)
    return rows.drop("arquivo")


@query("s04_landing_files", "select cast(p_partkey as varchar) as p_partkey, p_name, p_brand from part where p_partkey % 4 <> 3")
def landing(t):
    """Two runs of the landing driver over the same files leave them loaded once; the second, with their keys done, loads none."""
    at, table = unlike_files(t), fresh(t.spark, "landing")
    first, _ = files.land(t.spark, at, COLUMNS, table)
    files.land(t.spark, at, COLUMNS, table)
    again, refused = files.land(t.spark, at, COLUMNS, table, set(first))
    if again or len(refused) != 1:
        raise ValueError((again, refused))
    return t.spark.read.parquet(table).select(*COLUMNS)


@query("s04_pending", "select distinct arquivo from anp_landing_semanal where arquivo not in (select arquivo from anp_landing_semanal where ingestion_timestamp < timestamp '2025-12-01')")
def pending(t):
    before = F.expr("timestamp_ntz'2025-12-01 00:00:00'")
    return files.pending_files(t.anp_landing_semanal, t.anp_landing_semanal.filter(F.col("ingestion_timestamp") < before), "arquivo")


def zipped(t):
    """Customers as ZIPs of latin-1 lines, at most 5,000 rows each, some rows ragged."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        b = io.BytesIO()
        lines = [f'{k};"{n}";{s}' + (";extra;mais" if k % 10 == 0 else "") if k % 7 else f"{k}" for k, n, s in zip(pdf.c_custkey, pdf.c_name, pdf.c_mktsegment)]
        with zipfile.ZipFile(b, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("dados.csv", "\r\n\r\n".join(lines).encode("latin-1"))
        return pd.DataFrame({"nome": [f"Clientes{pdf.g.iloc[0]}.zip"], "conteudo": [b.getvalue()]})

    return t.customer.withColumn("g", F.expr("c_custkey div 5000")).groupBy("g").applyInPandas(run, "nome string, conteudo binary")


ROWS = "(select cast(c_custkey as varchar) as f0, case when c_custkey % 7 = 0 then '' else c_name end as f1, case when c_custkey % 7 = 0 then '' when c_custkey % 10 = 0 then c_mktsegment || ' extra mais' else c_mktsegment end as f2 from customer)"


@query("s05_zip_csv", f"select * from {ROWS}")
def zip_csv(t):
    return files.unzip(zipped(t), "nome", "conteudo", 3).drop("arquivo")


@query("s06_ragged_repair", f"select count(*) as linhas, count(*) filter (where f2 = '') as curtas, count(*) filter (where f2 like '% mais') as longas from {ROWS}")
def ragged(t):
    return files.unzip(zipped(t), "nome", "conteudo", 3).agg(F.count(F.lit(1)).alias("linhas"), F.count_if(F.col("f2") == "").alias("curtas"), F.count_if(F.col("f2").endswith(" mais")).alias("longas"))


@query("s07_row_limit", "select 'Clientes' || g || '.zip' as arquivo, least(n, 100) as n from (select c_custkey // 5000 as g, count(*) as n from customer group by 1)")
def row_limit(t):
    return files.unzip(zipped(t), "nome", "conteudo", 3, limit=100).groupBy("arquivo").agg(F.count(F.lit(1)).alias("n"))


@query("s08_entity_name", "select distinct _source_file as arquivo, lower(regexp_replace(regexp_replace(regexp_replace(_source_file, '\\.[A-Za-z]+$', ''), '[0-9]+$', ''), '([a-z0-9])([A-Z])', '\\1_\\2', 'g')) as entidade from (select _source_file from rfb_empresas union all select _source_file from rfb_estabelecimentos union all select _source_file from rfb_socios union all select _source_file from rfb_dominios)")
def entity(t):
    sources = t.rfb_empresas.select("_source_file").unionByName(t.rfb_estabelecimentos.select("_source_file")).unionByName(t.rfb_socios.select("_source_file")).unionByName(t.rfb_dominios.select("_source_file"))
    return sources.distinct().select(F.col("_source_file").alias("arquivo"), files.entity_name(F.col("_source_file")).alias("entidade"))


@query("s09_parquet_roundtrip", "select * from supplier")
def roundtrip(t):
    at = fresh(t.spark, "parquet")
    t.supplier.write.option("compression", "snappy").parquet(at)
    return t.spark.read.parquet(at)


@query("s10_hive_layout", "select referencia_mes as ref_month, count(*) as n from rfb_socios where referencia_mes = 202604 group by 1")
def layout(t):
    at = fresh(t.spark, "socios")
    t.rfb_socios.withColumn("ref_month", F.col("referencia_mes")).write.partitionBy("ref_month").parquet(at)
    return t.spark.read.parquet(at).filter("ref_month = 202604").groupBy("ref_month").agg(F.count(F.lit(1)).alias("n"))


@query("s12_glob_head", "select r_name from (select * from region union all select * from region) order by r_name limit 3")
def glob(t):
    at = fresh(t.spark, "glob")
    for k in (1, 2):
        t.region.write.parquet(f"{at}/parte{k}")
    return t.spark.read.parquet(f"{at}/parte*").select("r_name").orderBy("r_name").limit(3)


@query("s13_resume", "select distinct _source_file from rfb_estabelecimentos where _source_file not in (select distinct _source_file from rfb_estabelecimentos where referencia_mes < 202605)")
def resume(t):
    return files.pending_files(t.rfb_estabelecimentos, t.rfb_estabelecimentos.filter("referencia_mes < 202605"), "_source_file")


@query("s16_nul_sanitised", "select c_custkey, c_name from customer")
def nul(t):
    dirty = t.customer.select("c_custkey", F.concat(F.substring("c_name", 1, 3), F.lit("\x00"), F.substring("c_name", 4, 100)).alias("c_name"))
    return files.no_nul(dirty)


@query("s17_replace_partition", "select case when o_orderstatus = 'P' then 0 else o_totalprice end as valor, o_orderkey, o_orderstatus from orders")
def replace_partition(t):
    at = fresh(t.spark, "orders")
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").alias("valor"), "o_orderstatus")
    rows.write.partitionBy("o_orderstatus").parquet(at)
    files.replace_partitions(rows.filter("o_orderstatus = 'P'").withColumn("valor", F.lit(0.0)), at, ["o_orderstatus"])
    return t.spark.read.parquet(at).select("valor", "o_orderkey", "o_orderstatus")


@query("s18_replace_file", "select arquivo, count(*) as n from anp_csv_bruto group by 1")
def replace_file(t):
    """The same file loaded twice is there once."""
    target = Target(t.spark, fresh(t.spark, "landing"))
    target.upsert(t.anp_csv_bruto, ["arquivo"])
    target.upsert(t.anp_csv_bruto, ["arquivo"])
    return target.read().groupBy("arquivo").agg(F.count(F.lit(1)).alias("n"))


@query("s19_additive_columns", "select r_regionkey, r_name, null::boolean as _suspeita from region union all select r_regionkey + 10, r_name, false from region")
def additive(t):
    at = fresh(t.spark, "region")
    t.region.write.parquet(at)
    t.region.select((F.col("r_regionkey") + 10).alias("r_regionkey"), "r_name", F.lit(False).alias("_suspeita")).write.mode("append").parquet(at)
    return t.spark.read.option("mergeSchema", "true").parquet(at)


@query("s20_xml_folder", "select count(*) as arquivos, count(*) filter (where not regexp_matches(rtrim(conteudo, ' \n\r\t'), '(nfeProc|NFe)>$')) as quarentena from nfe_xml")
def xml_folder(t):
    from garimpo.operators import shred

    found = shred.shred(t.nfe_xml, ["lote_id", "arquivo"], "conteudo", payload=False)
    per = found.groupBy("lote_id", "arquivo").agg(F.max("erro").alias("erro"))
    return per.agg(F.count(F.lit(1)).alias("arquivos"), F.count("erro").alias("quarentena"))


@query("s22_table_read", "select n_name from nation where n_regionkey = 1")
def table_read(t):
    at = fresh(t.spark, "tabela")
    t.nation.write.parquet(at)
    t.spark.read.parquet(at).createOrReplaceTempView("garimpo_nation")
    return t.spark.sql("select n_name from garimpo_nation where n_regionkey = :r", args={"r": 1})


@query("s23_append", "select * from region union all select * from region")
def append(t):
    at = fresh(t.spark, "anexo")
    t.region.write.mode("append").parquet(at)
    t.region.write.mode("append").parquet(at)
    return t.spark.read.parquet(at)


@query("s24_html_links", "select p_partkey, 'https://exemplo.invalid/' || p_partkey || '.csv' as link from part")
def html(t):
    page = F.concat(F.lit('<h2>Outros</h2><a href="nao.csv">x</a><h3 class="t"> Dados </h3><ul><li><a class="l" href="https://exemplo.invalid/'), F.col("p_partkey").cast("string"), F.lit('.csv">a</a></ul><h2>Fim</h2><a href="tambem-nao.csv">'))
    return t.part.select("p_partkey", F.explode(files.links(page, "Dados")).alias("link"))


@query("s26_content_versions", "select count(distinct sha256(text)) as versoes, count(*) - count(distinct sha256(text)) as iguais from documents")
def versions(t):
    per = t.documents.groupBy(F.sha2("text", 256).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("versoes"), (F.sum("n") - F.count(F.lit(1))).alias("iguais"))


@query("s27_lake_manifest", "select true as pulado, count(*) as n from region")
def lake(t):
    """Data first, pointer last; the same stamp is skipped the second time."""
    target = Target(t.spark, fresh(t.spark, "lake"))
    target.write(t.region, versao="1", codigo="a")
    skipped = target.up_to_date(versao="1", codigo="a") and not target.up_to_date(versao="2", codigo="a")
    return target.read().agg(F.lit(skipped).alias("pulado"), F.count(F.lit(1)).alias("n"))


@query("s28_seed", "select * from (values ('000', 'a', 1.5), ('010', 'b', 2.0)) v(cst, descricao, aliquota)")
def seed(t):
    """Codes stay text: leading zeros survive."""
    lines = t.spark.createDataFrame([("000;a;1.5",), ("010;b;2.0",)], "value string")
    return lines.select(F.from_csv("value", "cst string, descricao string, aliquota double", {"sep": ";"}).alias("r")).select("r.*")


@query("s29_audit_upsert", "select user_id, max(event_id) as passo, count(*) as estados from events group by 1")
def audit(t):
    """Both states are appended; readers take the latest."""
    at = fresh(t.spark, "audit")
    t.events.select("user_id", "event_id").write.mode("append").parquet(at)
    return t.spark.read.parquet(at).groupBy("user_id").agg(F.max("event_id").alias("passo"), F.count(F.lit(1)).alias("estados"))


@query("s30_insert_ignore", "select c_custkey from customer where c_custkey % 3 <> 0")
def ignore(t):
    return files.insert_ignore(t.customer.filter("c_custkey % 3 = 0"), t.customer.union(t.customer), ["c_custkey"]).select("c_custkey")


@query("s32_csv_export", "select n_nationkey, n_name from nation")
def export(t):
    at = fresh(t.spark, "export")
    t.nation.select("n_nationkey", "n_name").write.csv(at, header=True)
    return t.spark.read.schema("n_nationkey int, n_name string").csv(at, header=True)


@query("s33_log_lines", "select event_id, 'stderr' as stream, case when event_type = 'error' then 'ERROR' else 'INFO' end as level, event_type as event from events")
def logs(t):
    payload = F.to_json(F.struct(F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"), F.col("event_type").alias("event"), F.lit("2026-01-01T00:00:00Z").alias("ts")))
    line = F.to_json(F.struct(F.lit("stderr").alias("stream"), F.concat(F.lit("etapa "), payload).alias("log")))
    return files.log_lines(t.events.select("event_id", line.alias("linha")), "linha").select("event_id", "stream", "level", "event")


@query("s34_metric_labels", "select event_type, 'airflow' as sistema, 'dag-' || event_type as dag, 'passo' as tarefa, 'duration' as medida, count(*) as n from events group by 1")
def labels(t):
    name = F.concat(F.lit("airflow.task.dag-"), F.col("event_type"), F.lit(".passo.duration"))
    return t.events.select("event_type", *files.metric_labels(name)).groupBy("event_type", "sistema", "dag", "tarefa", "medida").agg(F.count(F.lit(1)).alias("n"))


@query("s36_source_freshness", "select dominio, cast(floor(epoch(timestamp '2026-05-20' - max(_inserted_at)) / 3600) as bigint) as horas from rfb_dominios group by 1")
def freshness(t):
    return t.rfb_dominios.groupBy("dominio").agg(F.floor(F.expr("timestampdiff(SECOND, max(_inserted_at), timestamp_ntz'2026-05-20 00:00:00') / 3600")).alias("horas"))
