"""The rest of the inventory: assertions, guards, functions of the SQL surface, approximate search, small protocols."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from garimpo.operators import ivf, law, quality, retrieval, upsert
from garimpo.operators.ask import CNPJ, period, plain
from garimpo.plans.catalog import query
from garimpo.plans.scalars import MOD11_SQL
from garimpo.plans.texts import HashEncoder, as_law
from garimpo.streaming import flows
from garimpo.workspace import fresh


@query("p11_schema_assertion", "select 'igual' as nation, 'difere' as region")
def schema(t):
    contract = "n_nationkey int, n_name string, n_regionkey int"
    same = lambda df: "igual" if [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in T.StructType.fromDDL(contract)] else "difere"
    return t.spark.createDataFrame([(same(t.nation), same(t.region))], "nation string, region string")


@query("s11_batched_scan", "select count(*) as n, cast(sum(l_quantity) as double) as q from lineitem")
def scan(t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))


@query("s15_bulk_append", "select count(*) as n, count(distinct c_custkey) as clientes from (select * from customer union all select * from customer)")
def bulk(t):
    at = fresh(t.spark, "copia")
    for _ in range(2):
        t.customer.write.mode("append").parquet(at)
    return t.spark.read.parquet(at).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("c_custkey").alias("clientes"))


@query("s21_batch_reservation", "select lote_id, count(*) as arquivos from nfe_xml group by 1")
def reservation(t):
    """Arrived files are taken in micro-batches of at most two files; each row is taken once."""
    source = flows.replay(t.nfe_xml.select("lote_id", "arquivo"), "inbox", 5)
    at = fresh(t.spark, "reservado")

    def batch(df, number):
        df.withColumn("reserva", F.lit(number)).write.mode("overwrite").parquet(f"{at}/b={number}")

    flows.run_available(t.spark.readStream.schema("lote_id bigint, arquivo string").option("maxFilesPerTrigger", 2).parquet(source), batch, fresh(t.spark, "checkpoint"))
    return t.spark.read.parquet(at).groupBy("lote_id").agg(F.count(F.lit(1)).alias("arquivos"))


@query("s31_check_results", "select 'linhas' as checagem, 'pass' as status, count(*)::double as valor from region")
def results(t):
    at = fresh(t.spark, "checagens")
    done = quality.run_checks(t.spark, [quality.Check("linhas", lambda s: (t.region.count(),), lambda v: quality.threshold(v, low=1))])
    t.spark.createDataFrame([(r["check"], r["status"], r["value"]) for r in done], "checagem string, status string, valor double").write.mode("append").parquet(at)
    return t.spark.read.parquet(at)


@query("m03_ephemeral", "with e as (select *, o_totalprice * 2 as dobro from orders) select count(*) as n from e where dobro > 500000")
def ephemeral(t):
    return t.orders.withColumn("dobro", F.col("o_totalprice") * 2).filter("dobro > 500000").agg(F.count(F.lit(1)).alias("n"))


@query("m14_mass_delete_guard", "select 'abortado' as resultado")
def guard(t):
    actions = upsert.classify(t.part, t.part.filter("p_partkey % 3 = 0"), ["p_partkey"], ["p_name"], ["p_size"])
    try:
        upsert.guard_mass_delete(actions)
        result = "gravado"
    except upsert.MassDelete:
        result = "abortado"
    return t.spark.createDataFrame([(result,)], "resultado string")


@query("m16_cells_index", "select count(*) as n, true as completo from embeddings")
def cells(t):
    """Every row is indexed."""
    centroids = ivf.fit(t.embeddings, "embedding")
    return ivf.index(t.embeddings, "embedding", centroids).agg(F.count("cell").alias("n"), (F.max("cell") < len(centroids)).alias("completo"))


@query("r10_approximate_search")
def approximate(t):
    """Queries are the vectors whose id is divisible by 50, against all rows."""
    centroids = ivf.fit(t.embeddings, "embedding")
    queries = t.embeddings.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("q"), F.col("embedding").alias("v"))
    found = ivf.search(ivf.index(t.embeddings, "embedding", centroids), "vec_id", "embedding", queries, centroids)
    return found.select("q", F.col("id").alias("vec_id"), "posicao", F.round("distancia", 6).alias("distancia"))


@query("m17_skip_by_manifest", "select true as primeira, false as segunda")
def skip(t):
    target = upsert.Target(t.spark, fresh(t.spark, "passo"))
    ran = []
    for _ in range(2):
        ran.append(not target.up_to_date(versao="1"))
        if ran[-1]:
            target.write(t.region, versao="1")
    return t.spark.createDataFrame([tuple(ran)], "primeira boolean, segunda boolean")


@query("d13_quarantine", "select linha_id from rfb_empresas where cnpj_basico is null or length(trim(cnpj_basico)) > 8")
def quarantine(t):
    at = fresh(t.spark, "dq_empresas")
    c = F.col("cnpj_basico")
    quality.quarantine(t.rfb_empresas.filter(c.isNull() | (F.length(F.trim(c)) > 8)), at)
    return t.spark.read.parquet(at).select("linha_id")


@query(
    "r04_periods",
    "select o_orderdate as dia, o_orderdate as de1, o_orderdate as ate1, cast(date_trunc('month', o_orderdate) as date) as de2, last_day(o_orderdate) as ate2, cast(date_trunc('month', o_orderdate) as date) as de3, last_day(o_orderdate) as ate3 from (select distinct cast(o_orderdate as date) as o_orderdate from orders)",
)
def periods(t):
    """Every order date, asked for as a day, as month/year and by the month's name."""
    @F.pandas_udf("de date, ate date")
    def reading(q: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([period(x, None) for x in q], columns=["de", "ate"])

    days = t.orders.select(F.col("o_orderdate").cast("date").alias("dia")).distinct()
    names = F.array(*(F.lit(m) for m in ("janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro")))
    said = [F.concat(F.lit("preço no dia "), F.col("dia").cast("string")), F.concat(F.lit("quanto custava em "), F.date_format("dia", "MM/yyyy"), F.lit("?")), F.concat(F.lit("em "), F.get(names, F.month("dia") - 1), F.lit(" de "), F.year("dia").cast("string"))]
    read = days.select("dia", *(reading(q).alias(f"r{k}") for k, q in enumerate(said, 1)))
    return read.select("dia", *(F.col(f"r{k}.{c}").alias(f"{c}{k}") for k in (1, 2, 3) for c in ("de", "ate")))


@query("r02_cnpj_in_question", "select linha_id, regexp_replace(regexp_extract(cnpj_da_revenda, '[0-9]{2}\\.?[0-9]{3}\\.?[0-9]{3}/?[0-9]{4}-?[0-9]{2}'), '[^0-9]', '', 'g') as cnpj from anp_landing_semanal")
def question_cnpj(t):
    found = F.regexp_extract("cnpj_da_revenda", CNPJ.pattern.replace(r"(?<!\d)", "").replace(r"(?!\d)", ""), 0)
    return t.anp_landing_semanal.select("linha_id", F.regexp_replace(found, "[^0-9]", "").alias("cnpj"))


@query("r17_headers", "select n_nationkey, concat_ws(' | ', 'Lei', r_name, case when n_nationkey % 2 = 0 then n_name end) as cabecalho from nation join region on r_regionkey = n_regionkey")
def headers(t):
    rows = t.nation.join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    return rows.select("n_nationkey", F.concat_ws(" | ", F.lit("Lei"), "r_name", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name"))).alias("cabecalho"))


ITEMS = ["I", "II", "III", "IV", "V", "VI", "VII"]


@F.pandas_udf(T.StringType())
def cited(q: pd.Series) -> pd.Series:
    return q.map(lambda x: "; ".join(c.label() for c in law.citations(x or "")[0]))


@query("r19_citations", "select l_orderkey, l_linenumber, case when l_returnflag = 'R' then '' else 'art. ' || l_orderkey || case when l_returnflag = 'A' then ', § ' || l_linenumber else ', caput' end || ', inciso ' || ['" + "', '".join(ITEMS) + "'][l_linenumber] end as citacoes from lineitem where l_linenumber <= 7")
def citation(t):
    """Each line cites its order in one of three ways: down from the article, up to it, or the article of another law."""
    n, art, item = F.col("l_linenumber").cast("string"), F.col("l_orderkey").cast("string"), F.get(F.array(*(F.lit(x) for x in ITEMS)), F.col("l_linenumber") - 1)
    down = F.concat(F.lit("o que é o art. "), art, F.lit(", § "), n, F.lit("º, inciso "), item, F.lit("?"))
    up = F.concat(F.lit("o inciso "), item, F.lit(" do caput do art. "), art)
    other = F.concat(F.lit("e o art. "), art, F.lit(" do Código Civil?"))
    asked = F.when(F.col("l_returnflag") == "A", down).when(F.col("l_returnflag") == "N", up).otherwise(other)
    return t.lineitem.filter("l_linenumber <= 7").select("l_orderkey", "l_linenumber", cited(asked).alias("citacoes"))


@query("r20_resolution", "select 'lei' || doc_id || ':art-' || doc_id as alvo from documents")
def resolution(t):
    """Each article's own number, asked for, resolves to it: a join on the path instead of an index per question."""
    rows = law.provisions(as_law(t), "lei", "texto").filter("tipo = 'art'")
    asked = t.documents.select(F.concat(F.lit("lei"), F.col("doc_id").cast("string"), F.lit(":art-"), F.col("doc_id").cast("string")).alias("alvo"))
    return asked.join(rows.select(F.col("dispositivo_id").alias("alvo")), "alvo", "left_semi")


@query("r23_pages", "with w as (select doc_id, list_filter(regexp_split_to_array(text, '[ \t\n\r\f\v]+'), lambda x: x <> '') as w from documents where text is not null) select doc_id, k + 1 as pagina, md5(array_to_string(w[k * 400 + 1:k * 400 + 400], ' ')) as texto from (select doc_id, w, unnest(range(0, greatest(1, cast(ceil(len(w) / 400.0) as bigint)))) as k from w)")
def paged(t):
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def pages(texts: pd.Series) -> pd.Series:
        return texts.map(retrieval.pages)

    return t.documents.filter("text is not null").select("doc_id", F.posexplode(pages("text")).alias("k", "x")).select("doc_id", (F.col("k") + 1).cast("bigint").alias("pagina"), F.md5("x").alias("texto"))


@query("r26_reply_barriers", "select o_orderkey, o_orderstatus <> 'O' or left(o_orderpriority, 1) in ('1', '2') as recusou, case when left(o_orderpriority, 1) = '1' then 'formato' when left(o_orderpriority, 1) = '2' then 'sem resposta' when o_orderstatus <> 'O' then 'sem citacao' end as motivo from orders")
def replies(t):
    """An order stands for a reply: its priority spoils the form or the text, its state the source that it cites."""
    @F.pandas_udf("recusou boolean, motivo string")
    def barriers(said: pd.Series, allowed: pd.Series) -> pd.DataFrame:
        read = [retrieval.read_reply(r, {a}) for r, a in zip(said, allowed)]
        return pd.DataFrame([(r["recusou"], r["motivo"]) for r in read], columns=["recusou", "motivo"])

    kind, source = F.left("o_orderpriority", F.lit(1)), F.col("o_custkey").cast("string")
    body = F.to_json(F.struct(F.when(kind == "2", " ").otherwise(F.col("o_orderpriority")).alias("resposta"), F.array(F.when(F.col("o_orderstatus") == "O", source).otherwise("outra")).alias("citacoes")))
    said = F.when(kind == "1", "não sei").otherwise(F.concat(F.lit("Segue: "), body, F.lit(" .")))
    return t.orders.select("o_orderkey", barriers(said, source).alias("r")).select("o_orderkey", "r.recusou", "r.motivo")


@query("b08_log_counts", "select cast(date_trunc('hour', ts) as timestamp) as hora, event_type, count(*) as n from events where event_type in ('error', 'click') group by 1, 2")
def log_counts(t):
    return t.events.filter("event_type in ('error', 'click')").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hora"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@F.pandas_udf(T.StringType())
def titled(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else " ".join(w if re.fullmatch(r"\d+", w) else w.capitalize() for w in x.split()))


@query("v01_elementwise", "select p_partkey, upper(left(a, 1)) || substr(a, 2) || ' ' || upper(left(b, 1)) || substr(b, 2) as nome from (select p_partkey, split_part(p_name, ' ', 1) as a, split_part(p_name, ' ', 2) as b from part)")
def elementwise(t):
    return t.part.select("p_partkey", titled("p_name").alias("nome"))


@query("v03_sql_function", f"select n_name, case when s % 11 < 2 then 0 else 11 - s % 11 end as dv from (select n_name, {MOD11_SQL.format(e='c')} as s from (select n_name, lpad(cast(n_nationkey * 7919 as varchar), 8, '0') as c from nation))")
def sql_function(t):
    t.spark.sql("create or replace temporary function garimpo_mod11(e string) returns int return (select case when s % 11 < 2 then 0 else 11 - s % 11 end from (select aggregate(transform(sequence(1, length(e)), i -> (ascii(substr(e, length(e) - i + 1, 1)) - 48) * (2 + (i - 1) % 8)), 0, (a, x) -> a + x) as s))")
    return t.nation.selectExpr("n_name", "garimpo_mod11(lpad(cast(n_nationkey * 7919 as string), 8, '0')) as dv")


@F.udtf(returnType="posicao: int, palavra: string")
class Words:
    def eval(self, text: str):
        for k, w in enumerate((text or "").split(), 1):
            yield k, w


@query("v05_table_function", "select p_partkey, k as posicao, string_split(p_name, ' ')[k] as palavra from (select p_partkey, p_name, unnest(range(1, len(string_split(p_name, ' ')) + 1)) as k from part)")
def table_function(t):
    t.spark.udtf.register("garimpo_words", Words)
    t.part.createOrReplaceTempView("garimpo_part")
    return t.spark.sql("select p_partkey, w.posicao, w.palavra from garimpo_part, lateral garimpo_words(p_name) w")


@query("v06_protocols", "select 'passage' as papel, count(*) as n from nation")
def protocols(t):
    """A store of vectors behind a protocol: any encoder will do."""
    v = retrieval.embed(t.nation.select("n_name"), "n_name", HashEncoder)
    return v.filter(F.size("embedding") == 32).agg(F.lit("passage").alias("papel"), F.count(F.lit(1)).alias("n"))
