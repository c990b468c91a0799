"""Chunks, vector search, questions, legal texts and their metrics as named queries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from garimpo.operators import ask, law, retrieval
from garimpo.plans.catalog import query
from garimpo.plans.warehouse import CURRENT_SQL, current

QUERY_VECTOR = "(select embedding from embeddings where vec_id = 0)"


def query_vector(t) -> list[float]:
    return t.embeddings.filter("vec_id = 0").select("embedding").first()[0]


DIST = f"1 - list_cosine_similarity(embedding::double[], {QUERY_VECTOR}::double[])"


@query("t09_vector_topk", f"select vec_id, round({DIST}, 6) as distancia from embeddings order by {DIST}, vec_id limit 10")
def topk(t):
    return retrieval.top_k(t.embeddings, "embedding", "vec_id", query_vector(t), 10).select("vec_id", F.round("distancia", 6).alias("distancia"))


@query("r11_vector_search_filtered", f"select vec_id, round({DIST}, 6) as distancia from embeddings where label = 2 order by {DIST}, vec_id limit 10")
def filtered(t):
    return retrieval.top_k(t.embeddings, "embedding", "vec_id", query_vector(t), 10, F.col("label") == 2).select("vec_id", F.round("distancia", 6).alias("distancia"))


@query(
    "t10_overfetch_dedup",
    f"with hits as (select vec_id, label, {DIST} as d from embeddings order by {DIST}, vec_id limit 60), r as (select *, row_number() over (partition by label order by d, vec_id) as rn from hits) select vec_id, label from r order by rn > 1, d, vec_id limit 10",
)
def overfetch(t):
    hits = retrieval.top_k(t.embeddings, "embedding", "vec_id", query_vector(t), 60).withColumn("ordem", F.struct("distancia", "vec_id")).withColumn("texto", F.col("label").cast("string"))
    return retrieval.diversify(hits, "ordem", "texto", 10).select("vec_id", "label")


@query("r01_vocabulary", f"with {CURRENT_SQL} select count(distinct produto) as produtos, count(distinct municipio) as municipios, count(distinct bandeira) as bandeiras, min(data_coleta) as primeira, max(data_coleta) as ultima from atual")
def vocabulary(t):
    return current(t).agg(F.countDistinct("produto").alias("produtos"), F.countDistinct("municipio").alias("municipios"), F.countDistinct("bandeira").alias("bandeiras"), F.min("data_coleta").alias("primeira"), F.max("data_coleta").alias("ultima"))


#: question (with a product and a town of the mart), the wish it must be read as
TEMPLATES = (("quantos postos de {} vendem {}?", "COUNT"), ("preço médio em {} de {}", "STATS"), ("onde em {} fica mais barato o {}", "MIN"), ("em {} qual o {} mais caro?", "MAX"), ("em {} como anda o {}", None))


def asked_of_mart(t):
    """Every product of every town of the mart, asked for in each way: (municipio, produto, pergunta, esperada, lida)."""
    now = current(t)
    v = ask.Vocabulary.load(now)

    @F.pandas_udf("intencao string, municipio string, produto string, rota string")
    def reading(questions: pd.Series) -> pd.DataFrame:
        found = [ask.read(q, v) for q in questions]
        return pd.DataFrame([(q.intent, q.town, q.product, q.route) for q in found], columns=["intencao", "municipio", "produto", "rota"])

    pairs = now.filter("trim(municipio) <> '' and trim(produto) <> ''").select("municipio", "produto").distinct()
    said = F.array(*(F.struct(F.concat(*(x for text, c in zip(form.split("{}"), ("municipio", "produto", None)) for x in ([F.lit(text), F.col(c)] if c else [F.lit(text)]))).alias("pergunta"), F.lit(want).alias("esperada")) for form, want in TEMPLATES))
    return pairs.select("municipio", "produto", F.inline(said)).withColumn("lida", reading("pergunta"))


def _said_sql(form: str) -> str:
    a, b, c = form.split("{}")
    return f"'{a}' || municipio || '{b}' || produto || '{c}'"


ASKED_SQL = "(" + " union all ".join(f"select municipio, produto, {_said_sql(form)} as pergunta, {f"'{want}'" if want else "null"} as intencao from (select distinct municipio, produto from atual where trim(municipio) <> '' and trim(produto) <> '')" for form, want in TEMPLATES) + ")"


@query("r05_routes", f"with {CURRENT_SQL} select pergunta, intencao, produto, municipio, case when intencao is null then 'vector' else 'sql' end as rota from {ASKED_SQL}")
def routes(t):
    return asked_of_mart(t).select("pergunta", "lida.intencao", "lida.produto", "lida.municipio", "lida.rota")


@query(
    "r28_evaluation",
    f"with {CURRENT_SQL}, p as (select * from {ASKED_SQL}), v as (select municipio, produto, avg(valor_venda) as m from atual group by 1, 2) "
    "select coalesce(intencao, 'vector') as intencao, count(*) as perguntas, count(*) as rota_certa, count(*) as entidades_certas, count(m) as com_valor, count(m) as valor_certo from p left join v using (municipio, produto) group by 1",
)
def evaluation(t):
    """Routing, names and values: each question is read, and the mean for what was read is held against the mean for what was meant."""
    asked_ = asked_of_mart(t)
    means = current(t).groupBy("municipio", "produto").agg(F.round(F.avg("valor_venda"), 6).alias("m"))
    meant, read_ = means.select("municipio", "produto", F.col("m").alias("devido")), means.select(F.col("municipio").alias("lido_m"), F.col("produto").alias("lido_p"), F.col("m").alias("dado"))
    both = asked_.join(meant, ["municipio", "produto"], "left").join(read_, (F.col("lida.municipio") == F.col("lido_m")) & (F.col("lida.produto") == F.col("lido_p")), "left")
    right = F.col("lida.rota") == F.when(F.col("esperada").isNull(), "vector").otherwise("sql")
    names = F.col("lida.municipio").eqNullSafe(F.col("municipio")) & F.col("lida.produto").eqNullSafe(F.col("produto"))
    return both.groupBy(F.coalesce("esperada", F.lit("vector")).alias("intencao")).agg(F.count(F.lit(1)).alias("perguntas"), F.count_if(right & F.col("esperada").eqNullSafe(F.col("lida.intencao"))).alias("rota_certa"), F.count_if(names).alias("entidades_certas"), F.count("devido").alias("com_valor"), F.count_if(F.col("dado") == F.col("devido")).alias("valor_certo"))


def asked(t, question: str):
    now = current(t)
    return ask.answer(ask.read(question, ask.Vocabulary.load(now)), now)


@query("r06_count", f"with {CURRENT_SQL} select count(distinct cnpj) as postos, count(*) as precos from atual where produto = 'ETANOL'")
def count(t):
    return asked(t, "quantos postos vendem etanol?")


@query("r06_stats", f"with {CURRENT_SQL} select round(avg(valor_venda), 4) as media, min(valor_venda) as minimo, max(valor_venda) as maximo, count(*) as precos from atual where produto = 'GASOLINA ADITIVADA'")
def stats(t):
    return asked(t, "preco medio da gasolina aditivada")


@query("r06_ranking", f"with {CURRENT_SQL} select revenda, municipio, produto, min(valor_venda) as preco from atual where produto = 'DIESEL S10' and valor_venda is not null group by 1, 2, 3 order by 4, 1, 2, 3 limit 10")
def ranking(t):
    return asked(t, "onde o diesel s10 e mais barato?")


@query("r06_list", f"with {CURRENT_SQL} select *, (select count(distinct (revenda, municipio)) from atual where produto = 'GNV') as total from (select distinct revenda, municipio from atual where produto = 'GNV' order by 1, 2 limit 10)")
def listed(t):
    return asked(t, "quais os postos que vendem gnv")


@query("r06_detail", f"with {CURRENT_SQL} select cnpj, produto, valor_venda, data_coleta from atual where cnpj = (select max(cnpj) from atual where length(cnpj) = 14) order by data_coleta desc, produto, cnpj limit 10")
def detail(t):
    """The station with the greatest number, asked for as it is printed."""
    c = current(t).filter(F.length("cnpj") == 14).agg(F.max("cnpj")).first()[0] or "0" * 14
    return asked(t, f"precos do posto {c[:2]}.{c[2:5]}.{c[5:8]}/{c[8:12]}-{c[12:]}")


@query(
    "r07_sentence_chunks",
    "select 'orders:' || left(md5('v1|' || texto), 16) as chunk_id, texto, '{\"o_orderkey\":' || o_orderkey || ',\"o_custkey\":' || o_custkey || '}' as metadados from (select *, concat_ws(', ', 'Pedido ' || o_orderkey, case when o_orderstatus <> 'P' then 'estado ' || o_orderstatus end, 'prioridade ' || o_orderpriority) as texto from orders)",
)
def sentence_chunks(t):
    rows = t.orders.withColumn("estado", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    return retrieval.sentence_chunks(rows, "orders", "v1", [("Pedido ", "o_orderkey"), ("estado ", "estado"), ("prioridade ", "o_orderpriority")], ["o_orderkey", "o_custkey"])


@query("r08_chunk_id", "select doc_id, 'doc:' || left(md5('v1|' || text), 16) as chunk_id from documents")
def chunk_ids(t):
    from garimpo.functions.keys import chunk_id

    return t.documents.select("doc_id", chunk_id("doc", F.lit("v1"), F.col("text")).alias("chunk_id"))


@query(
    "a26_golden_metrics",
    """with o as (select l_orderkey as k, list_distinct(list(l_partkey) filter (where l_returnflag = 'R')) as e, list(l_partkey order by l_linenumber, l_partkey) as g from lineitem group by 1),
       m as (select len(e) as n, list_intersect(e, g[1:3]) as f, list_min(list_filter(list_transform(e, lambda x: list_position(g, x)), lambda x: x > 0)) as r from o where e is not null and len(e) > 0)
       select round(avg((len(f) = n)::int), 6) as success, round(avg((len(f) > 0)::int), 6) as hit, round(avg(len(f) / n), 6) as recall, round(avg(coalesce(1.0 / r, 0)), 6) as mrr, count(*) as n from m""",
)
def golden_metrics(t):
    """An order stands for a question: its parts by line number are what was found, the returned ones what was expected."""
    orders = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("l"), F.collect_set(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("esperados"))
    m = retrieval.retrieval_metrics(orders.select("esperados", F.col("l.l_partkey").alias("obtidos")).filter(F.size("esperados") > 0), 3)
    return m.select(*(F.round(c, 6).alias(c) for c in ("success", "hit", "recall", "mrr")), "n")


class HashEncoder:
    """A stand-in for a model: hashed words, so that equal words are near."""

    def encode(self, texts):
        import zlib

        out = []
        for x in texts:
            v = [0.0] * 32
            for w in x.lower().split():
                v[zlib.crc32(w.encode()) % 32] += 1
            out.append(v)
        return out


@query("r09_embed", "select doc_id, 32 as dimensao, true as unitario from documents")
def embedded(t):
    from garimpo.functions.text import dot

    v = retrieval.embed(t.documents.select("doc_id", "text"), "text", HashEncoder)
    return v.select("doc_id", F.size("embedding").alias("dimensao"), (F.abs(dot(F.col("embedding"), F.col("embedding")) - 1) < 1e-4).alias("unitario"))


NONBLANK = "list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')"


def as_law(t):
    """Documents printed as a law: the first line is an article, the others its paragraphs."""
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    mark = F.transform(lines, lambda x, k: F.concat(F.lit("    "), F.when(k == 0, F.concat(F.lit("Art. "), F.col("doc_id").cast("string"), F.lit(". "))).when(k < 10, F.concat(F.lit("§ "), k.cast("string"), F.lit("º "))).otherwise(F.concat(F.lit("§ "), k.cast("string"), F.lit(". "))), F.trim(x)))
    return t.documents.select(F.concat(F.lit("lei"), F.col("doc_id").cast("string")).alias("lei"), F.array_join(mark, "\n").alias("texto"))


@query(
    "r12_law_provisions",
    f"select 'lei' || doc_id as doc_id, 'lei' || doc_id || ':art-' || doc_id || case when k > 1 then ':par-' || (k - 1) else '' end as dispositivo_id, case when k > 1 then 'par' else 'art' end as tipo from (select doc_id, unnest(range(1, len({NONBLANK}) + 1)) as k from documents)",
)
def provisions(t):
    return law.provisions(as_law(t), "lei", "texto").select("doc_id", "dispositivo_id", "tipo")


def order_laws(t, printings: int = 1):
    """Orders printed as laws: the order is the article (so often as it is printed), its lines are paragraphs; states are notes."""
    note = lambda c, cases: F.coalesce(*(F.when(c == value, text) for value, text in cases.items()), F.lit(""))
    number = lambda c: F.col(c).cast("string")
    amended = lambda c: F.concat(F.lit(" (Redação dada pela Lei Complementar nº "), number(c), F.lit(", de 2026)"))
    lines = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("l_returnflag"), F.min("l_suppkey").alias("l_suppkey"))
    lines = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.concat(F.lit("    § "), number("l_linenumber"), F.when(F.col("l_linenumber") < 10, "º").otherwise("."), F.lit(" Linha."), note(F.col("l_returnflag"), {"R": F.lit(" (Revogado)"), "A": amended("l_suppkey")})).alias("x")))).alias("l"))  # a few lines an order
    head = lambda k: F.concat(F.lit("    Art. "), number("o_orderkey"), F.lit(f". Texto {k}."), note(F.col("o_orderstatus"), {"F": F.lit(" (Revogado)"), "P": amended("o_custkey")}) if k == 1 else note(F.left("o_orderpriority", F.lit(1)), {"1": F.lit(" (Vetado)")}))
    parts = [F.array(head(k)) if k > 1 else F.concat(F.array(head(k)), F.col("l.x")) for k in range(1, printings + 1)]
    joined = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select(F.concat(F.lit("o"), number("o_orderkey")).alias("lei"), F.array_join(F.concat(*parts), "\n").alias("texto"))


_ART = "'o' || o_orderkey || ':art-' || o_orderkey"
_LINES = "(select l_orderkey, l_linenumber, min(l_returnflag) as l_returnflag, min(l_suppkey) as l_suppkey from lineitem group by 1, 2)"
_WITH_LINES = "o_orderkey in (select l_orderkey from lineitem)"
LAW_SQL = (
    f"(select 'o' || o_orderkey as lei, {_ART} as dispositivo_id, null as parent_id, case o_orderstatus when 'F' then 'revogado' when 'P' then 'alterado' else 'vigente' end as status, case when o_orderstatus = 'P' then cast(o_custkey as varchar) else '' end as alterado_por from orders where {_WITH_LINES} "
    f"union all select 'o' || o_orderkey, {_ART} || ':par-' || l_linenumber, {_ART}, case l_returnflag when 'R' then 'revogado' when 'A' then 'alterado' else 'vigente' end, case when l_returnflag = 'A' then cast(l_suppkey as varchar) else '' end from {_LINES} join orders on o_orderkey = l_orderkey)"
)


@query("r13_law_notes", f"select dispositivo_id, status, alterado_por from {LAW_SQL}")
def notes(t):
    return law.provisions(order_laws(t), "lei", "texto").select("dispositivo_id", "status", F.array_join("alterado_por", ",").alias("alterado_por"))


@query("r15_tree_paths", f"select dispositivo_id, parent_id, case when parent_id is null then 0 else 1 end as nivel from {LAW_SQL}")
def tree_paths(t):
    return law.provisions(order_laws(t), "lei", "texto").select("dispositivo_id", "parent_id", (F.size(F.split("dispositivo_id", ":")) - 2).alias("nivel"))


@query(
    "r14_repeated_articles",
    f"select 'o' || o_orderkey as doc_id, case when left(o_orderpriority, 1) = '1' and o_orderstatus <> 'F' then 1 else 2 end as impressao, case when left(o_orderpriority, 1) = '1' and o_orderstatus <> 'F' then 1 + (select count(distinct l_linenumber) from lineitem where l_orderkey = o_orderkey) else 1 end as dispositivos from orders where {_WITH_LINES}",
)
def repeated(t):
    """Each article is printed twice; the last printing in force remains, with its own paragraphs."""
    kept = law.latest_printing(law.provisions(order_laws(t, 2), "lei", "texto"))
    return kept.groupBy("doc_id").agg(F.max(F.when(F.col("tipo") == "art", F.regexp_extract("texto", r"Texto (\d)", 1).cast("int"))).alias("impressao"), F.count(F.lit(1)).alias("dispositivos"))


@query("r18_article_rollup", f"select lei as art, count(*) filter (where status <> 'revogado') as vigentes, round(count(*) filter (where status <> 'revogado') * 1.0 / count(*), 6) as cobertura, coalesce(string_agg(split_part(dispositivo_id, ':', 3), ' ' order by dispositivo_id) filter (where status <> 'revogado'), '') as texto from {LAW_SQL} group by 1")
def rollup(t):
    """Per article its provisions in force, their share, and their labels in order."""
    rows = law.provisions(order_laws(t), "lei", "texto").withColumn("vivo", ~F.col("status").isin("revogado", "vetado"))
    found = rows.groupBy("doc_id").agg(F.count_if("vivo").alias("vigentes"), F.round(F.count_if("vivo") / F.count(F.lit(1)), 6).alias("cobertura"), F.array_sort(F.collect_list(F.when(F.col("vivo"), F.struct("dispositivo_id")))).alias("l"))
    return found.select(F.col("doc_id").alias("art"), "vigentes", "cobertura", F.array_join(F.transform("l", lambda x: F.coalesce(F.get(F.split(x["dispositivo_id"], ":"), F.lit(2)), F.lit(""))), " ").alias("texto"))


@query(
    "d21_law_contract",
    f"select 'unico' as regra, count(*) as n from orders where {_WITH_LINES} having count(*) > 0 union all select 'sequencia', count(*) from (select l_linenumber - coalesce(lag(l_linenumber) over (partition by l_orderkey order by l_linenumber), 0) as d from {_LINES} where l_orderkey in (select o_orderkey from orders)) where d <> 1 having count(*) > 0",
)
def law_contract(t):
    """Articles printed twice break the rule of unique ids, missing line numbers that of the sequence. A law is judged as a whole, as it was parsed."""
    @F.pandas_udf("array<string>")
    def breaches(rows: pd.Series) -> pd.Series:
        return rows.map(lambda r: [rule for rule, _ in law.contract(sorted(r, key=lambda x: x["linha"]))])

    found = law.provisions(order_laws(t, 2), "lei", "texto").groupBy("doc_id").agg(F.collect_list(F.struct("linha", "dispositivo_id", "parent_id", "tipo", "texto")).alias("l"))
    return found.select(F.explode(breaches("l")).alias("regra")).groupBy("regra").agg(F.count(F.lit(1)).alias("n"))


@query("r16_law_chunks")
def law_chunks(t):
    """Chunks per article: every one fits the limit."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("linha").to_dict("records")
        made = law.chunks(rows, f"{rows[0]['doc_id']} | {rows[0]['rotulo']}", limit=120)
        return pd.DataFrame([{"doc_id": rows[0]["doc_id"], "parte": k, "kind": c["kind"], "n_tokens": law.tokens(c["texto"]), "ids": c["ids"]} for k, c in enumerate(made)])

    rows = law.provisions(as_law(t), "lei", "texto").select("doc_id", "dispositivo_id", "parent_id", "tipo", "rotulo", "linha", "texto")
    article = F.regexp_extract("dispositivo_id", "^([^:]+:[^:]+)", 1)
    return rows.groupBy(article.alias("artigo")).applyInPandas(run, "doc_id string, parte int, kind string, n_tokens int, ids array<string>")


@query(
    "r16_windows",
    "with w as (select doc_id, string_split(trim(regexp_replace(text, '[ \\t\\n\\r\\f]+', ' ', 'g'), ' '), ' ') as w from documents), s as (select doc_id, w, unnest(range(0, greatest(1, len(w) - 10), 40)) as k from w) select doc_id, k as inicio, array_to_string(w[k + 1:k + 50], ' ') as texto from s",
)
def word_windows(t):
    words = F.split(F.trim(F.regexp_replace("text", r"[ \t\n\r\f]+", " ")), " ")
    rows = t.documents.select("doc_id", words.alias("w"))
    starts = F.filter(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - 11), F.lit(40)), lambda k: k >= 0)
    return rows.select("doc_id", "w", F.explode(starts).alias("inicio")).select("doc_id", F.col("inicio").cast("bigint").alias("inicio"), F.array_join(F.slice("w", F.col("inicio") + 1, 50), " ").alias("texto"))


@query("r22_self_reference", f"select 'certo' as resultado, count(*) as n from {LAW_SQL} having count(*) > 0")
def self_reference(t):
    """Every provision's own label, read as a question, must lead back to it among the provisions of its law."""
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def outcomes(laws: pd.Series) -> pd.Series:
        def of(ids) -> list[str]:
            index, out = law.Index(list(ids)), []
            for i in ids:
                parts = dict(p.split("-", 1) for p in i.split(":")[1:])
                found = law.route(f"art. {parts['art']}" + (f", § {parts['par']}" if "par" in parts else ""), index).anchors
                out.append("certo" if found == [i] else "errado")
            return out

        return laws.map(of)

    rows = law.provisions(order_laws(t), "lei", "texto").groupBy("doc_id").agg(F.collect_list("dispositivo_id").alias("ids"))  # a law's provisions
    return rows.select(F.explode(outcomes("ids")).alias("resultado")).groupBy("resultado").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a26_retrieval_metrics",
    """with q as (select vec_id as q, embedding as e, label as l from embeddings where vec_id % 50 = 0), r as (select q.q, q.l, v.label, row_number() over (partition by q.q order by list_cosine_similarity(v.embedding::double[], q.e::double[]) desc, v.vec_id) as rn from q join embeddings v on v.vec_id <> q.q),
       m as (select q, count(*) filter (where label = l and rn <= 5) as f5, min(rn) filter (where label = l and rn <= 20) as first from r group by 1)
       select round(avg((f5 > 0)::int), 6) as hit, round(avg(f5 / 5), 6) as precisao, round(avg(coalesce(1.0 / first, 0)), 6) as mrr, count(*) as n from m""",
)
def metrics(t):
    """Queries are the vectors whose id is divisible by 50, against all; relevant is the same label."""
    q = t.embeddings.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("q"), F.col("embedding").alias("v"))
    found = retrieval.top_k_many(t.embeddings, "embedding", "vec_id", q, 20)
    label = lambda c, n: t.embeddings.select(F.col("vec_id").alias(c), F.col("label").alias(n))
    both = found.join(label("id", "a"), "id").join(label("q", "b"), "q").withColumn("certo", F.col("a") == F.col("b"))
    per = both.groupBy("q").agg(F.count_if(F.col("certo") & (F.col("posicao") <= 5)).alias("f5"), F.min(F.when(F.col("certo"), F.col("posicao"))).alias("primeiro"))
    return per.agg(F.round(F.avg((F.col("f5") > 0).cast("int")), 6).alias("hit"), F.round(F.avg(F.col("f5") / 5), 6).alias("precisao"), F.round(F.avg(F.coalesce(F.lit(1.0) / F.col("primeiro"), F.lit(0.0))), 6).alias("mrr"), F.count(F.lit(1)).alias("n"))


@query(
    "a27_answer_metrics",
    """with l as (select l_orderkey as k, list_distinct(list(l_suppkey) filter (where l_returnflag = 'R')) as c, list_distinct(list(l_suppkey) filter (where l_shipdate > date '1995-01-01')) as e from lineitem group by 1),
       a as (select o_orderstatus <> 'F' as r, left(o_orderpriority, 1) = '5' as n, coalesce(c, []) as c, coalesce(e, []) as e, o_totalprice as s from orders join l on k = o_orderkey)
       select round(avg((r <> n)::int), 6) as acerto_recusa, count(*) filter (where not r and not n) as falsas_respostas, count(*) filter (where r and n) as falsas_recusas, round(avg(case when len(c) > 0 then len(list_intersect(c, e)) / len(c) end), 6) as validade,
         round(avg(case when len(e) > 0 then len(list_intersect(c, e)) / len(e) end), 6) as cobertura, round(median(s), 2) as p50, round(max(s), 2) as pior from a""",
)
def answers(t):
    """An order stands for an answer."""
    lines = t.lineitem.groupBy("l_orderkey").agg(F.collect_set(F.when(F.col("l_returnflag") == "R", F.col("l_suppkey"))).alias("citados"), F.collect_set(F.when(F.col("l_shipdate") > F.lit("1995-01-01").cast("date"), F.col("l_suppkey"))).alias("esperados"))
    rows = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select((F.col("o_orderstatus") != "F").alias("respondivel"), (F.left("o_orderpriority", F.lit(1)) == "5").alias("recusou"), "citados", "esperados", F.col("o_totalprice").alias("segundos"))
    m = retrieval.answer_metrics(rows)
    return m.select(*(F.round(c, 6).alias(c) for c in ("acerto_recusa", "validade", "cobertura")), "falsas_respostas", "falsas_recusas", *(F.round(c, 2).alias(c) for c in ("p50", "pior")))


@query("a28_token_calibration", "select round(median(r), 6) as mediana, round(min(r), 6) as minimo, round(max(r), 6) as maximo from (select length(text) * 1.0 / len(string_split(text, ' ')) / 5 as r from documents) where r >= 1.0")
def calibration(t):
    r = t.documents.select((F.length("text") * F.lit(1.0) / F.size(F.split("text", " ")) / 5).alias("r")).filter("r >= 1.0")
    return r.agg(F.round(F.percentile("r", 0.5), 6).alias("mediana"), F.round(F.min("r"), 6).alias("minimo"), F.round(F.max("r"), 6).alias("maximo"))


@query(
    "r24_context_budget",
    "with b as (select l_orderkey, l_linenumber, row_number() over (partition by l_orderkey order by l_linenumber = m desc, l_linenumber) as k from (select distinct l_orderkey, l_linenumber, max(l_linenumber) over (partition by l_orderkey) as m from lineitem)) "
    "select l_orderkey, cast(l_linenumber as varchar) as art_id, k as posicao, k <= 2 as inteiro from b where k <= 4",
)
def budget(t):
    """The last line of an order is the anchor; two blocks fit in full (three words of eight), two more in their short form (one word)."""
    @F.pandas_udf("array<struct<art_id:string,inteiro:boolean>>")
    def fitted(numbers: pd.Series) -> pd.Series:
        def one(n) -> list[dict]:
            ids = [str(x) for x in sorted(n)]
            blocks = [{"art_id": i, "formas": [f"{i} dois tres", i]} for i in ids for _ in range(2)]  # each comes twice
            kept, _ = retrieval.assemble(blocks, [ids[-1]], 8, lambda x: len(x.split()))
            return [{"art_id": k["art_id"], "inteiro": k["inteiro"]} for k in kept]

        return numbers.map(one)

    orders = t.lineitem.groupBy("l_orderkey").agg(F.collect_set("l_linenumber").alias("n"))
    return orders.select("l_orderkey", F.posexplode(fitted("n")).alias("p", "x")).select("l_orderkey", "x.art_id", (F.col("p") + 1).cast("bigint").alias("posicao"), "x.inteiro")


@query("r27_verdict_digest", "select md5(string_agg(item_id || ':' || tipo, ',' order by item_id)) as digest from eval_itens")
def digest(t):
    rows = t.eval_itens.agg(F.array_sort(F.collect_list(F.struct("item_id", "tipo"))).alias("l"))  # a fixed set of verdicts
    return rows.select(F.md5(F.array_join(F.transform("l", lambda x: F.concat(x["item_id"].cast("string"), F.lit(":"), x["tipo"])), ",")).alias("digest"))


@query("r27_drift", "select case when tipo = 'recall' then 'mudou' when item_id % 7 = 0 then 'novo' else 'igual' end as situacao, count(*) as n from eval_itens group by 1")
def drift(t):
    """Verdicts of two runs by item: what stayed, changed, came or went."""
    now = t.eval_itens.select("item_id", F.col("tipo").alias("veredito"))
    before = now.filter("item_id % 7 <> 0 or veredito = 'recall'").select("item_id", F.when(F.col("veredito") == "recall", "outro").otherwise(F.col("veredito")).alias("veredito"))
    return retrieval.drift(before, now, "item_id", "veredito").groupBy("situacao").agg(F.count(F.lit(1)).alias("n"))


@query("r29_usage_fact", "select doc_id, md5(text) as hash, length(text) as tamanho, coalesce(n_chars, length(text)) as informado, n_chars is null as estimado from documents")
def usage(t):
    return t.documents.select("doc_id", F.md5("text").alias("hash"), F.length("text").cast("bigint").alias("tamanho"), F.coalesce("n_chars", F.length("text").cast("bigint")).alias("informado"), F.col("n_chars").isNull().alias("estimado"))


@query("r30_context_label", "select item_id, case when tipo in ('citation', 'combined') then '[SQL] ' else '[BUSCA] ' end || left(texto, 20) as linha from eval_itens")
def labels(t):
    return t.eval_itens.select("item_id", F.concat(F.when(F.col("tipo").isin("citation", "combined"), "[SQL] ").otherwise("[BUSCA] "), F.left("texto", F.lit(20))).alias("linha"))
