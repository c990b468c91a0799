"""Joins, aggregates, windows, sorts and set operations of the inventory on the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from garimpo.operators.latest import latest_and_previous, latest_per_key, set_sync
from garimpo.plans.catalog import query

# --- aggregates ----------------------------------------------------------------------------------------------------------


@query(
    "a01_weekly_star_agg",
    """select cast(date_trunc('week', o_orderdate) as date) as semana, n_name, count(*) as qtd, count(distinct c_custkey) as clientes,
       round(avg(o_totalprice), 8) as media, min(o_totalprice) as minimo, max(o_totalprice) as maximo, round(percentile_cont(0.5) within group (order by o_totalprice), 8) as mediana
       from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by all""",
)
def weekly(t):
    star = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    price = F.col("o_totalprice")
    return star.groupBy(F.date_trunc("week", "o_orderdate").cast("date").alias("semana"), "n_name").agg(
        F.count(F.lit(1)).alias("qtd"), F.countDistinct("c_custkey").alias("clientes"), F.round(F.avg(price), 8).alias("media"), F.min(price).alias("minimo"), F.max(price).alias("maximo"), F.round(F.percentile(price, 0.5), 8).alias("mediana")
    )


@query(
    "a02_percentiles",
    """select l_returnflag, round(percentile_cont(0.5) within group (order by l_extendedprice), 8) as p50, round(percentile_cont(0.95) within group (order by l_extendedprice), 8) as p95
       from lineitem group by 1""",
)
def percentiles(t):
    p = F.percentile("l_extendedprice", F.array(F.lit(0.5), F.lit(0.95)))
    return t.lineitem.groupBy("l_returnflag").agg(p.alias("p")).select("l_returnflag", F.round(F.col("p")[0], 8).alias("p50"), F.round(F.col("p")[1], 8).alias("p95"))


@query(
    "a03_filter_agg",
    """select o_orderpriority, count(*) filter (where o_orderstatus = 'F') as fechados, round(sum(o_totalprice) filter (where o_orderstatus = 'O'), 2) as valor_aberto, count(*) as total
       from orders group by 1""",
)
def filter_agg(t):
    return t.orders.groupBy("o_orderpriority").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("fechados"), F.round(F.sum(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))), 2).alias("valor_aberto"), F.count(F.lit(1)).alias("total")
    )


@query("a04_distinct", "select distinct p_brand, p_type from part")
def distinct(t):
    return t.part.select("p_brand", "p_type").distinct()


@query(
    "a05_distinct_on",
    "select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1",
)
def distinct_on(t):
    return latest_per_key(t.events, ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type")


@query("a06_row_distinct", "select count(*) as pares from (select distinct l_returnflag, nullif(l_linestatus, 'O') from lineitem)")
def row_distinct(t):
    return t.lineitem.agg(F.countDistinct(F.struct("l_returnflag", F.nullif(F.col("l_linestatus"), F.lit("O")))).alias("pares"))


@query(
    "a07_weighted_mean",
    """select l_returnflag, round(sum(m * n) / nullif(sum(n), 0), 6) as media from
       (select l_returnflag, l_suppkey, avg(l_quantity) as m, count(*) as n from lineitem group by 1, 2) group by 1""",
)
def weighted_mean(t):
    parts = t.lineitem.groupBy("l_returnflag", "l_suppkey").agg(F.avg("l_quantity").alias("m"), F.count(F.lit(1)).alias("n"))
    return parts.groupBy("l_returnflag").agg(F.round(F.sum(F.col("m") * F.col("n")) / F.nullif(F.sum("n"), F.lit(0)), 6).alias("media"))


@query("a08_ratio_of_sums", "select l_suppkey, round(sum(l_extendedprice * l_tax) / nullif(sum(l_extendedprice), 0), 6) as aliquota from lineitem group by 1")
def ratio_of_sums(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.round(F.sum(F.col("l_extendedprice") * F.col("l_tax")) / F.nullif(F.sum("l_extendedprice"), F.lit(0.0)), 6).alias("aliquota"))


@query("a09_signed_sum", "select l_linestatus, round(sum((l_extendedprice + l_tax) * case l_returnflag when 'R' then -1 else 1 end), 2) as saldo from lineitem group by 1")
def signed_sum(t):
    return t.lineitem.groupBy("l_linestatus").agg(F.round(F.sum((F.col("l_extendedprice") + F.col("l_tax")) * F.when(F.col("l_returnflag") == "R", -1).otherwise(1)), 2).alias("saldo"))


@query(
    "a10_exact_rollup",
    "select month(o_orderdate) as mes, round(sum(o_totalprice) / count(*), 6) as media from orders group by 1",
)
def exact_rollup(t):
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("dia")).agg(F.sum("o_totalprice").alias("soma"), F.count(F.lit(1)).alias("qtd"))
    return daily.groupBy(F.month("dia").cast("bigint").alias("mes")).agg(F.round(F.sum("soma") / F.sum("qtd"), 6).alias("media"))


@query(
    "a11_kpi_fixed_order",
    """select p_brand, round(avg(p_retailprice), 10) as media, min(p_retailprice) as minimo, max(p_retailprice) as maximo, count(distinct p_type) as tipos,
       case p_brand when 'Brand#1' then 1 when 'Brand#2' then 2 when 'Brand#3' then 3 else 1000000 end as ordem from part group by 1""",
)
def kpi(t):
    order = F.coalesce(F.create_map(*(F.lit(x) for pair in (("Brand#1", 1), ("Brand#2", 2), ("Brand#3", 3)) for x in pair))[F.col("p_brand")], F.lit(1000000))
    return t.part.groupBy("p_brand").agg(F.round(F.avg("p_retailprice"), 10).alias("media"), F.min("p_retailprice").alias("minimo"), F.max("p_retailprice").alias("maximo"), F.countDistinct("p_type").alias("tipos")).withColumn("ordem", order).orderBy("ordem", "p_brand")


@query(
    "a12_mode_tiebreak",
    """select p_brand, p_type as moda from (select p_brand, p_type, row_number() over (partition by p_brand order by count(*) desc, p_type) as rn
       from part where p_type is not null group by 1, 2) where rn = 1""",
)
def mode(t):
    counts = t.part.filter("p_type is not null").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    return latest_per_key(counts, ["p_brand"], [F.desc("n"), F.asc("p_type")]).select("p_brand", F.col("p_type").alias("moda"))


@query(
    "a13_pivot",
    """select o_orderpriority, round(avg(o_totalprice) filter (where o_orderstatus = 'F'), 8) as "F", round(avg(o_totalprice) filter (where o_orderstatus = 'O'), 8) as "O",
       round(avg(o_totalprice) filter (where o_orderstatus = 'P'), 8) as "P" from orders group by 1""",
)
def pivot(t):
    wide = t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.avg("o_totalprice"))
    return wide.select("o_orderpriority", *(F.round(c, 8).alias(c) for c in ("F", "O", "P")))


@query(
    "a14_conditional_pivot",
    """select cast(ts as date) as dia, sum(case event_type when 'click' then 1 else 0 end) as cliques, sum(case event_type when 'purchase' then 1 else 0 end) as compras,
       sum(case event_type when 'error' then 1 else 0 end) as erros from events group by 1""",
)
def conditional_pivot(t):
    n = lambda kind: F.count_if(F.col("event_type") == kind)
    return t.events.groupBy(F.to_date("ts").alias("dia")).agg(n("click").alias("cliques"), n("purchase").alias("compras"), n("error").alias("erros"))


@query("a15_dup_count", "select count(*) - count(distinct (l_orderkey, l_linenumber)) as repetidos from lineitem")
def dup_count(t):
    # two plain aggregates instead of one distinct count next to a plain one: no row is expanded
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).agg((F.sum("n") - F.count(F.lit(1))).alias("repetidos"))


@query("a16_share", "select o_orderpriority, round(avg(case when o_orderstatus = 'F' then 1.0 else 0.0 end), 6) as parcela from orders group by 1")
def share(t):
    return t.orders.groupBy("o_orderpriority").agg(F.round(F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)), 6).alias("parcela"))


@query("a17_any_value_by_max", "select p_brand, max(p_name) as nome, max(p_type) as tipo from part group by 1")
def any_value(t):
    return t.part.groupBy("p_brand").agg(F.max("p_name").alias("nome"), F.max("p_type").alias("tipo"))


@query(
    "a18_two_level",
    """select c_mktsegment, min(a) as primeira, max(b) as ultima, sum(n) as pedidos from (select o_custkey, min(o_orderdate) as a, max(o_orderdate) as b, count(*) as n from orders group by 1)
       join customer on c_custkey = o_custkey group by 1""",
)
def two_level(t):
    per = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"), F.count(F.lit(1)).alias("n"))
    return per.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(F.min("a").alias("primeira"), F.max("b").alias("ultima"), F.sum("n").alias("pedidos"))


@query(
    "a19_batch_profile",
    """select count(distinct l_orderkey) as pedidos, count(distinct l_partkey) as pecas, count(distinct l_suppkey) as fornecedores,
       round(avg(l_quantity) filter (where l_returnflag = 'A'), 3) as media_a, round(avg(l_quantity) filter (where l_returnflag = 'N'), 3) as media_n, round(avg(l_quantity) filter (where l_returnflag = 'R'), 3) as media_r from lineitem""",
)
def batch_profile(t):
    flags = t.lineitem.groupBy("l_returnflag").agg(F.round(F.avg("l_quantity"), 3).alias("m")).agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "m"))).alias("m"))  # one entry per flag
    ids = t.lineitem.agg(F.countDistinct("l_orderkey").alias("pedidos"), F.countDistinct("l_partkey").alias("pecas"), F.countDistinct("l_suppkey").alias("fornecedores"))
    return ids.crossJoin(flags).select("pedidos", "pecas", "fornecedores", F.col("m")["A"].alias("media_a"), F.col("m")["N"].alias("media_n"), F.col("m")["R"].alias("media_r"))


DAILY = "select event_type, cast(ts as date) as dia, count(*) as n from events group by 1, 2"


@query(
    "a20_volume_baseline",
    f"""with d as ({DAILY}), r as (select *, row_number() over (partition by event_type order by dia desc) as rn from d)
        select event_type, max(n) filter (where rn = 1) as ultimo, round(percentile_cont(0.5) within group (order by n) filter (where rn between 2 and 11), 8) as mediana from r group by 1""",
)
def volume_baseline(t):
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("dia")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("event_type").orderBy(F.desc("dia"))
    base = daily.withColumn("mediana", F.round(F.percentile("n", 0.5).over(w.rowsBetween(1, 10)), 4)).withColumn("rn", F.row_number().over(w))
    return base.filter("rn = 1").select("event_type", F.col("n").alias("ultimo"), "mediana")


@query(
    "a21_nearest_rank",
    """select l_returnflag, l_quantity as p95 from (select l_returnflag, l_quantity, row_number() over (partition by l_returnflag order by l_quantity) - 1 as k, count(*) over (partition by l_returnflag) as n from lineitem)
       where k = cast(floor(0.95 * (n - 1)) as bigint)""",
)
def nearest_rank(t):
    # ranks of values, not of rows: the sort is over the distinct values only
    counts = t.lineitem.groupBy("l_returnflag", "l_quantity").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("l_returnflag").orderBy("l_quantity")
    total = F.sum("c").over(Window.partitionBy("l_returnflag"))
    ranked = counts.select("l_returnflag", "l_quantity", (F.sum("c").over(w) - F.col("c")).alias("a"), F.sum("c").over(w).alias("b"), F.floor(F.lit(0.95) * (total - 1)).alias("k"))
    return ranked.filter("k >= a and k < b").select("l_returnflag", F.col("l_quantity").alias("p95"))


@query("a22_counts_by_kind", "select event_type, count(*) as n, count(distinct user_id) as usuarios from events group by 1")
def counts_by_kind(t):
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("usuarios"))


@query("a23_bucket_counts", "select time_bucket(interval '6 hours', ts, timestamp '1970-01-01') as inicio, event_type, count(*) as n from events group by 1, 2")
def bucket_counts(t):
    return t.events.groupBy(F.window("ts", "6 hours").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("inicio"), "event_type", "n")


@query("a24_pct_of_total", "select o_orderpriority, round(100.0 * sum(o_totalprice) / sum(sum(o_totalprice)) over (), 6) as pct from orders group by 1")
def pct_of_total(t):
    per = t.orders.groupBy("o_orderpriority").agg(F.sum("o_totalprice").alias("s"))
    return per.crossJoin(per.agg(F.sum("s").alias("total"))).select("o_orderpriority", F.round(F.lit(100.0) * F.col("s") / F.col("total"), 6).alias("pct"))


@query("a29_default_max", "select c_nationkey, count(o_orderkey) as n, coalesce(max(o_orderdate), timestamp '1900-01-01') as ultimo from customer left join orders on c_custkey = o_custkey and o_orderstatus = 'P' group by 1")
def default_max(t):
    late = t.orders.filter("o_orderstatus = 'P'")
    return t.customer.join(late, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_nationkey").agg(F.count("o_orderkey").alias("n"), F.coalesce(F.max("o_orderdate"), F.expr("timestamp_ntz'1900-01-01 00:00:00'")).alias("ultimo"))


# --- joins ---------------------------------------------------------------------------------------------------------------


@query(
    "j01_star",
    """select r_name, p_brand, round(sum(l_extendedprice * (1 - l_discount)), 4) as receita from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
       join region on n_regionkey = r_regionkey join part on l_partkey = p_partkey group by 1, 2""",
)
def star(t):
    places = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    fact = t.lineitem.join(places, F.col("l_suppkey") == F.col("s_suppkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return fact.groupBy("r_name", "p_brand").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("receita"))


@query("j02_using", "select o_orderkey, sum(l_quantity) as qtd from (select l_orderkey as o_orderkey, l_quantity from lineitem) join orders using (o_orderkey) group by 1")
def using(t):
    return t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity").join(t.orders.select("o_orderkey"), "o_orderkey").groupBy("o_orderkey").agg(F.sum("l_quantity").alias("qtd"))


@query("j03_left_lookup", "select c_custkey, n_name from customer left join (select * from nation where n_regionkey < 3) on c_nationkey = n_nationkey")
def left_lookup(t):
    return t.customer.join(t.nation.filter("n_regionkey < 3"), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "n_name")


@query("j04_anti", "select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey)")
def anti(t):
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("j05_semi", "select p_partkey from part where p_partkey in (select l_partkey from lineitem where l_quantity > 49)")
def semi(t):
    return t.part.join(t.lineitem.filter("l_quantity > 49"), F.col("p_partkey") == F.col("l_partkey"), "left_semi").select("p_partkey")


@query(
    "j06_resends",
    "select event_id from events e where exists (select 1 from events p where p.user_id = e.user_id and p.event_type = e.event_type and (p.ts < e.ts or (p.ts = e.ts and p.event_id < e.event_id)))",
)
def resends(t):
    # an earlier row of the same key exists: compare with the key's first row instead of a theta join
    first = t.events.groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id")).alias("f"))
    return t.events.join(first, ["user_id", "event_type"]).filter(F.struct("ts", "event_id") > F.col("f")).select("event_id")


@query(
    "j07_full_outer",
    """select coalesce(a.k, b.k) as chave, a.n as pedidos, b.n as clientes from (select o_custkey % 100 as k, count(*) as n from orders where o_orderstatus = 'P' group by 1) a
       full join (select c_custkey % 150 as k, count(*) as n from customer where c_acctbal < 0 group by 1) b on a.k = b.k where a.n is distinct from b.n""",
)
def full_outer(t):
    a = t.orders.filter("o_orderstatus = 'P'").groupBy((F.col("o_custkey") % 100).alias("chave")).agg(F.count(F.lit(1)).alias("pedidos"))
    b = t.customer.filter("c_acctbal < 0").groupBy((F.col("c_custkey") % 150).alias("chave")).agg(F.count(F.lit(1)).alias("clientes"))
    return a.join(b, "chave", "full").filter(~F.col("pedidos").eqNullSafe(F.col("clientes")))


@query("j08_cross_small", "select r_name, s, f from region cross join (values ('F'), ('O'), ('P')) a(s) cross join (values (1), (2)) b(f)")
def cross_small(t):
    spark = t.spark
    return t.region.select("r_name").crossJoin(spark.createDataFrame([("F",), ("O",), ("P",)], "s string")).crossJoin(spark.createDataFrame([(1,), (2,)], "f int"))


@query("j09_cross_scalars", "select * from (select count(*) as pedidos, round(sum(o_totalprice), 2) as valor from orders) cross join (select count(*) as itens from lineitem)")
def cross_scalars(t):
    return t.orders.agg(F.count(F.lit(1)).alias("pedidos"), F.round(F.sum("o_totalprice"), 2).alias("valor")).crossJoin(t.lineitem.agg(F.count(F.lit(1)).alias("itens")))


@query(
    "j10_lateral_agg",
    """select event_type, dia, n, m.mediana from (select *, row_number() over (partition by event_type order by dia desc) as rn from (select event_type, cast(ts as date) as dia, count(*) as n from events group by 1, 2)) a
       left join lateral (select round(median(b.n), 8) as mediana from (select event_type, cast(ts as date) as dia, count(*) as n from events group by 1, 2) b where b.event_type = a.event_type and b.dia < a.dia and b.dia >= a.dia - 5) m on true where rn = 1""",
)
def lateral_agg(t):
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("dia")).agg(F.count(F.lit(1)).alias("n"))
    day = F.unix_date("dia")
    w = Window.partitionBy("event_type").orderBy(day)
    return daily.select("event_type", "dia", "n", F.round(F.percentile("n", 0.5).over(w.rangeBetween(-5, -1)), 8).alias("mediana"), F.row_number().over(Window.partitionBy("event_type").orderBy(F.desc("dia"))).alias("rn")).filter("rn = 1").drop("rn")


@query("j11_json_each", "select k as chave, count(*) as n, sum(cast(json_extract_string(props, '$.' || k) as int)) as soma from (select props, unnest(json_keys(props)) as k from events) group by 1")
def json_each(t):
    return t.events.select(F.explode(F.from_json("props", "map<string,int>")).alias("chave", "v")).groupBy("chave").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("soma"))


@query(
    "j13_role_playing",
    """select a.n_name as cliente, b.n_name as fornecedor, count(*) as n from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey
       join nation a on c_nationkey = a.n_nationkey join nation b on s_nationkey = b.n_nationkey group by 1, 2""",
)
def role_playing(t):
    a, b = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("cliente")), t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("fornecedor"))
    fact = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return fact.groupBy("c_nationkey", "s_nationkey").agg(F.count(F.lit(1)).alias("n")).join(a, "c_nationkey").join(b, "s_nationkey").select("cliente", "fornecedor", "n")


@query(
    "j14_asof",
    """select e.event_id, p.event_id as compra from (select * from events where event_type = 'click') e asof left join (select * from events where event_type = 'purchase') p on e.user_id = p.user_id and e.ts >= p.ts""",
)
def asof(t):
    """As-of join without a range join: both sides in one stream per key, the last right row carried forward."""
    e = t.events.filter("event_type in ('click', 'purchase')")
    w = Window.partitionBy("user_id").orderBy("ts", F.when(F.col("event_type") == "purchase", 0).otherwise(1), "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return e.withColumn("compra", F.last(F.when(F.col("event_type") == "purchase", F.col("event_id")), ignorenulls=True).over(w)).filter("event_type = 'click'").select("event_id", "compra")


@query(
    "j15_set_sync",
    """select case when b.k is null then 'nova' when a.k is null then 'obsoleta' else 'mantida' end as acao, count(*) as n from (select distinct o_custkey as k from orders where o_orderdate >= timestamp '1998-01-01') a
       full join (select distinct o_custkey as k from orders where o_orderdate < timestamp '1998-01-01') b on a.k = b.k group by 1""",
)
def sync(t):
    at = F.expr("timestamp_ntz'1998-01-01 00:00:00'")
    return set_sync(t.orders.filter(F.col("o_orderdate") >= at), t.orders.filter(F.col("o_orderdate") < at), ["o_custkey"]).groupBy("acao").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j16_update_from",
    "select c_custkey, case when c_acctbal is distinct from n then n else c_acctbal end as saldo, c_acctbal is distinct from n and n is not null as mudou from (select c_custkey, c_acctbal, coalesce(o.v, c_acctbal) as n from customer left join (select o_custkey, round(max(o_totalprice), 2) as v from orders where o_orderstatus = 'P' group by 1) o on o_custkey = c_custkey)",
)
def update_from(t):
    new = t.orders.filter("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.round(F.max("o_totalprice"), 2).alias("v"))
    both = t.customer.join(new, F.col("c_custkey") == F.col("o_custkey"), "left").withColumn("n", F.coalesce("v", "c_acctbal"))
    changed = ~F.col("n").eqNullSafe(F.col("c_acctbal"))
    return both.select("c_custkey", F.when(changed, F.col("n")).otherwise(F.col("c_acctbal")).alias("saldo"), changed.alias("mudou"))


@query("j17_scalar_subquery", "select c_custkey, (select max(o_orderdate) from orders where o_custkey = c_custkey) as ultimo from customer")
def scalar_subquery(t):
    return t.customer.join(t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("ultimo")), "c_custkey", "left").select("c_custkey", "ultimo")


@query(
    "j18_pivot_assembly",
    """with m as (select c_nationkey, round(avg(o_totalprice) filter (where o_orderstatus = 'F'), 8) as f, round(avg(o_totalprice) filter (where o_orderstatus = 'O'), 8) as o from orders join customer on o_custkey = c_custkey group by 1),
       g as (select n_regionkey, round(avg(o_totalprice), 8) as regiao from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1)
       select n_name, f, o, regiao from nation left join m on m.c_nationkey = n_nationkey left join g using (n_regionkey)""",
)
def pivot_assembly(t):
    facts = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    m = facts.groupBy("c_nationkey").pivot("o_orderstatus", ["F", "O"]).agg(F.round(F.avg("o_totalprice"), 8))
    g = facts.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey").agg(F.round(F.avg("o_totalprice"), 8).alias("regiao"))
    return t.nation.join(m, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(g, "n_regionkey", "left").select("n_name", F.col("F").alias("f"), F.col("O").alias("o"), "regiao")


# --- windows -------------------------------------------------------------------------------------------------------------


@query(
    "w01_dedup_newest",
    "select l_orderkey, l_linenumber, l_partkey from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey desc, l_suppkey desc) as rn from lineitem) where rn = 1",
)
def dedup_newest(t):
    return latest_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], [F.desc("l_shipdate"), F.desc("l_partkey"), F.desc("l_suppkey")]).select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "w02_latest_attributes",
    "select o_custkey, o_orderpriority, o_orderstatus from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn = 1",
)
def latest_attributes(t):
    return latest_per_key(t.orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderpriority", "o_orderstatus")


@query(
    "w03_latest_and_previous",
    """select o_custkey, max(o_totalprice) filter (where rn = 1) as atual, max(o_totalprice) filter (where rn = 2) as anterior, count(*) as linhas,
       max(o_totalprice) filter (where rn = 1) - max(o_totalprice) filter (where rn = 2) as variacao from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) group by 1""",
)
def with_previous(t):
    return latest_and_previous(t.orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], "o_totalprice")


@query(
    "w04_scd2",
    """select user_id, event_type, case when rn = 1 then timestamp '1900-01-01' else ts end as inicio, coalesce(nxt, timestamp '9999-12-31') as fim, nxt is null as vigente from
       (select *, row_number() over w as rn, lead(ts) over w as nxt from events where event_type <> 'view' window w as (partition by user_id order by ts, event_id))""",
)
def scd2(t):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = t.events.filter("event_type <> 'view'").withColumn("rn", F.row_number().over(w)).withColumn("nxt", F.lead("ts").over(w))
    ntz = lambda x: F.expr(f"timestamp_ntz'{x}'")
    return rows.select("user_id", "event_type", F.when(F.col("rn") == 1, ntz("1900-01-01 00:00:00")).otherwise(F.col("ts")).alias("inicio"), F.coalesce("nxt", ntz("9999-12-31 00:00:00")).alias("fim"), F.col("nxt").isNull().alias("vigente"))


@query(
    "w05_lag_change",
    """select p_brand, semana, round(media, 8) as media, round(100 * (media - lag(media) over w) / nullif(lag(media) over w, 0), 8) as variacao from
       (select p_brand, cast(date_trunc('month', l_shipdate) as date) as semana, avg(l_extendedprice) as media from lineitem join part on l_partkey = p_partkey group by 1, 2) window w as (partition by p_brand order by semana)""",
)
def lag_change(t):
    m = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", F.date_trunc("month", "l_shipdate").cast("date").alias("semana")).agg(F.avg("l_extendedprice").alias("media"))
    before = F.lag("media").over(Window.partitionBy("p_brand").orderBy("semana"))
    return m.select("p_brand", "semana", F.round("media", 8).alias("media"), F.round(100 * (F.col("media") - before) / F.nullif(before, F.lit(0.0)), 8).alias("variacao"))


@query(
    "w06_prev10",
    f"select event_type, dia, n from (select *, row_number() over (partition by event_type order by dia desc) as rn from ({DAILY})) where rn between 2 and 11",
)
def prev10(t):
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("dia")).agg(F.count(F.lit(1)).alias("n"))
    return daily.withColumn("rn", F.row_number().over(Window.partitionBy("event_type").orderBy(F.desc("dia")))).filter("rn between 2 and 11").drop("rn")


@query("w07_sum_of_sum", "select n_regionkey, n_name, sum(c) as n, sum(sum(c)) over (partition by n_regionkey) as regiao from (select n_regionkey, n_name, 1 as c from customer join nation on c_nationkey = n_nationkey) group by 1, 2")
def sum_of_sum(t):
    per = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey", "n_name").agg(F.count(F.lit(1)).alias("n"))
    return per.withColumn("regiao", F.sum("n").over(Window.partitionBy("n_regionkey")))


@query(
    "w08_null_order",
    "select c_nationkey, c_custkey from (select *, row_number() over (partition by c_nationkey order by case when c_acctbal < 0 then null else c_acctbal end desc nulls first, c_custkey) as rn from customer) where rn = 1",
)
def null_order(t):
    rows = t.customer.withColumn("k", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    return latest_per_key(rows, ["c_nationkey"], [F.desc_nulls_first("k"), F.asc("c_custkey")]).select("c_nationkey", "c_custkey")


@query(
    "w09_repeat_suffix",
    "select p_partkey, p_name || case when rn > 1 then '#' || rn else '' end as rotulo from (select *, row_number() over (partition by p_name order by p_partkey) as rn from part)",
)
def repeat_suffix(t):
    rn = F.row_number().over(Window.partitionBy("p_name").orderBy("p_partkey"))
    return t.part.withColumn("rn", rn).select("p_partkey", F.concat("p_name", F.when(F.col("rn") > 1, F.concat(F.lit("#"), F.col("rn").cast("string"))).otherwise("")).alias("rotulo"))


# --- sort, limit, top-k --------------------------------------------------------------------------------------------------


@query("t01_order_limit", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 20")
def order_limit(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("t02_latest_scalar", "select o_totalprice as ultimo from orders order by o_orderdate desc, o_orderkey desc limit 1")
def latest_scalar(t):
    return t.orders.agg(F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("ultimo"))


@query("t03_nulls_last", "select c_custkey, nullif(c_mktsegment, 'BUILDING') as s from customer order by s asc nulls last, c_custkey limit 50")
def nulls_last(t):
    return t.customer.select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("s")).orderBy(F.asc_nulls_last("s"), "c_custkey").limit(50)


@query("t04_case_order", "select event_id, event_type from events order by case event_type when 'error' then 0 when 'purchase' then 1 else 2 end, event_id limit 30")
def case_order(t):
    return t.events.select("event_id", "event_type").orderBy(F.when(F.col("event_type") == "error", 0).when(F.col("event_type") == "purchase", 1).otherwise(2), "event_id").limit(30)


@query("t05_array_position", "select p_partkey from part where p_partkey in (7, 3, 11, 5) order by list_position([7, 3, 11, 5], p_partkey) limit 3")
def array_position(t):
    wanted = F.array(*(F.lit(x).cast("bigint") for x in (7, 3, 11, 5)))
    return t.part.filter(F.array_contains(wanted, F.col("p_partkey"))).orderBy(F.array_position(wanted, F.col("p_partkey"))).select("p_partkey").limit(3)


@query("t06_abs_change", "select s_suppkey, s_acctbal from supplier order by abs(s_acctbal - 5000) desc, s_suppkey limit 10")
def abs_change(t):
    return t.supplier.select("s_suppkey", "s_acctbal").orderBy(F.desc(F.abs(F.col("s_acctbal") - 5000)), "s_suppkey").limit(10)


@query(
    "t07_fixed_order",
    "select c_mktsegment, row_number() over (order by case c_mktsegment when 'MACHINERY' then 1 when 'BUILDING' then 2 else 1000000 end, c_mktsegment) as posicao from (select distinct c_mktsegment from customer)",
)
def fixed_order(t):
    segments = t.customer.select("c_mktsegment").distinct()  # a handful of rows
    order = F.when(F.col("c_mktsegment") == "MACHINERY", 1).when(F.col("c_mktsegment") == "BUILDING", 2).otherwise(1000000)
    return segments.select("c_mktsegment", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(order, "c_mktsegment")).alias("posicao"))


@query("t08_ranking_direction", "select p_brand, min(p_retailprice) as preco from part group by 1 order by 2 asc, 1 limit 5")
def ranking(t):
    return t.part.groupBy("p_brand").agg(F.min("p_retailprice").alias("preco")).orderBy("preco", "p_brand").limit(5)


@query("t11_first_n_and_total", "select s_suppkey, s_name, (select count(*) from supplier where s_acctbal > 0) as total from supplier where s_acctbal > 0 order by s_name limit 15")
def first_and_total(t):
    rows = t.supplier.filter("s_acctbal > 0")
    return rows.orderBy("s_name").limit(15).crossJoin(rows.agg(F.count(F.lit(1)).alias("total"))).select("s_suppkey", "s_name", "total")


# --- set operations ------------------------------------------------------------------------------------------------------


@query("u01_union_all", "select 'c' as papel, c_nationkey as pais, c_acctbal as saldo from customer union all select 's', s_nationkey, s_acctbal from supplier")
def union_all(t):
    return t.customer.select(F.lit("c").alias("papel"), F.col("c_nationkey").alias("pais"), F.col("c_acctbal").alias("saldo")).unionByName(t.supplier.select(F.lit("s").alias("papel"), F.col("s_nationkey").alias("pais"), F.col("s_acctbal").alias("saldo")))


@query("u02_role_unpivot", "select l_orderkey as doc, 'peca' as papel, l_partkey as id from lineitem union all select l_orderkey, 'fornecedor', l_suppkey from lineitem")
def role_unpivot(t):
    # one scan instead of two
    return t.lineitem.select(F.col("l_orderkey").alias("doc"), F.inline(F.array(F.struct(F.lit("peca").alias("papel"), F.col("l_partkey").alias("id")), F.struct(F.lit("fornecedor").alias("papel"), F.col("l_suppkey").alias("id")))))


@query(
    "u03_metric_unpivot",
    "select l_returnflag, 'quantidade' as metrica, round(avg(l_quantity), 6) as valor from lineitem group by 1 union all select l_returnflag, 'desconto', round(avg(l_discount), 6) from lineitem group by 1",
)
def metric_unpivot(t):
    wide = t.lineitem.groupBy("l_returnflag").agg(F.round(F.avg("l_quantity"), 6).alias("quantidade"), F.round(F.avg("l_discount"), 6).alias("desconto"))
    return wide.unpivot(["l_returnflag"], ["quantidade", "desconto"], "metrica", "valor")


@query("u04_union_distinct", "select c_nationkey as pais from customer union select s_nationkey from supplier")
def union_distinct(t):
    return t.customer.select(F.col("c_nationkey").alias("pais")).union(t.supplier.select("s_nationkey")).distinct()


@query(
    "u05_set_difference",
    "select 'sem pedido' as lado, c_custkey as k from customer where c_custkey not in (select o_custkey from orders) union all select 'sem cliente', o_custkey from (select distinct o_custkey from orders) where o_custkey not in (select c_custkey from customer)",
)
def set_difference(t):
    a = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select(F.lit("sem pedido").alias("lado"), F.col("c_custkey").alias("k"))
    b = t.orders.select("o_custkey").distinct().join(t.customer, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select(F.lit("sem cliente").alias("lado"), F.col("o_custkey").alias("k"))
    return a.unionByName(b)


@query("u06_concat", "select p_partkey as id, p_name as nome from part where p_size < 10 union all select s_suppkey, s_name from supplier where s_acctbal < 0")
def concat(t):
    return t.part.filter("p_size < 10").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("nome")).unionByName(t.supplier.filter("s_acctbal < 0").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nome")))


@query("u07_unique_first", "select p_name, p_partkey from (select *, row_number() over (partition by p_name order by p_partkey) as rn from part) where rn = 1")
def unique_first(t):
    return t.part.groupBy("p_name").agg(F.min("p_partkey").alias("p_partkey"))


@query("u08_unnest", "select p_partkey, unnest(string_split(p_name, ' ')) as palavra from part")
def unnest(t):
    return t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("palavra"))
