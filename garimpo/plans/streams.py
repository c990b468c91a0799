"""Streaming flows as named queries: the table is replayed as arriving files and the sink is read afterwards."""

from __future__ import annotations

from pyspark.sql import functions as F

from garimpo.operators.upsert import Target
from garimpo.plans.catalog import query
from garimpo.streaming import flows
from garimpo.workspace import fresh


def _sink(t, df, name: str, mode: str = "append"):
    at = fresh(t.spark, name)

    def batch(b, number):
        b.write.mode("overwrite").parquet(f"{at}/b={number}")

    flows.run_available(df, batch, fresh(t.spark, "checkpoint"), mode)
    return t.spark.read.schema(df.schema).parquet(at)


@query("x01_file_arrival", "select lote_id, arquivo from nfe_xml where regexp_matches(rtrim(conteudo, ' \n\r\t'), '(nfeProc|NFe)>$')")
def arrival(t):
    source = flows.replay(t.nfe_xml.select("lote_id", "arquivo", "conteudo"), "chegada", 4)
    target = Target(t.spark, fresh(t.spark, "silver"))
    flows.ingest_documents(t.spark, source, "lote_id bigint, arquivo string, conteudo string", target, fresh(t.spark, "quarentena"), fresh(t.spark, "checkpoint"), ["lote_id", "arquivo"], "conteudo", files_per_batch=2)
    return target.read().select("lote_id", "arquivo")


@query("x02_late_upsert", "select user_id, max(event_id) as ultimo from events group by 1")
def late(t):
    """Files in any order: foreachBatch keeps the newest row of each key."""
    source = flows.replay(t.events.select("user_id", "event_id"), "eventos", 4)
    target = Target(t.spark, fresh(t.spark, "ultimos"))

    def batch(df, number):
        old = target.read()
        both = df.select("user_id", F.col("event_id").alias("ultimo"))
        both = both if old is None else both.unionByName(old)
        target.write(both.groupBy("user_id").agg(F.max("ultimo").alias("ultimo")))

    flows.run_available(t.spark.readStream.schema("user_id bigint, event_id bigint").option("maxFilesPerTrigger", 1).parquet(source), batch, fresh(t.spark, "checkpoint"))
    return target.read()


@query("x03_affected_months", "select month(o_orderdate) as mes, count(*) as n, round(sum(o_totalprice), 2) as valor from orders group by 1")
def affected(t):
    """A late file reopens only its own months."""
    from garimpo.operators.upsert import replace_groups

    rows = t.orders.select(F.month("o_orderdate").alias("mes"), "o_totalprice", "o_orderstatus")
    build = lambda r: r.groupBy("mes").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("valor"))
    before = build(rows.filter("not (mes in (3, 4) and o_orderstatus = 'P')"))
    return replace_groups(before, rows, rows.filter("mes in (3, 4) and o_orderstatus = 'P'"), ["mes"], build)


@query("x04_tumbling_6h", "select time_bucket(interval '6 hours', ts, timestamp '1970-01-01') as inicio, event_type, count(*) as n from events group by 1, 2")
def tumbling(t):
    source = flows.replay(t.events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type"), "eventos", 2)
    stream = t.spark.readStream.schema("ts timestamp, event_type string").parquet(source)
    at = fresh(t.spark, "janelas")

    def batch(df, number):
        df.write.mode("overwrite").parquet(f"{at}/{number:06d}")

    counts = flows.tumbling(stream, "ts", ["event_type"])
    flows.run_available(counts, batch, fresh(t.spark, "checkpoint"), "complete")
    newest = t.spark.read.schema(counts.schema).parquet(f"{at}/*").groupBy("w", "event_type").agg(F.max("n").alias("n"))
    return newest.select(F.col("w.start").cast("timestamp_ntz").alias("inicio"), "event_type", "n")


@query("x02_once_within_watermark", "select distinct event_id from events")
def once(t):
    rows = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    source = flows.replay(rows.unionByName(rows), "eventos", 2)
    stream = t.spark.readStream.schema("event_id bigint, ts timestamp").parquet(source)
    return _sink(t, flows.once_within(stream, "event_id", "ts", "3650 days"), "unicos").select("event_id")


@query("x05_stale_runs", "select lote_id from nfe_lote where processado_em is null and carregado_em < timestamp '2026-05-10' - interval 6 hour")
def stale(t):
    return flows.stale(t.nfe_lote, "carregado_em", "processado_em", F.expr("timestamp_ntz'2026-05-10 00:00:00'")).select("lote_id")
