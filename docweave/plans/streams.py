"""Queries of the streams and stores that keep state."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.plans.corpus import table
from docweave.sources import landed, scratch
from docweave.streaming import retries, windows
from docweave.streaming.keyed import Store

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(
    """select page_id, case page_id % 6 when 4 then 'dead' when 5 then 'dead' else 'done' end as kind, case when page_id % 6 in (0, 1) then 0 else 1 end as address,
    case page_id % 6 when 1 then 2 when 5 then 3 else 1 end as attempt, case page_id % 6 when 0 then 1 when 1 then 2 when 2 then 2 when 3 then 4 when 4 then 2 else 6 end as requests,
    case page_id % 6 when 4 then 'missing' when 5 then 'exhausted' end as reason, case when page_id % 6 < 4 then length(html) end as n from pages where html <> ''"""
)
def retried_pages(spark, sf_dir):
    """Pages that are found at once, after a limit, as plain text after a 404 or after three failures, or never: STR5."""
    p = table(spark, sf_dir, "pages").where("html <> ''").select("page_id", "html", (F.col("page_id") % 6).alias("k"))
    at = F.timestamp_seconds(F.lit(1_000_000_000) + F.col("page_id") % 1000)
    tried = p.select("page_id", "k", "html", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("address")).select("*", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("attempt"))
    first = F.when(F.col("k") == 0, 200).when(F.col("k") == 1, F.when(F.col("attempt") == 1, 429).otherwise(200)).when(F.col("k").isin(2, 4), 404).when(F.col("k") == 5, 429)
    second = F.when(F.col("k").isin(2, 3), 200).when(F.col("k") == 4, 404).otherwise(503)
    status = F.when(F.col("address") == 0, first).otherwise(second).cast("int")
    responses = tried.select("page_id", "address", "attempt", status.alias("status"), F.when(status == 200, F.col("html")).alias("body"))
    said = retries.crawl(spark, p.select("page_id", at.alias("at")), responses, "page_id", scratch.folder(spark, "crawl"))
    requests = said.where("kind = 'request'").groupBy("page_id").agg(F.count("*").alias("requests"))
    ends = said.where("kind <> 'request'").select("page_id", "kind", "address", "attempt", "reason", F.length("body").alias("n"))
    return ends.join(requests, "page_id")


_STATUS = "case page_id % 7 when 1 then 404 when 2 then 429 when 3 then null when 4 then 503 when 5 then 403 else 200 end"


@query(
    f"""with p as (select url, html, page_id, {_STATUS} as status from pages where url is not null)
    select url, status, case when status = 200 then coalesce(html, '') when status = 404 then '' end as text,
    case when status = 200 then 'found' when status = 404 then 'missing' when status is null or status in (429, 503) then 'retry' else 'failed' end as outcome,
    case when page_id % 2 = 0 then 'batch' else 'stream' end as read_by from p"""
)
def landed_responses(spark, sf_dir):
    """Pages landed with the status they came with, half of them read by a stream in two runs: SRC8, SRC9."""
    landed.register(spark)
    p = table(spark, sf_dir, "pages").where("url is not null").select("page_id", "url", F.expr(_STATUS).alias("status"), F.col("html").alias("body"))
    one, two, out, at = (scratch.folder(spark, n) for n in ("landed-one", "landed-two", "responses", "stream"))
    land = lambda df, to: df.select("url", "status", "body").write.format("landed").mode("append").save(to)
    land(p.where("page_id % 2 = 0").repartition(4), one)
    for part in ("page_id % 4 = 1", "page_id % 4 = 3"):
        land(p.where(part).repartition(2), two)
        stream = spark.readStream.format("landed").load(two)
        stream.writeStream.format("parquet").option("checkpointLocation", at).trigger(availableNow=True).start(out).awaitTermination()
    batch = spark.read.format("landed").load(one).withColumn("read_by", F.lit("batch"))
    return batch.unionByName(spark.read.schema(landed.SCHEMA).parquet(out).withColumn("read_by", F.lit("stream")))


@query(
    """select o_orderkey, case when o_orderkey % 2 = 0 then 'second' when o_orderkey % 3 = 0 then 'third' else 'first' end as batch,
    case when o_orderkey % 2 = 0 then o_totalprice + 1 when o_orderkey % 3 = 0 then -1.0 else o_totalprice end as price from orders"""
)
def compacted_store(spark, sf_dir):
    """A keyed table after three batches, of which two were compacted and one came twice: SNK2, STR8."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    store = Store(spark, scratch.folder(spark, "keyed"), "o_orderkey", "o_orderkey bigint, batch string, price double", buckets=8)
    store.append(o.withColumn("batch", F.lit("first")), 0)
    store.append(o.where("o_orderkey % 2 = 0").select("o_orderkey", (F.col("price") + 1).alias("price"), F.lit("second").alias("batch")), 1)
    store.compact()
    third = o.where("o_orderkey % 6 = 3").select("o_orderkey", F.lit(-1.0).alias("price"), F.lit("third").alias("batch"))
    store.append(third, 2)
    store.append(third.withColumn("price", F.lit(0.0)), 2)
    return store.current()


_LATE = "user_id % 10 = 0 and ts < timestamp '2024-01-03'"


@query(
    """with days as (
      select 'day' as kind, date_trunc('day', ts) as start, date_trunc('day', ts) + interval 1 day as "end", event_type as name, count(*) as n, sum(value) as total from events group by all),
    pairs as (
      select 'two days' as kind, d as start, d + interval 2 day as "end", event_type as name, count(*) as n, sum(value) as total
      from (select *, unnest([date_trunc('day', ts), date_trunc('day', ts) - interval 1 day]) as d from events) group by all),
    cut as (select *, sum(case when gap is null or gap > interval 8 hour then 1 else 0 end) over (partition by user_id order by ts) as s from (select *, ts - lag(ts) over (partition by user_id order by ts) as gap from events)),
    sessions as (select 'session' as kind, min(ts) as start, max(ts) + interval 8 hour as "end", cast(user_id as varchar) as name, count(*) as n, sum(value) as total from cut group by user_id, s)
    select kind, epoch_us(start) as start, epoch_us("end") as "end", name, n, round(total, 4) as total from (from days union all from pairs union all from sessions)"""
)
def event_windows(spark, sf_dir):
    """Tumbling, sliding and session windows of a stream with a watermark, that gets late rows too."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").cast("string").alias("user_id"), "event_type", "value")
    landed_at, half = scratch.folder(spark, "events"), F.lit("2024-01-15").cast("timestamp")
    clock = e.limit(1).select("event_id", F.lit("2030-01-01").cast("timestamp").alias("ts"), F.lit(windows.CLOCK).alias("user_id"), F.lit(windows.CLOCK).alias("event_type"), F.lit(0.0).alias("value"))
    # one file after the other: two halves, rows that come far too late, and one row that lets time pass
    for part in (e.where(F.col("ts") < half), e.where(F.col("ts") >= half), e.where(_LATE), clock):
        part.coalesce(1).write.mode("append").parquet(landed_at)
    stream = retries.session(spark).readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(landed_at)
    made = None
    sums = (F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    for kind, window, name in (
        ("day", windows.spans("ts", "1 day"), "event_type"), ("two days", windows.spans("ts", "2 days", "1 day"), "event_type"), ("session", windows.sessions("ts", "8 hours"), "user_id"),
    ):
        out, at = scratch.folder(spark, "windows"), scratch.folder(spark, "state")
        counted = windows.aggregated(stream, "ts", window, name, "1 hour", *sums)
        windows.finished(counted, out, at)
        own = spark.read.schema(counted.schema).parquet(out).where(F.col("name") != windows.CLOCK)
        own = own.select(F.lit(kind).alias("kind"), F.unix_micros("start").alias("start"), F.unix_micros("end").alias("end"), "name", "n", "total")
        made = own if made is None else made.unionByName(own)
    return made
