"""Queries of the corpus and table operators, each with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.functions import filings as fl
from docweave.functions import text as tx
from docweave.operators import corpus as cp
from docweave.operators import store
from docweave.plans.sql import GOOD, KEY, SAMPLED
from docweave.sources import scratch

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Registers a query by its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return cp.good_blocks(docs)


@query(f"with {GOOD} select doc_id, pos, block from good")
def corpus_block_filter(spark, sf_dir):
    return good(spark, sf_dir).select("doc_id", "pos", "block")


@query(f"with {GOOD} select doc_id, pos, block from (select *, row_number() over (partition by {KEY} order by doc_id, pos) as n from good) where n = 1")
def corpus_dedupe_first(spark, sf_dir):
    return cp.first_of_each(good(spark, sf_dir).select("doc_id", "pos", "block"), tx.dedupe_key(F.col("block")), ["doc_id", "pos"])


@query(f"with {GOOD}, {SAMPLED} select doc_id, pos, block from sampled")
def corpus_hash_sample(spark, sf_dir):
    return cp.sample_per_group(good(spark, sf_dir), "doc_id", 3, 42, "pos").select("doc_id", "pos", "block")


@query(f"with {GOOD} select doc_id, pos, source from (select *, row_number() over (partition by source order by doc_id, pos) as n from good) where n <= 20 or source is null")
def corpus_group_cap(spark, sf_dir):
    return cp.cap_per_group(good(spark, sf_dir), "source", 20, ["doc_id", "pos"]).select("doc_id", "pos", "source")


@query(
    f"""with {GOOD}, {SAMPLED},
    firsts as (select * from (select *, row_number() over (partition by {KEY} order by doc_id, pos) as m from sampled) where m = 1)
    select doc_id, pos, source, block from (select *, row_number() over (partition by source order by doc_id, pos) as k from firsts) where k <= 50 or source is null"""
)
def corpus_build(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return cp.build(docs, "doc_id", "source", per_document=3, per_group=50).select("doc_id", "pos", "source", "block")


STRATA = """with tagged as (
  select o_orderkey, cast(year(o_orderdate) as integer) as year, md5('7|' || cast(o_orderkey as varchar)) as d from orders),
ranked as (select *, row_number() over (partition by year order by d) as n, (select 900 // count(distinct year) from tagged) as quota from tagged),
first as (select * from ranked where n <= quota),
more as (select * from ranked where n > quota order by d limit (select greatest(0, 900 - count(*)) from first))
select o_orderkey, year from first union all select o_orderkey, year from more"""


@query(STRATA)
def corpus_stratified(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return cp.stratify(o, F.col("year").cast("string"), 900, 7, "o_orderkey").select("o_orderkey", "year")


@query(
    f"""with {GOOD.split("good as")[0].rstrip().rstrip(",")}
    select count(*) as n_all, count(*) filter (b) as n_long, count(*) filter (b and c) as n_alpha, count(*) filter (b and c and d) as n_lower,
      round(100 * count(*) filter (b) / greatest(count(*), 1), 2) as pct_long, round(100 * count(*) filter (b and c) / greatest(count(*), 1), 2) as pct_alpha,
      round(100 * count(*) filter (b and c and d) / greatest(count(*), 1), 2) as pct_lower
    from (select length(block) >= 50 as b, length(regexp_replace(block, '[^A-Za-z]', '', 'g')) / greatest(length(block), 1) >= 0.5 as c,
      length(regexp_replace(block, '[^\\p{{Lu}}]', '', 'g')) / greatest(length(regexp_replace(block, '[^\\p{{L}}]', '', 'g')), 1) <= 0.6 as d from cleaned)"""
)
def corpus_funnel(spark, sf_dir):
    lines = F.split("text", "\n")
    return cp.funnel(table(spark, sf_dir, "documents"), lines, long=lambda b: F.length(b) >= 50, alpha=lambda b: tx.alpha_ratio(b) >= 0.5, lower=lambda b: tx.upper_ratio(b) <= 0.6)


@query(
    f"""with {GOOD}, {SAMPLED},
    firsts as (select * from (select *, row_number() over (partition by {KEY} order by doc_id, pos) as m from sampled) where m = 1),
    capped as (select * from (select *, row_number() over (partition by source order by doc_id, pos) as k from firsts) where k <= 50 or source is null)
    select 'good' as step, count(*) as n from good union all select 'sampled', count(*) from sampled union all select 'unique', count(*) from firsts union all select 'kept', count(*) from capped"""
)
def observed_funnel(spark, sf_dir):
    """What each step of the corpus left, counted by the job that writes it: AGG12."""
    counts = cp.build_observed(table(spark, sf_dir, "documents"), "doc_id", "source", scratch.folder(spark, "corpus"), 42, 3, 50)
    return spark.createDataFrame(list(counts.items()), "step string, n long")


@query("select cast(year(o_orderdate) // 10 * 10 as varchar) || 's' as decade, count(*) as n from orders group by 1")
def decade_histogram(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(cp.decade(F.year("o_orderdate")).alias("decade")).agg(F.count("*").alias("n"))


@query(
    """select doc_id, round(length(regexp_replace(text, '[^A-Za-z]', '', 'g')) / greatest(length(text), 1), 6) as alpha,
    round(length(regexp_replace(text, '[^0-9]', '', 'g')) / greatest(length(text), 1), 6) as digit,
    round(length(regexp_replace(text, '[^\\p{Lu}]', '', 'g')) / greatest(length(regexp_replace(text, '[^\\p{L}]', '', 'g')), 1), 6) as upper,
    trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) as match_key from documents"""
)
def text_ratios(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.round(tx.alpha_ratio(t), 6).alias("alpha"), F.round(tx.digit_ratio(t), 6).alias("digit"), F.round(tx.upper_ratio(t), 6).alias("upper"), tx.match_key(t).alias("match_key"))


@query("select conv_id, count(*) as n_words from (select conv_id, unnest(regexp_extract_all(text, '[\\p{L}\\p{N}\\p{M}_]+(?:[-''][\\p{L}\\p{N}\\p{M}_]+)*|[^\\p{L}\\p{N}\\p{M}_\\s]')) as w from conversations) group by conv_id")
def token_counts(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", F.explode(tx.tokens(F.col("text"))).alias("w")).groupBy("conv_id").agg(F.count("*").alias("n_words"))


# ---------------------------------------------------------------- tables


@query("select o_orderkey, o_custkey, o_totalprice, c_name, c_mktsegment from orders left join customer on o_custkey = c_custkey")
def manifest_left_join(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return store.with_manifest(table(spark, sf_dir, "orders"), c, "o_custkey").select("o_orderkey", "o_custkey", "o_totalprice", "c_name", "c_mktsegment")


@query(
    """select c.c_custkey as cik, cast(o.o_orderkey as varchar) as accession, n.n_name as name from orders o join customer c on o.o_custkey = c.c_custkey
    left join nation n on c.c_nationkey = n.n_nationkey where (case when o_orderstatus = 'P' then null else o_orderpriority end) is null
      or (case when o_orderstatus = 'P' then null else o_orderpriority end) not in ('1-URGENT', '2-HIGH')"""
)
def manifest_names_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    results = o.select(F.col("o_orderkey").cast("string").alias("accession"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("home_country"))
    links = o.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").cast("string").alias("accession"), F.col("c_custkey").alias("cik"), "c_nationkey")
    names = links.select("cik", "c_nationkey").distinct().join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("cik", F.col("n_name").alias("name"))
    return store.with_names(results, links.select("accession", "cik"), names, ("1-URGENT", "2-HIGH")).select("cik", "accession", "name")


@query("select distinct o_custkey as cik, cast(year(o_orderdate) as integer) as year from orders where (o_custkey, year(o_orderdate)) not in (select o_custkey, year(o_orderdate) from orders where o_orderstatus = 'F')")
def manifest_year_antijoin(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cik"), F.year("o_orderdate").alias("year"), "o_orderstatus")
    return store.not_done(o.select("cik", "year").distinct(), o.where("o_orderstatus = 'F'"), ["cik", "year"])


@query("select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders)")
def manifest_resume_antijoin(spark, sf_dir):
    done = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return store.not_done(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), done, ["c_custkey"])


SYNC = """with m as (select cast(o_orderkey as varchar) as accession, cast(year(o_orderdate) as integer) as year from orders),
r as (select cast(l_orderkey as varchar) as accession, case when l_orderkey % 3 = 0 then 'n/a' else cast(max(year(l_shipdate)) as varchar) end as period from lineitem group by l_orderkey)
select accession, coalesce(try_cast(period as integer), year) as year from m left join r using (accession)"""


@query(SYNC)
def manifest_sync_update(spark, sf_dir):
    m = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("accession"), F.year("o_orderdate").alias("year"))
    periods = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max(F.year("l_shipdate")).alias("y"))
    r = periods.select(F.col("l_orderkey").cast("string").alias("accession"), F.when(F.col("l_orderkey") % 3 == 0, "n/a").otherwise(F.col("y").cast("string")).alias("period_of_report"))
    return store.sync_years(m, r)


@query("select o_orderkey, key from (select o_orderkey, case when o_custkey % 7 = 0 then null else o_custkey end as key from orders) where key is null or o_orderkey in (select min(o_orderkey) from orders where o_custkey % 7 <> 0 group by o_custkey)")
def manifest_min_id_dedupe(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("key"))
    return store.smallest_id_of_each(o, "key", "o_orderkey")


@query(
    """with k as (select case when o_custkey % 11 = 0 then null else cast(o_custkey as varchar) end as accession, o_custkey as cik, cast(year(o_orderdate) as integer) as year, cast(o_orderkey as varchar) as url from orders)
    select cik, year, url, accession from (select *, row_number() over (partition by coalesce(accession, 'none/' || cik || '/' || year) order by cik, year, url) as n from k) where n = 1"""
)
def manifest_import(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = o.select(F.col("o_custkey").alias("cik"), F.year("o_orderdate").alias("year"), F.col("o_orderkey").cast("string").alias("url"), F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey").cast("string")).alias("accession"))
    return store.import_manifest(k)


@query("select user_id, event_id, event_type, value from (select *, row_number() over (partition by user_id order by event_id desc) as n from events) where n = 1")
def upsert_last_write(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return store.upsert(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), "user_id", "event_id")


@query(
    """with t as (select * from (select user_id, event_id, event_type, row_number() over (partition by user_id order by event_id) as n from events where event_id % 2 = 0) where n = 1),
    b as (select * from (select user_id, event_id, event_type, row_number() over (partition by user_id order by event_id) as n from events where event_id % 2 = 1) where n = 1)
    select user_id, event_id, event_type from t union all select user_id, event_id, event_type from b where user_id not in (select user_id from t)"""
)
def append_new_keys(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    first = store.append_new(e.limit(0), e.where("event_id % 2 = 0"), "user_id", "event_id")
    return store.append_new(first, e.where("event_id % 2 = 1"), "user_id", "event_id")


@query("select event_id, case when value < 0 then 'negative' when event_type = 'error' then 'type' end as reason from events where value < 0 or event_type = 'error'")
def reject_routing(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return store.split_rejects(e, F.when(F.col("value") < 0, "negative").when(F.col("event_type") == "error", "type"))[1].select("event_id", "reason")


@query(
    """with w as (select distinct c_custkey as cik, y as year from customer, (values (1995), (1996), (1997)) v(y)),
    f as (select distinct o_custkey as cik, year(o_orderdate) as year from orders)
    select w.cik, w.year, '' as url, null::varchar as accession from w anti join f using (cik, year)"""
)
def placeholder_years(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cik"), F.explode(F.array(*[F.lit(y) for y in (1995, 1996, 1997)])).alias("year"))
    found = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cik"), F.year("o_orderdate").alias("year"))
    return store.missing_years(wanted, found)


@query("select event_id, try_cast(json_extract_string(props, '$.k') as integer) as k from events")
def json_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "struct<k:int>")["k"].alias("k"))


@query("select lang, row_number() over (order by lang) - 1 as label_id from (select distinct lang from documents)")
def label_ids(spark, sf_dir):
    from docweave.operators.training import label_ids as ids

    return ids(table(spark, sf_dir, "documents"), "lang").select("lang", "label_id")


@query(
    """select event_id, user_id, coalesce(last_value(case when event_type = 'view' then event_id end ignore nulls) over (partition by user_id order by event_id rows unbounded preceding), -1) as since from events"""
)
def forward_fill(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    seen = F.last(F.when(F.col("event_type") == "view", F.col("event_id")), ignorenulls=True).over(w)
    return table(spark, sf_dir, "events").select("event_id", "user_id", F.coalesce(seen, F.lit(-1)).alias("since"))


URLS = """with u as (select o_orderkey, 'https://host/Archives/edgar/data/' || cast(o_custkey as varchar) || '/' || lpad(cast(o_custkey as varchar), 10, '0') ||
  lpad(cast(year(o_orderdate) % 100 as varchar), 2, '0') || lpad(cast(o_orderkey % 1000000 as varchar), 6, '0') || case when o_orderkey % 5 = 0 then 'x' else '' end || '/a.htm' as url from orders),
a as (select *, nullif(regexp_extract(url, '/(\\d{18})/', 1), '') as accession from u)
select o_orderkey, accession, case when accession is not null then o_orderkey * 0 + try_cast(regexp_extract(url, '/(\\d+)/\\d{18}/', 1) as bigint) end as cik,
  case when accession is not null then case when cast(accession[11:12] as integer) >= 90 then 1900 + cast(accession[11:12] as integer) else 2000 + cast(accession[11:12] as integer) end end as filing_year from a"""


@query(URLS)
def accession_parse(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    year = (F.year("o_orderdate") % 100).cast("string")
    url = F.concat(
        F.lit("https://host/Archives/edgar/data/"), F.col("o_custkey").cast("string"), F.lit("/"), F.lpad(F.col("o_custkey").cast("string"), 10, "0"), F.lpad(year, 2, "0"),
        F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0"), F.when(F.col("o_orderkey") % 5 == 0, "x").otherwise(""), F.lit("/a.htm"),
    )
    return o.select("o_orderkey", fl.accession(url).alias("accession"), fl.firm_of(url).alias("cik"), fl.filing_year(fl.accession(url)).alias("filing_year"))
