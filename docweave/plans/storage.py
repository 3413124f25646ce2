"""Queries that write tables and read them again, and streams, each with SQL for the same rows; and the queries of names."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.functions import firms
from docweave.operators import commodities, dictionary, ner, phones
from docweave.plans import rendered
from docweave.plans.corpus import table
from docweave.plans.rules import customer, cycle, key, orders, said
from docweave.plans.sql import RENDERED
from docweave.sources import scratch
from docweave.sources import tables as sources
from docweave.streaming import ingest

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---------------------------------------------------------------- tables


@query("select c_custkey as cik, c_name as name, cast(c_nationkey as varchar) as nation from customer")
def firms_of_csv(spark, sf_dir):
    """A CSV list of firms: SRC1."""
    path = scratch.folder(spark, "firms")
    table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cik"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")).write.option("header", True).csv(path)
    return sources.firms(spark, path)


@query("select o_custkey as cik, cast(year(o_orderdate) as integer) as year, 'u' || cast(o_orderkey as varchar) as url, cast(null as varchar) as accession, cast(null as varchar) as original_url from orders")
def manifest_of_parquet(spark, sf_dir):
    """A manifest whose optional columns are missing: SRC3."""
    path = scratch.folder(spark, "manifest")
    orders(spark, sf_dir).select(customer().alias("cik"), F.year("o_orderdate").alias("year"), said("u", key()).alias("url")).write.parquet(path)
    return sources.manifest(spark, path)


@query("select o_orderkey, o_custkey, (select (count(*) + 999) // 1000 from orders) as files from orders")
def merged_chunks(spark, sf_dir):
    """Chunks of bounded size, merged without debugging columns into files of a thousand rows: SNK4, SNK6, SNK7, FLT7."""
    chunks, to = scratch.folder(spark, "chunks"), scratch.folder(spark, "merged")
    spread = orders(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism, "o_orderkey")
    o = spread.select("o_orderkey", "o_custkey", F.lit("why").alias("debug"))
    sources.write_chunks(o.where("o_orderkey % 2 = 0"), chunks, 300)
    sources.write_chunks(o.where("o_orderkey % 2 = 1"), chunks, 300)
    sources.merge_chunks(spark, chunks, to, ("debug",), 1000)
    merged = spark.read.parquet(to).withColumn("f", F.input_file_name())
    return merged.crossJoin(F.broadcast(merged.agg(F.count_distinct("f").alias("files")))).select("o_orderkey", "o_custkey", "files")


@query("select 'nation' as source, n_nationkey as id, n_name as name from nation union all select 'region', r_regionkey, r_name from region")
def exported_tables(spark, sf_dir):
    """Two tables written together, the second time over the first: SNK4, SNK5."""
    path = scratch.folder(spark, "export")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    sources.export(path, nation=nation.limit(0), region=region.limit(0))
    sources.export(path, nation=nation, region=region)
    n = spark.read.parquet(f"{path}/nation").select(F.lit("nation").alias("source"), F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return n.unionByName(spark.read.parquet(f"{path}/region").select(F.lit("region").alias("source"), F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")))


@query("""select '["' || string_agg(t, '","' order by t) || '"]' as value from (select distinct p || event_type as t from events, (values ('B-'), ('I-')) v(p) union select 'O')""")
def label_list(spark, sf_dir):
    """The vocabulary of tags as JSON: SNK8, AGG11."""
    path = scratch.folder(spark, "labels")
    tags = table(spark, sf_dir, "events").select(F.array(F.lit("O"), F.concat(F.lit("B-"), "event_type"), F.concat(F.lit("I-"), "event_type")).alias("ner_tags"))
    sources.write_labels(ner.vocabulary(tags), path)
    return spark.read.text(path)


@query("select o_orderkey, case when cast('0x' || substr(md5('42|' || cast(o_orderkey as varchar)), 25, 8) as bigint) < 858993459 then 'test' else 'train' end as part from orders")
def train_test_split(spark, sf_dir):
    """Rows for training and testing, by their keys: SMP3."""
    train, test = sources.split_by_hash(orders(spark, sf_dir).select("o_orderkey"), "o_orderkey", 0.2)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


# ---------------------------------------------------------------- streams

_FILL = " ".join(["It tells at length what the firm did and why."] * 5)


@query(
    f"""select o_orderkey, case when o_orderkey % 3 = 0 then ['Second version of ' || cast(o_custkey as varchar) || '. {_FILL}'] else ['Head ' || cast(o_custkey as varchar) || ' goes on here.', '{_FILL}'] end as documents from orders where o_orderkey % 5 <> 0"""
)
def streamed_pages(spark, sf_dir):
    """Landed pages taken in by a stream, stopped, resumed with more pages and new versions: STR1, STR2, STR6, STR7, STR8."""
    landed, to, at = (scratch.folder(spark, n) for n in ("landed", "blocks", "stream"))
    first = F.when(key() % 5 == 0, "too short").otherwise(said("Head ", customer(), "\n\ngoes on here.\n\n***\n\n", _FILL))
    o = orders(spark, sf_dir)
    page = lambda text: o.select("o_orderkey", text.alias("raw"))
    schema = "o_orderkey bigint, raw string"

    def land(df) -> None:
        df.write.mode("append").parquet(landed)
        ingest.ingest(ingest.pages(spark, landed, schema, 2), "o_orderkey", "raw", to, at).awaitTermination()

    land(page(first).where("o_orderkey % 2 = 0"))
    left = ingest.remaining(page(first), spark, to, "o_orderkey")
    land(left)
    land(page(said("Second version of ", customer(), ". ", _FILL)).where("o_orderkey % 3 = 0 and o_orderkey % 5 <> 0"))
    return ingest.current(spark, to, "o_orderkey").select("o_orderkey", "documents")


@query("select event_id from events")
def streamed_keys(spark, sf_dir):
    """Keys of a stream that brings every event twice: STR9."""
    landed, to, at = (scratch.folder(spark, n) for n in ("events", "keys", "dedupe"))
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    e.unionByName(e).write.parquet(landed)
    stream = ingest.distinct_stream(spark.readStream.schema(e.schema).parquet(landed), "event_id", "ts", "3650 days")
    stream.writeStream.format("parquet").option("checkpointLocation", at).trigger(availableNow=True).start(to).awaitTermination()
    return spark.read.schema(e.schema).parquet(to).select("event_id")


# ---------------------------------------------------------------- names


@query(
    """select o_orderkey, case o_orderkey % 3 when 0 then '3M paid 2000000 to 7-Eleven' when 1 then 'Paid ' || cast(o_custkey % 90 + 1 as varchar) || '000000 to Forever 21' else 'nothing of 5%' end as out,
    case o_orderkey % 4 when 0 then 'the Company, and Acme Foods' when 1 then 'Sold by the Company.' when 2 then 'A+B is not AB' else 'none' end as replaced from orders"""
)
def firm_names(spark, sf_dir):
    """Names with numbers hidden while numbers are normalised, and a row's own firm as a token: NUM10, NUM11."""
    t = cycle(3, "3M paid two million to 7-Eleven", said("Paid ", customer() % 90 + 1, " million to Forever 21"), "nothing of five percent")
    text = cycle(4, "The Acme Steel Corp., and Acme Foods", "Sold by ACME  STEEL Inc.", "A+B is not AB", "none")
    name = cycle(4, "Acme Steel Corp.", "Acme Steel, Inc.", "A.B Co", "")
    return orders(spark, sf_dir).select("o_orderkey", firms.normalized(t, ("3M", "7-Eleven", "Forever 21")).alias("out"), firms.replaced(text, name).alias("replaced"))


@query()
def fuzzy_names(spark, sf_dir):
    """Names that are nearly alike, none missed: JN8. SQL has no matching blocks; a test compares all pairs of a small list."""
    p = scratch.stored(table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("name")).distinct(), "names")
    typed = p.select(F.regexp_replace(F.regexp_replace("name", "e", ""), "Brand", "brnd").alias("candidate")).where(F.xxhash64("candidate") % 2 == 0)
    return dictionary.fuzzy(typed, p, "candidate", "name", 0.9)


@query(
    """select o_orderkey, ['GB', 'US', 'FR', 'DE', 'JP'][o_orderkey % 5 + 1] as country, ['+44 20 7946 01' || p, '(212) 555-01' || p, '+33 1 23 45 67 ' || p, '+49 30 1234567', '+81 3-1234-56' || p][o_orderkey % 5 + 1] as text
    from (select o_orderkey, lpad(cast(o_custkey % 100 as varchar), 2, '0') as p from orders)"""
)
def phone_numbers(spark, sf_dir):
    """Phone numbers with their countries: EX15."""
    p = F.lpad((customer() % 100).cast("string"), 2, "0")
    t = cycle(5, said("Call +44 20 7946 01", p, " now"), said("Call (212) 555-01", p, " now"), said("Call +33 1 23 45 67 ", p, " now"), "Call +49 30 1234567 now", said("Call +81 3-1234-56", p, " now"))
    return orders(spark, sf_dir).select("o_orderkey", F.explode(phones.found(t)).alias("s")).select("o_orderkey", "s.country", "s.text")


@query(
    """select o_orderkey, unnest(case o_orderkey % 4 when 0 then ['energy', 'metals'] when 1 then ['energy'] when 2 then ['crops', 'livestock'] else [] end) as category,
    unnest(case o_orderkey % 4 when 0 then ['West Texas crude oil', 'copper'] when 1 then ['ultra-low sulfur diesel'] when 2 then ['wheat', 'live cattle'] else [] end) as text from orders"""
)
def commodity_names(spark, sf_dir):
    """Commodities and their categories: EX16."""
    t = cycle(4, "It hedges West Texas crude oil and copper.", "It buys ultra-low sulfur diesel in bulk.", "It sells wheat and live cattle.", "It sells silverware and leadership books.")
    return orders(spark, sf_dir).select("o_orderkey", F.explode(commodities.found(t)).alias("s")).select("o_orderkey", "s.category", "s.text")


#: A bracketed number from 1900 to 2099 is a year, so an order with such a key holds one span more, of a label that it has already.
_SLOTS = "case when o_orderkey between 1900 and 2099 then 8 else 7 end"


@query(f"with {RENDERED} select o_orderkey, {_SLOTS} as slot_count, 7 as label_count, len(regexp_extract_all(sentence, '[A-Za-z0-9_]+(?:[-''][A-Za-z0-9_]+)*|[^A-Za-z0-9_\\s]')) as n_words from rendered")
def ner_counts(spark, sf_dir):
    """Sentences cleaned, normalised, searched for spans and tagged: NER2, FLT8."""
    s = rendered.sentences(spark, sf_dir).unionByName(orders(spark, sf_dir).select("o_orderkey", F.when(key() % 2 == 0, "Nothing is here.").otherwise(" ").alias("sentence")))
    made = ner.process(s.repartition(4 * spark.sparkContext.defaultParallelism), "sentence", "o_orderkey")
    return made.select("o_orderkey", "slot_count", "label_count", F.size("words").alias("n_words"))


