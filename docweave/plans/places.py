"""Queries of the places that texts name."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.operators import dictionary, gazetteer
from docweave.plans.corpus import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _own_places(spark, sf_dir):
    """A gazetteer of the tables' own nations and regions."""
    null = F.lit(None).cast("string")
    r = table(spark, sf_dir, "region")
    n = table(spark, sf_dir, "nation").join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))
    nations = n.select(F.col("n_name").alias("phrase"), F.lit("nation").alias("kind"), F.col("r_name").alias("region"), F.col("n_name").alias("nation"), null.alias("state"), null.alias("city"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"))
    regions = r.select(F.col("r_name").alias("phrase"), F.lit("region").alias("kind"), F.col("r_name").alias("region"), null.alias("nation"), null.alias("state"), null.alias("city"), F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("code"))
    return nations.unionByName(regions)


_HITS = """
with t as (select c_custkey, n_name, r_name, n_nationkey, r_regionkey, 'Customer ' || cast(c_custkey as varchar) || ' buys in ' as head from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
select c_custkey, cast(length(head) as integer) as start, cast(length(head) + length(n_name) as integer) as "end", n_name as phrase, 'nation' as kind, r_name as region, n_name as nation, null::varchar as state, null::varchar as city, 'N' || cast(n_nationkey as varchar) as code from t
union all
select c_custkey, cast(length(head) + length(n_name) + 12 as integer), cast(length(head) + length(n_name) + 12 + length(r_name) as integer), r_name, 'region', r_name, null, null, null, 'R' || cast(r_regionkey as varchar) from t
"""


def _placed(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    c = table(spark, sf_dir, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    text = F.concat(F.lit("Customer "), F.col("c_custkey").cast("string"), F.lit(" buys in "), F.initcap("n_name"), F.lit(", elsewhere "), F.lower("r_name"), F.lit(" and x"), "n_name", F.lit("."))
    return c.select("c_custkey", text.alias("text"))


@query(_HITS)
def place_hits(spark, sf_dir):
    """Nations and regions that texts name, by a trie that every task gets: JN7, GEO1. What only holds a name is none."""
    return gazetteer.located(_placed(spark, sf_dir), "c_custkey", "text", _own_places(spark, sf_dir))


@query(_HITS)
def place_hits_joined(spark, sf_dir):
    """The same where the list is too long for a trie: JN7."""
    return dictionary.hits(_placed(spark, sf_dir), "c_custkey", "text", _own_places(spark, sf_dir), most_phrases=10)


@query(
    """select c_custkey, n, kind, region, nation, state, city, code from customer cross join (values (0, null, null, null, null, null, null), (1, 'state', 'North America', 'United States', 'Texas', null, 'US'), (2, 'city', 'Europe', 'France', null, 'Paris', 'FR'),
    (3, 'region', 'Europe', null, null, null, 'EU'), (4, 'city', 'North America', 'Canada', 'Ontario', 'Toronto', 'CA'), (5, 'nation', 'Asia', 'Singapore', null, null, 'SG')) v(n, kind, region, nation, state, city, code) where n = c_custkey % 6"""
)
def place_lookup(spark, sf_dir):
    """The place that a name means: GEO1."""
    c = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 6).cast("int").alias("n"))
    names = F.array(*map(F.lit, ("Nowhere", "TEXAS", " Paris ", "european union", "Toronto", "singapore")))
    return gazetteer.looked_up(c.withColumn("name", names[F.col("n")]), "name", gazetteer.gazetteer(spark)).drop("name")


@query(
    """with t as (select c_custkey, c_custkey % 5 as k, cast(c_custkey % 700 + 3 as varchar) as n from customer),
    s as (
      select c_custkey, 'We run 900 plants. Of these plants, ' as head, n || ' in Texas' as text, 'LOCATION_COUNT' as label, 'North America' as region, 'United States' as nation, 'Texas' as state, null as city, 'US' as code from t where k = 0
      union all select c_custkey, 'Of the employees of our plants, ', n || ' are located in Latin America', 'LABOR', 'Latin America', null, null, null, 'LATAM' from t where k = 1
      union all select c_custkey, 'Offices: ', n || ' in the United Kingdom', 'LOCATION_COUNT', 'Europe', 'United Kingdom', null, null, 'GB' from t where k = 3
      union all select c_custkey, 'Offices: ' || n || ' in the United Kingdom and ', '3.5 in Toronto', 'LOCATION_COUNT', 'North America', 'Canada', 'Ontario', 'Toronto', 'CA' from t where k = 3)
    select c_custkey, cast(length(head) as integer) as start, cast(length(head) + length(text) as integer) as "end", label, text, region, nation, state, city, code from s"""
)
def place_counts(spark, sf_dir):
    """Numbers of sites and workers in places: EX6, JN7."""
    n = (F.col("c_custkey") % 700 + 3).cast("string")
    said = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    texts = F.array(
        said("We run 900 plants. Of these plants, ", n, " in Texas."),
        said("Of the employees of our plants, ", n, " are located in Latin America."),
        said("Our plants are old. There were ", n, " in France."),
        said("Offices: ", n, " in the United Kingdom and 3.5 in Toronto."),
        said("Our offices: ", n, " inTexas, Texas ", n, " and Lower Texasville."),
    )
    c = table(spark, sf_dir, "customer").select("c_custkey", texts[(F.col("c_custkey") % 5).cast("int")].alias("text"))
    return gazetteer.counts(c, "c_custkey", "text")
