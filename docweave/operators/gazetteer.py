"""Places: nations, their states and cities, and the regions they lie in; where texts name them, and what is counted there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions import vocabulary as v
from docweave.functions.find import let
from docweave.functions.patterns import NUMBER, any_of
from docweave.functions.places import place_rows
from docweave.operators.dictionary import hits

COLUMNS = ("phrase", "kind", "region", "nation", "state", "city", "code")
_SCHEMA = ", ".join(f"{c} string" for c in COLUMNS)

def gazetteer(spark: SparkSession) -> DataFrame:
    """(phrase, kind, region, nation, state, city, code) of the places known here; kind is region, nation, state or city."""
    return spark.createDataFrame(place_rows(), _SCHEMA)


def flattened(nested: DataFrame) -> DataFrame:
    """The same from a nested list: (name, code, region, phrases, locations: array of (name, phrases, cities: array of (name, phrases)))."""
    own = lambda name, phrases: F.array_distinct(F.concat(F.array(name), F.coalesce(phrases, F.array().cast("array<string>"))))
    null = F.lit(None).cast("string")
    nation = [F.col("region"), F.col("name").alias("nation")]
    nations = nested.select(F.explode(own(F.col("name"), F.col("phrases"))).alias("phrase"), F.lit("nation").alias("kind"), *nation, null.alias("state"), null.alias("city"), "code")
    states = nested.select("region", "name", "code", F.explode("locations").alias("s"))
    named = states.select(F.explode(own(F.col("s.name"), F.col("s.phrases"))).alias("phrase"), F.lit("state").alias("kind"), *nation, F.col("s.name").alias("state"), null.alias("city"), "code")
    cities = states.select("region", "name", "code", F.col("s.name").alias("state"), F.explode("s.cities").alias("c"))
    inside = cities.select(F.explode(own(F.col("c.name"), F.col("c.phrases"))).alias("phrase"), F.lit("city").alias("kind"), *nation, "state", F.col("c.name").alias("city"), "code")
    return nations.unionByName(named).unionByName(inside)


def looked_up(df: DataFrame, name: str, places: DataFrame) -> DataFrame:
    """Adds kind, region, nation, state, city and code of the place that a column names, whatever its case; nulls where it names none.

    Of several places of one name the first by kind (nation, region, state, city in this order) and code counts.
    """
    order = F.array_position(F.array(*map(F.lit, ("nation", "region", "state", "city"))), F.col("kind"))
    own = places.groupBy(F.lower("phrase").alias("_name")).agg(F.min(F.struct(order.alias("o"), "code", "kind", "region", "nation", "state", "city")).alias("_p"))
    found = df.join(own, F.lower(F.trim(name)) == F.col("_name"), "left")
    return found.select(*df.columns, *[F.col(f"_p.{c}") for c in ("kind", "region", "nation", "state", "city", "code")])


def located(df: DataFrame, key: str, text: str, places: DataFrame | None = None) -> DataFrame:
    """(key, start, end, phrase, kind, region, nation, state, city, code): the places that texts name, the longest names first."""
    return hits(df, key, text, places if places is not None else gazetteer(df.sparkSession))


_BEFORE = rf"(?<![\w.,$])({NUMBER}\s+(?:(?:are|were|is|was|located|based)\s+)*in\s+(?:the\s+)?)$"
_WORKER = rf"(?i)\b{any_of(v.WORKERS)}s?\b"
_SITE = rf"(?i)\b{any_of(v.SITES)}s?\b"
#: How many characters before a place its number may begin.
_REACH = 60


def _sentence(text: Column, start: Column, end: Column) -> Column:
    """What is between the nearest full stops, question and exclamation marks around a span; a mark inside a number ends nothing."""
    marks = r"[.!?](?!\d)"
    head = F.element_at(F.split(F.substring(text, F.lit(1), start), marks), -1)
    tail = F.split(F.substring(text, start + 1, F.length(text)), marks, 2)[0]
    return F.concat(head, tail)


def counts(df: DataFrame, key: str, text: str, places: DataFrame | None = None) -> DataFrame:
    """(key, start, end, label, text, region, nation, state, city, code): "n in Place" as LOCATION_COUNT, or LABOR.

    Only sentences that say what kind of place (a plant, an office) is counted have such counts; where workers are named too,
    it is them who are counted.
    """
    near = located(df, key, text, places).join(df.select(key, F.col(text).alias("_text")), key)
    before = F.substring("_text", F.greatest(F.col("start") - _REACH, F.lit(0)) + 1, F.least(F.col("start"), F.lit(_REACH)))
    own = near.withColumn("_number", F.regexp_extract(before, _BEFORE, 1)).where("_number <> ''")
    own = own.withColumn("_from", F.col("start") - F.length("_number")).withColumn("_sentence", let(F.col("_text"), lambda t: _sentence(t, F.col("_from"), F.col("end"))))
    label = F.when(F.col("_sentence").rlike(_WORKER), "LABOR").otherwise("LOCATION_COUNT")
    own = own.where(F.col("_sentence").rlike(_SITE))
    return own.select(key, F.col("_from").alias("start"), "end", label.alias("label"), F.expr("substring(_text, _from + 1, end - _from)").alias("text"), "region", "nation", "state", "city", "code")
