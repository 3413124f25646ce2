"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

1. Sizes: words per document, summed by source and by hash bucket within the source (map-side combined).
2. Targets: sources share all words by weight; one whose share exceeds ``max_epochs`` times its size is clamped there and
   the excess is shared again among the others by weight, until none is above. Each round is two sums over the table of
   sources; two numbers come to the driver.
3. The mix: a source takes every document whole floor(target / size) times; of the remaining words it takes whole
   documents in a seeded order, and of the last one only as many words as are still missing. So each source comes within
   one word of its target, and no document is taken more than ``max_epochs`` times.

The seeded order is that of md5(seed, key). Running totals go by bucket (the first three hex digits) and then within a
bucket, so a source that holds most of the rows is spread over 4096 groups: a third of ten billion documents is 800,000 a group. All sums are of whole numbers: reruns and
other partitionings agree.

Null and empty texts have size 0 and are taken 0 times. The null source is a source like any other and comes last in
code-point order. Equal rows are taken separately; rows with equal keys are ordered by size. Without words every target is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.common import settle, text_of

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Hex digits of the draw that make a bucket of a source.
BUCKET_DIGITS = 3


def words(text: Column) -> Column:
    """The number of words; white space is ASCII white space."""
    parts = F.split(text, r"[\x20\x09-\x0D]+")
    return (F.size(parts) - (F.element_at(parts, 1) == "").cast("int") - ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")).cast("long")


def _ordered(sources: DataFrame) -> DataFrame:
    """Adds ``_rank``, a source's place in code-point order (null last), without gathering the sources in one task."""
    ranged = settle(sources.repartitionByRange(F.col("_source").asc_nulls_last()).withColumn("_part", F.spark_partition_id()), "sources")
    sizes = ranged.groupBy("_part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row per partition
    own = Window.partitionBy("_part").orderBy(F.col("_source").asc_nulls_last())
    return ranged.withColumn("_row", F.row_number().over(own) - 1).join(sizes.select("_part", before.alias("_before")), "_part").withColumn("_rank", F.col("_before") + F.col("_row")).drop("_part", "_row", "_before")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Water-filling over (``_source``, ``source_size``): adds ``target`` (double) and ``_words``, the target in whole words."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights)).cast("int") + 1).cast("long")
    table = settle(_ordered(sources).withColumn("_w", weight).withColumn("_cap", F.col("source_size") * max_epochs), "targets")
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    rest, free = total, table.agg(F.coalesce(F.sum("_w"), F.lit(0))).first()[0]
    # a source is clamped if its share of what the others leave is above its cap: whole numbers, cap * free < rest * weight
    while True:
        over = F.col("_cap").cast("decimal(38,0)") * F.lit(free).cast("decimal(38,0)") < F.lit(rest).cast("decimal(38,0)") * F.col("_w").cast("decimal(38,0)")
        clamped = table.where(over).agg(F.coalesce(F.sum("_cap"), F.lit(0)), F.coalesce(F.sum("_w"), F.lit(0))).first()
        now = total - clamped[0], table.agg(F.sum("_w")).first()[0] - clamped[1] if clamped[1] else free
        if now == (rest, free) or not clamped[1]:
            break
        rest, free = now
    share = F.lit(rest).cast("long") * F.col("_w")
    whole = F.expr(f"({rest}L * _w) div {max(free, 1)}L")
    return table.select(
        "_source",
        "source_size",
        F.when(over, F.col("_cap").cast("double")).otherwise(share.cast("double") / F.lit(float(max(free, 1)))).alias("target"),
        F.when(over, F.col("_cap")).otherwise(whole).alias("_words"),
    )


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED, keep: tuple[str, ...] = (), prefix: str = "") -> DataFrame:
    """(key, *keep, source, size, source_size, target, taken): how many words of each document the mix takes.

    ``prefix`` goes before the last four names; with one that no kept column begins with, columns may be called like anything.
    """
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    own = [F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(keep)]
    named = [F.col(f"`{key}`").alias("_id"), *own, F.col(f"`{source}`").alias("_source")]
    sized = settle(df.select(*named, words(text_of(text)).alias("size"), drawn.alias("_draw")), "sizes")
    sized = sized.withColumn("_key", F.when(F.col("_source").isNull(), "n").otherwise(F.concat(F.lit("s"), "_source"))).withColumn("_bucket", F.substring("_draw", 1, BUCKET_DIGITS))
    buckets = sized.groupBy("_key", "_source", "_bucket").agg(F.sum("size").alias("_sum"))
    aims = targets(buckets.groupBy("_source").agg(F.sum("_sum").alias("source_size")), weights, max_epochs)
    aims = aims.withColumn("_key", F.when(F.col("_source").isNull(), "n").otherwise(F.concat(F.lit("s"), "_source"))).drop("_source")
    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = buckets.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).join(aims, "_key").drop("_source", "_sum")
    within = Window.partitionBy("_key", "_bucket").orderBy("_draw", F.col("_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("size").over(within), F.lit(0))
    joined = sized.withColumn("_ahead", ahead).join(plan, ["_key", "_bucket"])
    whole = F.expr("coalesce(_words div nullif(source_size, 0), 0)")
    part = F.expr("coalesce(_words % nullif(source_size, 0), 0)") - F.col("_before") - F.col("_ahead")
    taken = whole * F.col("size") + F.least(F.col("size"), F.greatest(part, F.lit(0)))
    found = {"size": F.col("size"), "source_size": F.col("source_size"), "target": F.col("target"), "taken": taken.cast("long")}
    kept = [F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)]
    return joined.select(F.col("_id").alias(key), *kept, F.col("_source").alias(source), *[c.alias(prefix + n) for n, c in found.items()])


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents mixed: sources weigh 5, 2, 1 in turn and are repeated three times at most."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


OP7_SQL = """
with sized as (
  select doc_id, source, md5('mix-1:' || coalesce(cast(doc_id as varchar), 'null')) as draw,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) as size
  from documents),
sources as (
  select source, sum(size)::hugeint as source_size, row_number() over (order by source nulls last) - 1 as place
  from sized group by source),
weighed as (select *, (case place % 3 when 0 then 5 when 1 then 2 else 1 end)::hugeint as w from sources),
filled as (
  select *, sum(source_size) over () as total,
    coalesce(sum(3 * source_size) over low, 0) as caps_below, sum(w) over () - coalesce(sum(w) over low, 0) as w_left
  from weighed
  window low as (order by source_size::double / w, place rows between unbounded preceding and 1 preceding)),
clamps as (select *, 3 * source_size * w_left < (total - caps_below) * w as clamped from filled),
levels as (
  select max(total) - coalesce(sum(3 * source_size) filter (clamped), 0) as rest,
    sum(w) - coalesce(sum(w) filter (clamped), 0) as free from clamps),
aims as (
  select source, source_size, case when clamped then (3 * source_size)::double else (rest * w)::double / free::double end as target,
    case when clamped then 3 * source_size else (rest * w) // free end as words
  from clamps, levels),
ordered as (
  select s.*, a.source_size, a.target, a.words,
    coalesce(sum(size) over (partition by s.source order by draw, doc_id, size rows between unbounded preceding and 1 preceding), 0) as ahead
  from sized s join aims a on s.source is not distinct from a.source)
select doc_id, source, size::bigint as size, source_size::bigint as source_size, target,
  (case when source_size = 0 then 0 else (words // source_size) * size + least(size, greatest(words % source_size - ahead, 0)) end)::bigint as taken
from ordered
"""
