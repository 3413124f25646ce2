"""What training tasks need of the data: packed blocks, label ids, labels for sub-words, scores of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.sources.scratch import stored


def label_ids(df: DataFrame, label: str) -> DataFrame:
    """(label, label_id): distinct labels numbered in order. Labels are a small vocabulary."""
    return df.where(F.col(label).isNotNull()).select(label).distinct().withColumn("label_id", F.row_number().over(Window.orderBy(label)) - 1)


def packed_blocks(df: DataFrame, ids: str, batch: Column, order: list[str], size: int) -> DataFrame:
    """(batch, block, ids): the token ids of each batch, in order, cut into blocks of ``size``; what is left over goes.

    ``batch`` bounds what is put together; a row's ids may fall into several blocks.
    """
    before = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = df.withColumn("_b", batch).withColumn("_at", F.coalesce(F.sum(F.size(ids)).over(before), F.lit(0)))
    first, last = F.floor(F.col("_at") / size), F.floor((F.col("_at") + F.size(ids) - 1) / size)
    parts = placed.where(F.size(ids) > 0).withColumn("block", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("block") * size - F.col("_at"), F.lit(0))
    end = F.least((F.col("block") + 1) * size - F.col("_at"), F.size(ids))
    cut = parts.select(F.col("_b").alias("batch"), "block", "_at", F.slice(ids, (start + 1).cast("int"), (end - start).cast("int")).alias("part"))
    joined = cut.groupBy("batch", "block").agg(F.array_sort(F.collect_list(F.struct("_at", "part"))).alias("parts"))
    return joined.select("batch", "block", F.flatten(F.transform("parts", lambda p: p["part"])).alias("ids")).where(F.size("ids") == size)


#: Rows that one bucket of the corpus-wide order holds, about.
BUCKET_ROWS = 1_000_000


def offsets(df: DataFrame, size: Column, order: list[str], bucket_rows: int = BUCKET_ROWS, to: str = "at") -> DataFrame:
    """Adds the sum of the sizes of all rows before a row, over the whole table in the order of ``order``.

    Two levels: rows are dealt into ranges of the order and written, so that a range is what it is; the ranges' sums are added
    up (a row per range), and each range adds its own up from there. No window holds more than a range. Rows that the order
    doesn't tell apart come in any one order, which then stays; a null size counts as 0.
    """
    ranges = max(1, -(-df.count() // bucket_rows))
    sized = df.withColumn("_size", F.greatest(F.coalesce(size.cast("long"), F.lit(0).cast("long")), F.lit(0).cast("long")))
    dealt = sized.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    kept = stored(dealt, "ranges")
    sums = kept.groupBy("_range").agg(F.sum("_size").alias("_sum"))
    start = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_range", F.coalesce(F.sum("_sum").over(start), F.lit(0)).alias("_start"))
    own = Window.partitionBy("_range").orderBy(*order, "_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = kept.join(F.broadcast(starts), "_range")  # a row per range
    return placed.withColumn(to, F.col("_start") + F.coalesce(F.sum("_size").over(own), F.lit(0))).drop("_range", "_row", "_size", "_start")


def stream_blocks(df: DataFrame, ids: str, order: list[str], size: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(block, ids): the token ids of all rows, in order, as one sequence cut into blocks of ``size``; what is left over at its end goes."""
    placed = offsets(df.select(ids, *[c for c in order if c != ids]), F.size(ids), order, bucket_rows, "_at").where(F.size(ids) > 0)
    first, last = F.floor(F.col("_at") / size), F.floor((F.col("_at") + F.size(ids) - 1) / size)
    parts = placed.withColumn("block", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("block") * size - F.col("_at"), F.lit(0))
    end = F.least((F.col("block") + 1) * size - F.col("_at"), F.size(ids))
    cut = parts.select("block", "_at", F.slice(ids, (start + 1).cast("int"), (end - start).cast("int")).alias("part"))
    joined = cut.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("_at", "part"))).alias("parts"))
    return joined.select("block", F.flatten(F.transform("parts", lambda p: p["part"])).alias("ids")).where(F.size("ids") == size)


def subword_labels(labels: Column, word_of: Column, ignore: int = -100) -> Column:
    """A label per sub-word: the word's at its first, ``ignore`` at the others and where there is no word.

    ``word_of``: for each sub-word the number of its word from 0, or null.
    """
    return F.transform(
        word_of,
        lambda w, i: F.when(w.isNull() | ((i > 0) & (F.get(word_of, i - 1).eqNullSafe(w))), F.lit(ignore)).otherwise(F.get(labels, w)),
    )


def entity_scores(gold: DataFrame, predicted: DataFrame, on: list[str], label: str = "label") -> DataFrame:
    """(label, precision, recall, f1): of exact spans; rows of both sides are (``on``, label)."""
    keys = [*on, label]
    both = gold.select(*keys).distinct().withColumn("g", F.lit(1)).join(predicted.select(*keys).distinct().withColumn("p", F.lit(1)), keys, "full")
    n = both.groupBy(label).agg(F.count("g").alias("g"), F.count("p").alias("p"), F.sum(F.when(F.col("g").isNotNull() & F.col("p").isNotNull(), 1).otherwise(0)).alias("hit"))
    precision, recall = F.col("hit") / F.greatest("p", F.lit(1)), F.col("hit") / F.greatest("g", F.lit(1))
    return n.select(label, precision.alias("precision"), recall.alias("recall"), (2 * F.col("hit") / F.greatest(F.col("p") + F.col("g"), F.lit(1))).alias("f1"))
