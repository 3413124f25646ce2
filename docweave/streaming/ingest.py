"""Incremental ingestion: landed pages become blocks in a keyed table, micro-batch by micro-batch.

Pages are files of a stream (``maxFilesPerTrigger`` is the back-pressure). Each micro-batch is parsed with the batch
operators and written by ``foreachBatch`` into a folder of its own, named by the batch's number: a batch that is run again
after a failure replaces its folder, so every page is in the table once per batch. Readers take the last version of a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from docweave.operators import documents as dc
from docweave.streaming.keyed import Store


def parsed(pages: DataFrame, key: str, raw: str) -> DataFrame:
    """(key, documents): an array of blocks per page; pages without text, and those too short, go."""
    return pages.where(dc.long_enough(F.col(raw))).select(key, dc.blocks_of(F.col(raw)).alias("documents")).where(F.size("documents") > 0)


def dealt(batch: DataFrame, key: str) -> DataFrame:
    """A micro-batch's pages on all cores: its files are few, and a file is often one task, however many pages it has."""
    return batch.repartition(batch.sparkSession.sparkContext.defaultParallelism, key)


def pages(spark: SparkSession, path: str, schema: StructType | str, files: int = 100) -> DataFrame:
    """A stream of landed Parquet pages, so many files a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def ingest(stream: DataFrame, key: str, raw: str, table: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Start writing the stream's blocks to ``table``; without an ``interval`` what has landed is taken and the query ends."""

    def write(batch: DataFrame, number: int) -> None:
        parsed(dealt(batch, key), key, raw).write.mode("overwrite").parquet(f"{table}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def ingest_into(stream: DataFrame, key: str, raw: str, store: Store, checkpoint: str, interval: str | None = None, compact_every: int = 50) -> StreamingQuery:
    """As ``ingest``, into a keyed store, which is compacted after so many batches: what readers merge stays bounded."""

    def write(batch: DataFrame, number: int) -> None:
        store.append(parsed(dealt(batch, key), key, raw), number)
        if len(store.version()["batches"]) >= compact_every:
            store.compact()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def current(spark: SparkSession, table: str, key: str) -> DataFrame:
    """The table's rows, the last batch's for each key."""
    last = Window.partitionBy(key).orderBy(F.col("batch").desc())
    rows = spark.read.parquet(table)
    return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", "batch")


def remaining(pages_: DataFrame, spark: SparkSession, table: str, key: str) -> DataFrame:
    """Pages whose key the table doesn't have: what a resumed run still has to do. A null key is never done."""
    return pages_.join(spark.read.parquet(table).select(key).distinct(), key, "left_anti")


def distinct_stream(stream: DataFrame, key: str, time: str, late: str = "1 day") -> DataFrame:
    """A stream without repeats of a key that come within ``late`` of each other: state is bounded by the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
