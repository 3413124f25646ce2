"""The keyed store: the same rows before, during and after a compaction, repeats of batches, pruned reads."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docweave.streaming import ingest
from docweave.streaming.keyed import Store

SCHEMA = "v string, k long, n int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def batch(spark, keys, name):
    return spark.createDataFrame([(f"{name}{k}", k, i) for i, k in enumerate(keys)], SCHEMA)


def test_compaction_changes_no_row(spark, tmp_path, monkeypatch):
    store = Store(spark, f"{tmp_path}/s", "k", SCHEMA, buckets=4)
    assert rows(store.current()) == [] and not store.compact()
    assert store.append(batch(spark, [1, 2, None, 5], "a"), 0) and store.append(batch(spark, [2, 3, None, 3], "b"), 1)
    assert not store.append(batch(spark, [9], "again"), 1)
    want = [("a1", 1, 0), ("a5", 5, 3), ("b2", 2, 0), ("b3", 3, 3), ("bNone", None, 2)]
    assert rows(store.current()) == want
    # a compaction that stops when its rows are written and its version isn't made
    monkeypatch.setattr(store, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        store.compact()
    monkeypatch.undo()
    again = Store(spark, f"{tmp_path}/s", "k", SCHEMA)
    assert again.buckets == 4 and rows(again.current()) == want
    # a batch that comes while a compaction writes stays live
    write, late = again._write, []

    def and_append(df, folder):
        write(df, folder)
        if folder.startswith("base") and not late:
            late.append(again.append(batch(spark, [5, 6], "c"), 2))

    monkeypatch.setattr(again, "_write", and_append)
    assert again.compact() and late == [True]
    want = [("a1", 1, 0), ("b2", 2, 0), ("b3", 3, 3), ("bNone", None, 2), ("c5", 5, 0), ("c6", 6, 1)]
    assert rows(again.current()) == want and [n for n, _ in again.version()["batches"]] == [2]
    assert not again.append(batch(spark, [1], "again"), 0)
    assert again.compact() and rows(again.current()) == want
    plan = again.current()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert rows(again.current(keys=[5, None, 77])) == [("bNone", None, 2), ("c5", 5, 0)]
    pruned = again.current(keys=[5])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in pruned and "_bucket" in pruned.split("PartitionFilters", 1)[1].split("]")[0]
    assert again.vacuum(keep=1) >= 3 and rows(again.current()) == want


def test_one_of_two_writers(spark, tmp_path):
    one, two = (Store(spark, f"{tmp_path}/s", "k", SCHEMA, buckets=2) for _ in range(2))
    number = one.version()["number"] + 1
    assert one._publish(number, one.version()) and not two._publish(number, two.version())
    assert two.append(batch(spark, [1], "x"), 4) and not one.append(batch(spark, [1], "y"), 4) and rows(one.current()) == [("x1", 1, 0)]


def test_a_stream_into_the_store(spark, tmp_path):
    pages = spark.range(12).select("id", F.concat(F.lit("head "), F.col("id").cast("string"), F.repeat(F.lit(" word"), 60)).alias("raw"))
    store = Store(spark, f"{tmp_path}/s", "id", "id bigint, documents array<string>", buckets=2)
    for part in ("id < 8", "id >= 4"):
        pages.where(part).coalesce(2).write.mode("append").parquet(f"{tmp_path}/in")
        ingest.ingest_into(ingest.pages(spark, f"{tmp_path}/in", "id bigint, raw string", 1), "id", "raw", store, f"{tmp_path}/at").awaitTermination()
    assert store.current().count() == 12 and store.compact() and store.current().count() == 12
