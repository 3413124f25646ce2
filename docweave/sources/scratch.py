"""A folder for tables that a query writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []


def folder(spark: SparkSession, name: str) -> str:
    """A new folder inside ``spark.checkpoint.dir``, which all executors share; where that is unset and all runs on one machine, a temporary one."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir")
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _LOCAL:
            _LOCAL.append(tempfile.mkdtemp(prefix="docweave-tables-"))
        root = _LOCAL[0]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: what reads it several times doesn't compute it again, and a lost executor costs a re-read."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
