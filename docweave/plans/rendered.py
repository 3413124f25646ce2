"""Sentences rendered from the order table: inputs for the span operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, sentence)"""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = F.concat(
        F.lit("Order "),
        F.col("o_orderkey").cast("string"),
        F.lit(" was placed on "),
        F.date_format("o_orderdate", "MMMM d, yyyy"),
        F.lit(" for $"),
        F.col("o_totalprice").cast("decimal(14,2)").cast("string"),
        F.lit(" under Note "),
        (F.col("o_custkey") % 40 + 1).cast("string"),
        F.lit(". The price rose by "),
        (F.col("o_custkey") % 30 + 1).cast("string"),
        F.lit("% in volume of "),
        (F.col("o_orderkey") % 900 + 10).cast("string"),
        F.lit(" kilograms. We had "),
        (F.col("o_custkey") % 5000 + 20).cast("string"),
        F.lit(" employees and issued "),
        (F.col("o_orderkey") % 7000 + 100).cast("string"),
        F.lit(" shares of common stock."),
    )
    return o.select("o_orderkey", text.alias("sentence"))
