"""Keyed tables: joins with the manifest, resuming, upserts, dedupe, rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_valid(url: Column) -> Column:
    return url.isNotNull() & (url != "")


def is_placeholder(url: Column, accession: Column) -> Column:
    """A row that stands for something searched for and not found."""
    return (F.coalesce(url, F.lit("")) == "") & accession.isNull()


def with_manifest(results: DataFrame, manifest: DataFrame, on: str = "accession") -> DataFrame:
    """Results with what the manifest knows of them; results it doesn't know stay."""
    return results.join(manifest, on, "left")


def with_names(results: DataFrame, manifest: DataFrame, names: DataFrame, settled: tuple[str, ...] = ("US", "CA")) -> DataFrame:
    """Results in the manifest whose country is open (none, or not a settled one), with the names of their firms."""
    open_ = F.col("home_country").isNull() | ~F.col("home_country").isin(*settled)
    return results.where(open_).join(manifest, "accession").join(names, "cik", "left")


def sync_years(manifest: DataFrame, results: DataFrame) -> DataFrame:
    """The manifest with years taken from the results' period of report, where that is a number and differs."""
    known = results.select("accession", "period_of_report")
    number = F.col("period_of_report").rlike(r"^\d{1,9}$")
    year = F.when(number, F.col("period_of_report").try_cast("int"))
    return manifest.join(known, "accession", "left").withColumn("year", F.coalesce(year, "year")).select(manifest.columns)


def not_done(wanted: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    """What is wanted and not done. Rows whose key has a null are never done and never wanted again."""
    present = wanted.where(" and ".join(f"{c} is not null" for c in on))
    return present.join(done.select(on).distinct(), on, "left_anti")


def smallest_id_of_each(df: DataFrame, key: str, row_id: str) -> DataFrame:
    """Of rows of equal key the one of smallest id; rows without a key all stay."""
    first = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(row_id).alias(row_id)).select(row_id)
    return df.where(F.col(key).isNull()).unionByName(df.where(F.col(key).isNotNull()).join(first, row_id, "left_semi"))


def upsert(target: DataFrame, batch: DataFrame, key: str, version: str) -> DataFrame:
    """Last write wins: of each key the row of the largest version; combined before the shuffle. Rows without a key go."""
    both = target.unionByName(batch).where(F.col(key).isNotNull())
    rest = [c for c in both.columns if c not in (key, version)]
    return both.groupBy(key).agg(F.max(F.struct(version, *rest)).alias("_row")).select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in both.columns])


def import_manifest(df: DataFrame) -> DataFrame:
    """Rows of a landed manifest, one per accession; placeholders one per firm and year."""
    key = F.coalesce(F.col("accession"), F.concat_ws("/", F.lit("none"), F.col("cik").cast("string"), F.col("year").cast("string")))
    rest = [c for c in df.columns if c != "accession"]
    return df.groupBy(key.alias("_key")).agg(F.min(F.struct(*rest, "accession")).alias("_row")).select(*[F.col(f"_row.{c}").alias(c) for c in df.columns])


def split_rejects(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(rows without a reason against them, the others with ``reason``)."""
    judged = df.withColumn("reason", reason)
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def append_new(table: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """The table and the batch's first row of each new key; rows without a key are appended as they are."""
    keyed = batch.where(F.col(key).isNotNull())
    rest = [c for c in batch.columns if c not in (key, order)]
    first = keyed.groupBy(key).agg(F.min(F.struct(order, *rest)).alias("_row")).select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in batch.columns])
    return table.unionByName(first.join(table.select(key), key, "left_anti").select(table.columns)).unionByName(batch.where(F.col(key).isNull()))


def summary(df: DataFrame, *columns: str) -> DataFrame:
    """(column, n, mean, sd, least, most): a row per numeric column, from one scan. Nulls don't count; without values only n is known."""
    stats = {"n": F.count, "mean": F.avg, "sd": F.stddev_samp, "least": F.min, "most": F.max}
    one = df.agg(*[F.struct(*[f(F.col(c).cast("double")).alias(n) for n, f in stats.items()]).alias(c) for c in columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("s")) for c in columns])).alias("x")).select("x.column", "x.s.*")


def missing_years(wanted: DataFrame, found: DataFrame) -> DataFrame:
    """Placeholder rows (empty url, no accession) for each firm and year that is wanted and not found."""
    gone = wanted.select("cik", "year").distinct().join(found.select("cik", "year").distinct(), ["cik", "year"], "left_anti")
    return gone.select("cik", "year", F.lit("").alias("url"), F.lit(None).cast("string").alias("accession"))
