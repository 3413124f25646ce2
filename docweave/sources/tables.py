"""Reading landed data: CSV, Parquet, JSON, pages; and writing it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.schema import SUBMISSIONS, require

# The forms that are annual reports.
ANNUAL_FORMS = ("10-K", "10-K405", "10-KSB", "10-KT", "10-K/A", "20-F", "40-F")
#: Words that a firm's shortened name doesn't end with.
OPEN_ENDS = ("of", "and", "&", "for")


def firms(spark: SparkSession, path: str) -> DataFrame:
    """A CSV list of firms; it must have ``cik``."""
    return require(spark.read.csv(path, header=True), "cik").withColumn("cik", F.col("cik").cast("bigint"))


def name_prefixes(names: DataFrame, name: str = "core_name") -> DataFrame:
    """Distinct firm names of three characters or more, and their prefixes of two words or more that end well."""
    trimmed = names.where(F.col(name).isNotNull()).select(F.trim(name).alias("phrase")).where(F.length("phrase") >= 3)
    words = F.split("phrase", r"\s+")
    shorter = F.when(F.size(words) > 2, F.transform(F.sequence(F.lit(2), F.size(words) - 1), lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))).otherwise(F.array().cast("array<string>"))
    ends = "|".join(OPEN_ENDS)
    good = F.filter(shorter, lambda p: ~F.lower(p).rlike(rf" (?:{ends})$"))
    return trimmed.select(F.explode(F.concat(F.array("phrase"), good)).alias("phrase")).distinct()


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet manifest; it must have cik, year and url, the other columns may be missing."""
    found = require(spark.read.parquet(path), "cik", "year", "url")
    for extra in ("accession", "original_url"):
        if extra not in found.columns:
            found = found.withColumn(extra, F.lit(None).cast("string"))
    return found


def query(spark: SparkSession, sql: str, head: int = 0) -> DataFrame:
    """Any SQL; the first ``head`` rows of it if that is positive."""
    found = spark.sql(sql)
    return found.limit(head) if head > 0 else found


def filings(submissions: DataFrame, host: str = "https://www.sec.gov/Archives/edgar/data") -> DataFrame:
    """A row per annual filing of each submissions document (``cik``, ``body`` as JSON text)."""
    parsed = submissions.select("cik", F.from_json("body", SUBMISSIONS).alias("b"))
    rows = parsed.select("cik", F.col("b.name").alias("name"), F.explode(F.arrays_zip("b.filings.recent.form", "b.filings.recent.accessionNumber", "b.filings.recent.primaryDocument", "b.filings.recent.filingDate", "b.filings.recent.reportDate")).alias("f"))
    dashed, doc = F.col("f.accessionNumber"), F.col("f.primaryDocument")
    plain = F.regexp_replace(dashed, "-", "")
    folder = F.concat_ws("/", F.lit(host), F.col("cik").cast("string"), plain)
    whole = doc.isNull() | (doc == "") | doc.endswith(".txt") | doc.endswith("0001.htm")
    url = F.concat_ws("/", folder, F.when(whole, F.concat(dashed, F.lit(".txt"))).otherwise(doc))
    return rows.where(F.col("f.form").isin(*ANNUAL_FORMS)).select("cik", "name", F.col("f.form").alias("form"), plain.alias("accession"), url.alias("url"), F.col("f.filingDate").alias("filing_date"), F.col("f.reportDate").alias("report_date"))


def all_filings(recent: DataFrame, older: DataFrame) -> DataFrame:
    return recent.unionByName(older)


def for_year(df: DataFrame, year: str, report_date: str = "report_date") -> DataFrame:
    return df.where(F.col(report_date).startswith(year))


def string_array(column: Column) -> Column:
    """JSON text as an array of strings; null where it isn't one."""
    return F.from_json(column, "array<string>")


def split_by_hash(df: DataFrame, key: str, test: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test): a row's place depends on its key alone; rows without a key are all in train."""
    place = F.col(key).isNotNull() & (tx.decided(F.lit(seed), F.col(key)) < int(test * (1 << 32)))
    return df.where(~place), df.where(place)


def write_chunks(df: DataFrame, path: str, rows: int) -> None:
    """Parquet files of at most so many rows."""
    df.write.mode("append").option("maxRecordsPerFile", rows).parquet(path)


def merge_chunks(spark: SparkSession, path: str, to: str, drop: tuple[str, ...] = (), rows: int = 1_000_000) -> None:
    """Chunks as files of so many rows (one has the rest), without columns kept for debugging.

    Rows are numbered as they are read: by the task's place, from what the tasks before it have, and their own. Each writing task
    gets whole files of them, some for each core and not one task for each file.
    """
    found = spark.read.parquet(path).drop(*drop)
    read = found.withColumn("_task", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    # a row for each task that reads: a few thousand, however many rows there are
    counts = sorted(read.groupBy("_task").count().collect())
    total, starts = 0, []
    for task, count in counts:
        starts.append((task, total))
        total += count
    files = max(1, -(-total // rows))
    writers = min(files, 2 * spark.sparkContext.defaultParallelism)
    each = -(-files // writers) * rows
    before = F.broadcast(spark.createDataFrame(starts, "_task int, _before long"))
    dealt = read.join(before, "_task").withColumn("_to", F.floor((F.col("_before") + F.col("_row")) / each).cast("int"))
    dealt.repartitionById(writers, "_to").drop("_task", "_row", "_before", "_to").write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(to)


def export(path: str, **named: DataFrame) -> None:
    """Several tables, each a folder of Parquet files under a path."""
    for name, df in named.items():
        replace_table(df, f"{path}/{name}")


def write_labels(tags: DataFrame, path: str) -> None:
    """A small vocabulary (one column, a row each) as one line of JSON, in order."""
    column = F.col(tags.columns[0])
    tags.agg(F.to_json(F.array_sort(F.collect_set(column))).alias("value")).write.mode("overwrite").text(path)


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
