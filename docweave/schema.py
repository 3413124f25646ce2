"""Schemas of the engine's datasets, as DDL strings: they need no session to be read."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

MANIFEST = "cik bigint, year int, url string, accession string, original_url string"
NAMES = "cik bigint, name string"
RESULTS = "accession string, documents array<string>, period_of_report string, home_country string"
REJECTS = "cik bigint, year int, url string, reason string"
CORPUS = "text string, accession string, cik bigint, year int"
SUBMISSIONS = (
    "name string, tickers array<string>, filings struct<recent: struct<form: array<string>, accessionNumber: array<string>, "
    "primaryDocument: array<string>, filingDate: array<string>, reportDate: array<string>>, files: array<struct<name: string>>>"
)
SPAN = "struct<start:int,end:int,label:string,text:string>"
NER = (
    "text string, words array<string>, ner_tags array<string>, template_text string, slot_count int, label_count int, accession string, cik bigint, year int"
)
#: The labels of spans. NOISE is reserved and never emitted.
LABELS = ("LABOR", "LOCATION_COUNT", "ENTITY_COUNT", "SHARE", "MONEY", "QUANTITY", "TIME", "PCT_CHANGE", "PCT_RATE", "PCT_OTHER", "REFERENCE", "ADDRESS", "NOISE", "PROPER_NUM")


#: The tables of a new database.
TABLES = {"manifest": MANIFEST, "names": NAMES, "results": RESULTS, "rejects": REJECTS, "corpus": CORPUS}


def create(spark: SparkSession, path: str) -> list[str]:
    """Makes the tables that a database's folder doesn't have yet, without rows, and names them; those it has stay as they are."""
    made = []
    for name, ddl in TABLES.items():
        try:
            spark.createDataFrame([], ddl).write.mode("error").parquet(f"{path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise
        else:
            made.append(name)
    return made


def require(df: DataFrame, *columns: str) -> DataFrame:
    """``df``, or ValueError if it lacks a column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
