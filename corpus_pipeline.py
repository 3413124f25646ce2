"""From raw documents to packed training sequences.

Five stages, each a function of (spark, docs, sf_dir): language identification, near-duplicate removal, redaction of
personal data, mixing of sources, packing. Every stage works on all that the one before it kept; all but the last return
the columns of ``documents``, whatever they are called: what a stage adds for itself has a name that no column has.

Nulls, repeats and odd rows: a document without text or without a letter goes with the first stage; later stages take a
null text as an empty one. A null source is a source like any other. Repeated rows are near-duplicates of each other, so
one stays; without that stage each row counts by itself. Ties are settled by doc_id (null last), then by row. Tables
without rows give tables without rows. Long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import langid, mixing, near, packing, pii
from docweave.llm.common import fresh, only_last, settle

#: Words of a shingle, and the share of shingles in common from which on two documents are near-duplicates.
SHINGLE = 5
LEAST = 0.8


def _like(docs: DataFrame, rows: DataFrame, text: Column, changed: Column) -> DataFrame:
    """``rows`` with the columns of ``docs``, with a new text and, where it changed, its length counted anew."""
    new, where = fresh(rows, "_text"), fresh(rows, "_changed")
    made = rows.withColumns({new: text, where: changed})
    n_chars = F.when(F.col(where), F.length(new).cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
    return made.select(*[F.col(new).alias("text") if c == "text" else n_chars if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without text or without a letter go. A missing ``lang`` becomes the predicted one.

    The model is fitted on the labelled documents of the input itself; without any, all documents go.
    """
    found = fresh(docs, "_language")
    rows = langid.predict(docs, langid.fit(docs), to=found).where(F.col(found)["lang"] != "und")
    lang = F.coalesce("lang", F.col(found)["lang"]).alias("lang")
    return rows.select(*[lang if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest doc_id, null last, and of equal ids one.

    Documents are near-duplicates whose SimHashes of five-word shingles are within four bits, or that share 0.8 of their shingles.
    """
    return near.one_of_each(docs, shingle=SHINGLE, least=LEAST)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with each identifier and secret replaced by its kind in brackets and ``n_chars`` counted anew."""
    base, spans = fresh(docs, "_base"), fresh(docs, "_spans")
    found = pii.find_spans(docs, keep=tuple(docs.columns), base=base, spans=spans)
    return _like(docs, found, pii.redacted(F.col("text"), F.col(spans)), F.size(spans) > 0)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken; where a part of one fills a source up, its first words."""
    own = fresh(docs, "_mix")
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    mixed = mixing.mix(docs, keep=tuple(c for c in docs.columns if c not in ("doc_id", "source")), prefix=own)
    size, taken, words = F.col(f"{own}size"), F.col(f"{own}taken"), F.col(f"{own}words")
    whole, rest = F.expr(f"cast({own}taken div nullif({own}size, 0) as int)"), F.expr(f"{own}taken % nullif({own}size, 0)")
    copies = F.concat(F.array_repeat(size, whole), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    rows = mixed.where(taken > 0).withColumn(f"{own}words", F.explode(copies))
    first = F.array_join(F.slice(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""), F.lit(1), words.cast("int")), " ")
    return _like(docs, rows, F.when(words < size, first).otherwise(F.col("text")), words < size)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids, sequences and places: what a training job reads."""
    return packing.pack_documents(docs, with_ids=True)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixture", mixture), ("packed", packed)]
#: SQL has neither the tokenizer nor the hashes; ``tests/llm/test_pipeline.py`` holds each stage and the whole against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; what a stage wrote on its way goes once its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with only_last(spark):
            docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
