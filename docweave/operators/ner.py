"""Token rows from texts and spans: words with B-, I- and O tags, and the text with its spans as numbered slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions import numbers as nm
from docweave.functions import text as tx
from docweave.functions.find import replace_spans
from docweave.operators import mutate, spans


def seed_of(seed: int, *parts: Column) -> Column:
    """A row's seed: of the run's seed and what identifies the row."""
    return F.xxhash64(F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def _tagged(text: Column, label: Column) -> Column:
    words = tx.tokens(text)
    return F.transform(words, lambda w, i: F.struct(w.alias("word"), F.when(label.isNull(), "O").otherwise(F.concat(F.when(i == 0, "B-").otherwise("I-"), label)).alias("tag")))


def token_rows(df: DataFrame, text: str, found: str = "spans", rules: tuple[tuple[str, str], ...] = (), vary: Column | None = None, style: str = "original") -> DataFrame:
    """Adds words, ner_tags, template_text, slot_count and label_count.

    ``rules`` rewrite every piece in order; ``vary`` is a seed column: with it spans are varied, each by its own seed;
    ``style`` restyles whole numbers between spans. The template shows the text as it came, whatever is varied.
    """
    t, s = F.col(text), F.col(found)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<text:string,label:string,n:int>>").alias("out"))

    def step(acc: Column, span: Column) -> Column:
        before = F.struct(F.substring(t, acc["at"] + 1, span["start"] - acc["at"]).alias("text"), F.lit(None).cast("string").alias("label"), F.lit(0).alias("n"))
        own = F.struct(F.substring(t, span["start"] + 1, span["end"] - span["start"]).alias("text"), span["label"].alias("label"), F.size(acc["out"]).alias("n"))
        return F.struct(span["end"].alias("at"), F.concat(acc["out"], F.array(before, own)).alias("out"))

    def rest(acc: Column) -> Column:
        last = F.struct(F.substring(t, acc["at"] + 1, F.length(t)).alias("text"), F.lit(None).cast("string").alias("label"), F.lit(0).alias("n"))
        return F.concat(acc["out"], F.array(last))

    def piece(p: Column) -> Column:
        inside = tx.rewritten(p["text"] if vary is None else mutate.span_text(p["text"], p["label"], F.xxhash64(vary, p["n"])), rules)
        outside = tx.rewritten(p["text"], rules)
        return F.when(p["label"].isNull(), _tagged(outside if style == "original" else nm.restyled(outside, style), F.lit(None).cast("string"))).otherwise(_tagged(inside, p["label"]))

    out = df.withColumn("_tokens", F.flatten(F.transform(F.aggregate(s, start, step, rest), piece)))
    slots = F.transform(s, lambda x, i: F.struct(x["start"].alias("start"), x["end"].alias("end"), (i + 1).alias("n")))
    template = replace_spans(t, slots, lambda x: F.concat(F.lit("__ID"), x["n"].cast("string"), F.lit("__")))
    return out.select(
        *df.columns,
        F.transform("_tokens", lambda x: x["word"]).alias("words"),
        F.transform("_tokens", lambda x: x["tag"]).alias("ner_tags"),
        template.alias("template_text"),
        F.size(s).alias("slot_count"),
        F.size(F.array_distinct(F.transform(s, lambda x: x["label"]))).alias("label_count"),
    )


def process(df: DataFrame, text: str, key: str, seed: int = 42, require_entity: bool = True, augment: bool = False, chain: list[spans.Extractor] | None = None) -> DataFrame:
    """Rows of texts to token rows: cleaned, normalised, spans found, tagged. Blank texts go, and texts without spans if asked."""
    held = df.where(F.col(text).isNotNull() & F.col(text).rlike(r"\S"))
    # a row number keeps the optimizer from computing the spans once more for the filter
    clean = held.withColumn("_clean", nm.normalized(tx.clean_document_text(F.col(text))))
    found = spans.extract(clean, "_clean", "spans", chain).withColumn("_plain", tx.unbracketed(F.col("_clean"))).withColumn("_row", F.monotonically_increasing_id())
    found = found.where((F.size("spans") > 0) & (F.col("_row") >= 0)) if require_entity else found
    vary = seed_of(seed, F.md5(F.substring("_plain", 1, 512)), F.col(key)) if augment else None
    return token_rows(found, "_plain", vary=vary).drop(text, "_clean", "_row").withColumnRenamed("_plain", text)


def vocabulary(df: DataFrame, tags: str = "ner_tags") -> DataFrame:
    """Distinct tags, in order: a row each."""
    return df.select(F.explode(tags).alias("tag")).distinct().orderBy("tag")
