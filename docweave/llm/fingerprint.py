"""Document fingerprints: a canonical exact digest, with DataFrame and SQL functions only.

The canonical form of a text is its Unicode normalisation (NFC by default), fully case-folded, with every run of white
space folded to one space and the ends trimmed. Normalisation and case folding are the ICU functions in Spark's own JVM,
called by the SQL function ``reflect``; ASCII texts need neither. The fingerprint is 128 bits of xxhash64 over two
differently prefixed copies. Documents are grouped by it, and inside equal fingerprints by the canonical bytes themselves
(``exact_groups``), so a hash collision never makes two documents equal; a group is told by its fingerprint and the
SHA-256 of its bytes from then on.

Null texts are empty; empty and all-white texts share the canonical form ''. Texts are processed whole. Equal rows get
equal fingerprints; a single row is its own next document. Null keys come last in descending order, by a hash of the
row; rows of equal key likewise. Rows equal in key and text follow each other in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.common import settle, text_of

#: Rows that the buckets of ``with_next`` hold, about; the quantiles that first cut the keys; bytes of a partition, about.
BUCKET_ROWS = 2000
QUANTILES = 256
PARTITION_BYTES = 32 << 20
BEYOND_ASCII = r"[^\x00-\x7F]"
SPACE = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def canonical(text: Column, compatibility: bool = False) -> Column:
    """The canonical form of a text column."""
    normal = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(compatibility))
    folded = F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), normal, F.lit(True))
    again = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), folded, F.lit(compatibility))
    return F.trim(F.regexp_replace(F.when(text.rlike(BEYOND_ASCII), again).otherwise(F.lower(text)), SPACE, " "))


def digest(form: Column) -> Column:
    """32 hex digits of a canonical form."""
    half = [F.lpad(F.lower(F.hex(F.xxhash64(F.concat(F.lit(salt), form)))), 16, "0") for salt in ("a", "b")]
    return F.concat(*half)


def with_fingerprint(df: DataFrame, text: str = "text", form: str = "canonical", to: str = "fingerprint") -> DataFrame:
    """Adds the canonical form and its digest."""
    return df.withColumn(form, canonical(text_of(text))).withColumn(to, digest(F.col(form)))


def exact_groups(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(group_key, fingerprint, form_sha256, n): one row per set of texts of equal canonical bytes: its smallest key (null if it
    has none), its digest, what tells it from another set of the same digest, its size.

    Rows are grouped by digest and, inside equal digests, by the bytes; both are combined before the shuffle, so a group
    that holds most of the table crosses it once per task.
    """
    marked = with_fingerprint(df.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text", "_form", "_digest").select("_key", "_form", "_digest")
    grouped = marked.groupBy("_digest", "_form").agg(F.min("_key").alias("group_key"), F.count("*").alias("n"))
    return grouped.select("group_key", F.col("_digest").alias("fingerprint"), F.sha2("_form", 256).alias("form_sha256"), "n")


def with_next(df: DataFrame, key: str, columns: list[str], prefix: str = "next_", tell: tuple[str, ...] | None = None) -> DataFrame:
    """(key, *columns, and their values in the next row in descending order of the integer ``key``; the last row's next is the first).

    No task sorts everything: keys fall into buckets (ranges between quantiles, cut evenly; null keys by ranges of a hash of
    the columns), the first row of each bucket is also dealt to the bucket before it, and the rest is a window within each
    bucket. What comes to the driver is the ends of ranges, at most 2 x ``QUANTILES`` + 2 rows. One shuffle of the rows,
    into as many partitions as their bytes need; the table of first rows, one per bucket, is joined to the rows before.
    ``tell``: columns that tell rows apart (all, if not given); what follows from them need not be computed to find places.
    """
    rows = df.select(F.col(key).cast("long").alias("_key"), *columns)
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c, kind in df.select(*(tell or columns)).dtypes if kind == "string"), F.lit(0).cast("long"))
    total, edges, nulls, held = rows.agg(F.count("*"), F.percentile_approx("_key", [i / QUANTILES for i in range(QUANTILES + 1)], 10_000), F.count_if(F.col("_key").isNull()), F.sum(size)).first()
    cuts = sorted(set(edges or [0]))
    fine = max(1, round((total - nulls) / BUCKET_ROWS / max(1, len(cuts) - 1)))
    place = _place(cuts)
    low = F.element_at(F.array(*[F.lit(c).cast("double") for c in cuts]), F.greatest(place, F.lit(1)))
    high = F.element_at(F.array(*[F.lit(c).cast("double") for c in [*cuts[1:], cuts[-1] + 1]]), F.greatest(place, F.lit(1)))
    within = F.least(F.greatest(F.floor((F.col("_key") - low) / F.greatest(high - low, F.lit(1.0)) * fine), F.lit(0)), F.lit(fine - 1))
    tie = F.xxhash64(*(tell or columns))
    free = max(1, round(nulls / BUCKET_ROWS))
    bucket = F.when(F.col("_key").isNull(), F.floor((tie / float(1 << 64) + 0.5) * free).cast("long") - free).otherwise(place.cast("long") * fine + within)
    # the first row of a bucket: the largest key, and among equals the largest hash
    keyed = rows.withColumn("_b", bucket.cast("long")).withColumn("_tie", tie)
    heads = settle(keyed.groupBy("_b").agg(F.max(F.struct("_key", "_tie")).alias("_head")).withColumn("_range", F.floor(F.col("_b") / fine)), "heads")
    ends = [(r["_range"], r["b"]) for r in heads.groupBy("_range").agg(F.min("_b").alias("b")).orderBy("_range").collect()]
    above = F.broadcast(df.sparkSession.createDataFrame([(a, b) for (a, _), (_, b) in zip(ends, [*ends[1:], *ends[:1]], strict=True)], "_range long, _above long"))
    up = Window.partitionBy("_range").orderBy("_b")
    placed = heads.join(above, "_range").select("_b", F.col("_head._key").alias("_hk"), F.col("_head._tie").alias("_ht"), F.coalesce(F.lead("_b").over(up), "_above").alias("_also"))
    tops = settle(placed, "tops")  # as a table its size is known, so the join broadcasts it while it is small
    first = F.col("_key").eqNullSafe(F.col("_hk")) & (F.col("_tie") == F.col("_ht"))
    home, guest = F.struct(F.col("_b").alias("b"), F.lit(0).alias("guest")), F.struct(F.col("_also").alias("b"), F.lit(1).alias("guest"))
    dealt = keyed.join(tops, "_b").select("_key", "_tie", *columns, F.explode(F.when(first, F.array(home, guest)).otherwise(F.array(home))).alias("_to")).select("_key", "_tie", *columns, "_to.b", "_to.guest")
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), (held or 0) // PARTITION_BYTES)
    order = Window.partitionBy("b").orderBy("guest", F.col("_key").desc_nulls_last(), F.col("_tie").desc())
    ahead = dealt.repartition(parts, "b").select("_key", "guest", *columns, *[F.lead(c).over(order).alias(f"{prefix}{c}") for c in columns])
    return ahead.where("guest = 0").select(F.col("_key").alias(key), *columns, *[f"{prefix}{c}" for c in columns])


def _place(cuts: list[int]) -> Column:
    """How many of the sorted cuts are at most the key: a binary search in one expression."""

    def search(a: int, b: int) -> Column:
        if a == b:
            return F.lit(a)
        middle = (a + b) // 2
        return F.when(F.col("_key") >= F.lit(cuts[middle]), search(middle + 1, b)).otherwise(search(a, middle))

    return search(0, len(cuts))


def edited(text: Column, following: Column) -> Column:
    """A text whose last half (code points, rounded down) is replaced by as many (or all) first code points of another."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def op4_fingerprint(spark, sf_dir: str) -> DataFrame:
    """Every document's fingerprint beside those of its edited text and of the next document, and the group of its equals.

    Beside the columns asked for: ``group_id`` (the smallest doc_id of the documents of equal canonical bytes) and
    ``group_size``. A likeness is 1 where the canonical bytes are equal, else 0.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", text_of("text").alias("text"))
    groups = settle(exact_groups(docs), "groups").select(F.col("group_key").alias("group_id"), "fingerprint", "form_sha256", F.col("n").alias("group_size"))
    marked = with_fingerprint(docs, "text", "form").select("doc_id", "text", "fingerprint", F.sha2("form", 256).alias("form_sha256"))
    pairs = with_next(marked, "doc_id", ["text", "fingerprint", "form_sha256"], tell=("text",)).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    pairs = with_fingerprint(pairs, "edited", "edited_form", "edited_fingerprint")
    one, none = F.lit(1.0), F.lit(0.0)
    like_edited = (F.col("fingerprint") == F.col("edited_fingerprint")) & (F.col("form_sha256") == F.sha2("edited_form", 256))
    like_next = (F.col("fingerprint") == F.col("next_fingerprint")) & (F.col("form_sha256") == F.col("next_form_sha256"))
    found = pairs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        F.when(like_edited, one).otherwise(none).alias("near_edited"),
        F.when(like_next, one).otherwise(none).alias("near_next"),
        "form_sha256",
    )
    return found.join(groups, ["fingerprint", "form_sha256"]).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "group_id", "group_size")
