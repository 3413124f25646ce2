"""One document of each group of near-duplicates: SimHash links, and all pairs that share most of their shingles.

Two documents link if the SimHashes of their five-word shingles are within four bits (``simhash.links``, exact whatever the
data), or if the Jaccard similarity of their sets of shingles is ``LEAST`` or more. SimHash alone would miss most pairs near
that similarity: about 10 of 64 bits differ at 0.8. Groups are the connected components of the links.

Candidates for the second kind. A document has ``BANDS`` keys, each the least values of its shingles under ``ROWS`` hash functions;
two documents of similarity 0.8 share one of them with a chance of 99.8 % (0.85: 99.99 %), two of 0.5 with 40 %. In a band's
bucket, every member is compared with one leader: the member that has most company in all its buckets, so the document that
others were copied from rather than one of the copies. Nothing lists the pairs of a bucket.

Verification. A pair's sets of shingles (32-bit hashes, made again from the texts of those that are candidates) are
intersected, and what is below ``LEAST`` goes: no pair links on its keys alone.

Equal word sequences are one node (a 64-bit hash), so groups of exact copies cost a row each. Buckets, and leaders, that hold more
than one in ``HOT_SHARE`` of all rows are at most ``HOT_SHARE`` per band: these few are broadcast, with the others a key joins few
rows. Documents without words are equal to each other. A document of fewer words than a shingle is one shingle. Null texts are
empty. Null keys are no smaller than any other. Rows of equal or null keys are rows like others: each counts by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import fresh, settle, text_of
from docweave.llm.components import components
from docweave.llm.simhash import fingerprints, links

SHINGLE = 5
LEAST = 0.8
BANDS, ROWS = 16, 5
SEED = 42
#: A bucket or leader of more than one in so many rows is called hot.
HOT_SHARE = 1000
#: Numbers that a task multiplies at once.
AT_ONCE = 1 << 15


def shingles(text: str, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The distinct 64-bit hashes of a text's shingles; of all its words where they are fewer, of none where there are none."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: only A-Z change, only ASCII space splits
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[: n - 1] + 1].tolist()
    joined = b" ".join(words)
    return np.unique(np.array([xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends[len(words) - n :].tolist(), strict=True)], np.uint64))


def _multipliers(bands: int, rows: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(own: np.ndarray, multipliers: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A set's key in each band: the least values of its hashes, each times an odd number and mixed, of the band's rows together."""
    least = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), AT_ONCE // len(multipliers) or 1):
        mixed = multipliers[:, None] * own[None, at : at + (AT_ONCE // len(multipliers) or 1)]
        np.minimum(least, (mixed ^ (mixed >> np.uint64(29))).min(1), out=least)
    keys = np.zeros(bands, np.uint64)
    for row in least.reshape(bands, -1).T:
        keys = (keys ^ row) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(32)
    return keys


def sketched(text: Column, shingle: int, bands: int = BANDS, rows: int = ROWS) -> Column:
    """struct<node, keys>: the hash of a text's words, and its key in each band (none without words)."""

    @F.pandas_udf("node long, keys array<long>")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh64_intdigest

        multipliers = _multipliers(bands, rows)
        for s in texts:
            nodes, keys = [], []
            for t in s:
                own = shingles(t, shingle)
                nodes.append(xxh64_intdigest(b" ".join(t.encode("utf-8", "surrogatepass").lower().split()), SEED + 1))
                keys.append(band_keys(own, multipliers, bands).view(np.int64) if len(own) else np.zeros(0, np.int64))
            yield pd.DataFrame({"node": np.array(nodes, np.uint64).view(np.int64), "keys": keys})

    return of(text)


def _dealt(rows: DataFrame, key: str, hot: DataFrame, salts: int = 64) -> tuple[DataFrame, DataFrame]:
    """``rows`` with a salt, and the salts of each hot key: a hot key's rows are dealt to so many groups, others' to one."""
    marked = rows.join(F.broadcast(hot.select(F.col(key), F.lit(True).alias("_hot"))), key, "left")
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*[c for c in rows.columns if c != key]), F.lit(salts))).otherwise(0).cast("int")
    spread = hot.select(key, F.explode(F.sequence(F.lit(1), F.lit(salts - 1))).alias("_salt"))
    return marked.withColumn("_salt", salt).drop("_hot"), spread


def _for_each(rows: DataFrame, key: str, values: DataFrame, total: int) -> DataFrame:
    """``rows`` joined with ``values`` (a row per key, with the number n of rows that have it), hot keys split."""
    hot = values.where(F.col("n") * HOT_SHARE > total).select(key)  # at most HOT_SHARE for each time that a row is in ``rows``
    left, spread = _dealt(rows, key, hot)
    right = values.withColumn("_salt", F.lit(0)).unionByName(values.join(F.broadcast(spread), key))
    return left.join(right.drop("n"), [key, "_salt"]).drop("_salt")


def candidates(distinct: DataFrame, total: int) -> DataFrame:
    """(node, leader): each member of a bucket of two or more with its leader; ``distinct`` has (node, keys)."""
    members = distinct.select("node", F.posexplode("keys").alias("band", "key")).select("node", F.xxhash64("band", "key").alias("bucket"))
    sizes = settle(members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").withColumn("company", F.col("n")), "buckets")
    met = settle(_for_each(members, "bucket", sizes, total), "members")
    company = met.groupBy("node").agg(F.sum("company").alias("company"))
    ranked = met.drop("company").join(company, "node")
    leaders = ranked.groupBy("bucket").agg(F.max(F.struct("company", "node"))["node"].alias("leader"), F.count("*").alias("n"))
    return _for_each(met.select("bucket", "node"), "bucket", leaders, total).where("node <> leader").select("node", "leader").distinct()


def similar(pairs: DataFrame, texts: DataFrame, shingle: int = SHINGLE, least: float = LEAST) -> DataFrame:
    """Those of the pairs (node, leader) whose sets of shingles are similar enough; ``texts`` has (node, text)."""

    @F.pandas_udf("array<int>")
    def own(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in values:
            yield pd.Series([np.unique(shingles(t, shingle).astype(np.uint32)).view(np.int32) for t in s], dtype=object)

    used = pairs.select("node").union(pairs.select(F.col("leader").alias("node"))).distinct()
    sets = settle(texts.join(used, "node", "left_semi").select("node", own("text").alias("set")), "sets")
    led = pairs.groupBy("leader").agg(F.count("*").alias("n"))
    leaders = sets.select(F.col("node").alias("leader"), F.col("set").alias("other")).join(led, "leader")
    both = _for_each(pairs.join(sets, "node"), "leader", leaders, pairs.count())
    # sizes tell most pairs apart that aren't similar, before anything is intersected
    small, large = F.least(F.size("set"), F.size("other")), F.greatest(F.size("set"), F.size("other"))
    both = both.where(small >= least * large)
    shared = F.size(F.array_intersect("set", "other"))
    return both.where(shared >= least * (F.size("set") + F.size("other") - shared)).select(F.col("node").alias("a"), F.col("leader").alias("b"))


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, least: float = LEAST) -> DataFrame:
    """One row of each group of near-duplicates: that of the smallest key, null last; of equal keys any one. The columns stay as they are."""
    at = fresh(df, "_at")  # key and text, by 128 bits
    told = F.md5(F.concat(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("-")), F.lit(":"), F.md5(text_of(F.col(f"`{text}`")))))
    rows = df.withColumn(at, told)
    own = F.struct(F.col(f"`{key}`").isNull().alias("open"), F.col(f"`{key}`").alias("key"), F.col(at).alias("at"))
    plain = rows.select(text_of(F.col(f"`{text}`")).alias("_text"), own.alias("own"))
    marked = fingerprints(plain.withColumn("sketch", sketched(F.col("_text"), shingle)), "_text", shingle=shingle).select("sketch.*", "fp", "own")
    marked = settle(marked, "sketches")
    distinct = marked.groupBy("node").agg(F.min("own").alias("first"), F.min("fp").alias("fp"), F.min("keys").alias("keys"))
    distinct = settle(distinct, "distinct")
    # links of fingerprints, as links of the least nodes that have them, and of these with the others
    least_node = settle(distinct.groupBy("fp").agg(F.min("node").alias("node")), "prints")
    near = links(least_node.select("fp")).join(least_node.select(F.col("fp").alias("a"), F.col("node").alias("an")), "a").join(least_node.select(F.col("fp").alias("b"), F.col("node").alias("bn")), "b")
    equal = distinct.select("fp", F.col("node").alias("a")).join(least_node.select("fp", F.col("node").alias("b")), "fp").where("a <> b").select("a", "b")
    pairs = settle(candidates(distinct.select("node", "keys"), distinct.count()), "pairs")
    # one text of each word sequence: that of its first row
    first = distinct.select("node", F.col("first.at").alias(at))
    used = first.join(pairs.select("node").union(pairs.select("leader")).distinct(), "node", "left_semi")
    texts = rows.select(at, text_of(F.col(f"`{text}`")).alias("text")).join(used, at).dropDuplicates(["node"]).select("node", "text")
    alike = similar(pairs, texts, shingle, least)
    labels = components(near.select(F.col("an").alias("a"), F.col("bn").alias("b")).union(equal).union(alike))
    grouped = distinct.join(labels, "node", "left").groupBy(F.coalesce("label", "node").alias("label")).agg(F.min("first").alias("first"))
    stay = settle(grouped.select(F.col("first.at").alias(at)), "stay")
    return rows.dropDuplicates([at]).join(stay, at, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
