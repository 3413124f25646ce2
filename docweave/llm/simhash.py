"""SimHash near-duplicates by anchor-point covering.

Fingerprints are 64-bit SimHashes of four-word shingles. Two documents link if their fingerprints differ in at most
``THRESHOLD`` = 4 bits; groups are the connected components of the links.

Candidate search. The 64 bits are cut into segments of 21, 21 and 22 bits: a pair within 4 bits differs in at most one
bit in one of them. In each segment's space the anchors are a covering code of radius 1: all words whose first 15 bits
are in the perfect Hamming code. A fingerprint is replicated to every anchor within 1 + 1 bits of its segment (14.5 per
segment on average, listed by syndrome); the anchor that covers one side of a pair is then among the other's, so every
pair meets at an anchor. This is exact, whatever the data. Only distinct fingerprints are replicated.

Comparison, per anchor. Partitions are sorted by anchor and compared in numpy; of what links at an anchor only a
spanning tree is passed on (each node to its parent in a heap of the sorted group: three edges a node at most), never
all pairs. An anchor with more than ``TILE`` fingerprints is not compared by its task; its members go on, numbered, to
a second pass that deals pairs of tiles to different tasks.

A document without words has fingerprint zero, linked like any other. Null texts are empty. Null keys are no smaller
than any other; a group of null keys has a null id. Equal rows and equal keys share a group where their fingerprints link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import fresh, settle, text_of
from docweave.llm.components import components

SHINGLE = 4
SEED = 42
THRESHOLD = 4
SEGMENTS = ((0, 21), (21, 21), (42, 22))
#: Fingerprints that one comparison holds: a task compares TILE x TILE at most.
TILE = 4096


def simhash(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned 64-bit SimHash of a text: a bit is 1 if it is set in over half of the shingles' XXH64."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: only A-Z change, only ASCII space splits
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[: len(words) - shingle + 1].tolist()
        hashes = [xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)]
    ones, n = np.zeros(64, np.int64), len(hashes)
    for at in range(0, n, 1 << 16):
        block = np.array(hashes[at : at + (1 << 16)], ">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(df: DataFrame, text: str = "text", to: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """Adds the fingerprint, of shingles of so many words, as a (signed) long."""

    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(np.array([simhash(t, shingle) for t in s], np.uint64).view(np.int64))

    return df.withColumn(to, of(text_of(text)))


# ---------------------------------------------------------------- anchors


def _syndromes() -> np.ndarray:
    """The Hamming(15, 11) syndrome of every 15-bit word: the exclusive or of the numbers (from 1) of the bits that are set."""
    words, out = np.arange(1 << 15), np.zeros(1 << 15, np.int64)
    for bit in range(15):
        out ^= (words >> bit & 1) * (bit + 1)
    return out


def _differences(width: int, syndromes: np.ndarray) -> list[np.ndarray]:
    """By syndrome: the differences of two bits at most that lead from a word of that syndrome to an anchor."""
    single = [1 << k for k in range(width)]
    near = np.array([0, *single, *(a | b for i, a in enumerate(single) for b in single[:i])])
    own = syndromes[near & 0x7FFF]
    return [near[own == s] for s in range(16)]


def anchors(fps: DataFrame) -> DataFrame:
    """(anchor, fp): each distinct fingerprint at every anchor within covering radius plus threshold, in each segment."""

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        syndromes = _syndromes()
        tables = [_differences(width, syndromes) for _, width in SEGMENTS]
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                fp = whole.column(0).slice(at, 2000).to_numpy().view(np.uint64)
                for number, (shift, width) in enumerate(SEGMENTS):
                    word = (fp >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64)
                    own = syndromes[word & 0x7FFF]
                    for s in range(16):
                        mine, to = own == s, tables[number][s]
                        anchor = (word[mine][:, None] ^ to[None, :]).ravel() + (number << 22)
                        yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(np.repeat(fp[mine], len(to)).view(np.int64))], ["anchor", "fp"])

    return fps.select("fp").mapInArrow(replicate, "anchor long, fp long")


# ---------------------------------------------------------------- comparison


def _tree(fp: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join all of equal label: each member to its parent in a heap of the sorted members."""
    order = np.lexsort((fp, label))
    first = np.flatnonzero(np.r_[True, label[order][1:] != label[order][:-1]])
    start = np.repeat(first, np.diff(np.r_[first, len(order)]))
    nth = np.arange(len(order)) - start
    parent = order[start + np.maximum(nth - 1, 0) // 2]
    return fp[order][nth > 0], fp[parent][nth > 0]


def _spread(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches over the links (a, b)."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def _link(group: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trees of what links within each group; ``group`` is sorted, no group is larger than two tiles."""
    n = len(fp)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, n])
    left, right = [], []
    for start, many in zip(first[size > 96].tolist(), size[size > 96].tolist(), strict=True):
        own = fp[start : start + many]
        for at in range(0, many, 512):
            i, j = np.nonzero(np.bitwise_count(own[at : at + 512, None] ^ own[None, :]) <= THRESHOLD)
            left.append(i[j > i + at] + start + at), right.append(j[j > i + at] + start)
    end = np.repeat(first + size, size)
    end[np.repeat(size > 96, size)] = 0
    for lag in range(1, 96):
        at = np.flatnonzero(np.arange(n) + lag < end) if lag == 1 else at[at + lag < end[at]]
        if not len(at):
            break
        hit = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= THRESHOLD]
        left.append(hit), right.append(hit + lag)
    a, b = np.concatenate([*left, np.zeros(0, np.int64)]), np.concatenate([*right, np.zeros(0, np.int64)])
    used = np.unique(np.r_[a, b])
    if not len(used):
        return fp[:0], fp[:0]
    label = _spread(len(used), np.searchsorted(used, a), np.searchsorted(used, b))
    return _tree(fp[used], label)


def _compare(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by group (columns: group, fp): edges (a, b, null) or, of groups larger than ``most``, members (group, fp, tile)."""
    group, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    large, row = None, 0

    def out(a: np.ndarray, b: np.ndarray, tile: np.ndarray | None = None) -> pa.RecordBatch:
        tiles = pa.nulls(len(a), pa.int32()) if tile is None else pa.array(tile, pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), tiles], ["a", "b", "tile"])

    def aside(n: int) -> pa.RecordBatch:
        nonlocal group, fp, row
        made = out(group[:n], fp[:n], (row + np.arange(n)) // most)
        group, fp, row = group[n:], fp[n:], row + n
        return made

    for batch in batches:
        group = np.r_[group, batch.column(0).to_numpy().astype(np.int64)]
        fp = np.r_[fp, batch.column(1).to_numpy().view(np.uint64)]
        while len(group):
            if large is not None:
                n = int(np.searchsorted(group, large, side="right"))
                yield aside(n)
                if len(group):
                    large = None
                continue
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            size = np.diff(np.r_[first, len(group)])
            big = np.flatnonzero(size > most)
            upto = int(first[big[0]]) if len(big) else int(first[-1])
            if upto:
                yield out(*_link(group[:upto], fp[:upto]))
                group, fp = group[upto:], fp[upto:]
            if len(big):
                large, row = group[0], 0
            elif not len(big):
                break
    if len(group):
        yield out(*_link(group, fp))


def links(fps: DataFrame, tile: int | None = None) -> DataFrame:
    """(a, b): edges that join exactly what links among the distinct fingerprints ``fp``. ``tile``: ``TILE`` by default."""
    most = tile or TILE  # goes to the tasks by value
    met = anchors(fps).repartition("anchor").sortWithinPartitions("anchor", "fp")
    found = settle(met.mapInArrow(lambda batches: _compare(batches, most), "a long, b long, tile int"), "met")
    members = found.where("tile is not null").select(F.col("a").alias("anchor"), F.col("b").alias("fp"), "tile")
    edges = found.where("tile is null").select("a", "b")
    if members.isEmpty():
        return edges
    # anchors of more than a tile of fingerprints: every pair of tiles is a group of its own
    tiles = members.groupBy("anchor").agg((F.max("tile") + 1).alias("n"))
    pairs = members.join(tiles, "anchor").select("anchor", "fp", "tile", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("o"))
    # half a tile from each side keeps a group within a tile; a tile meets itself whole, in one group
    half, own = F.pmod(F.xxhash64("fp"), F.lit(2)), F.col("tile") == F.col("o")
    halves = F.when(own, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    dealt = pairs.select("fp", F.when(own, 0).otherwise(half).alias("h"), F.explode(halves).alias("g"), "anchor", F.least("tile", "o").alias("i"), F.greatest("tile", "o").alias("j"), "tile")
    key = F.xxhash64("anchor", "i", "j", F.when(F.col("tile") == F.col("i"), F.col("h")).otherwise(F.col("g")), F.when(F.col("tile") == F.col("i"), F.col("g")).otherwise(F.col("h")))
    groups = dealt.select(key.alias("group"), "fp").repartition("group").sortWithinPartitions("group", "fp")
    return edges.union(groups.mapInArrow(_compare_all, "a long, b long"))


def _compare_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As ``_compare`` for groups that are known to be of two tiles at most."""
    group, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def out(upto: int) -> pa.RecordBatch:
        a, b = _link(group[:upto], fp[:upto])
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        group = np.r_[group, batch.column(0).to_numpy()]
        fp = np.r_[fp, batch.column(1).to_numpy().view(np.uint64)]
        upto = int(np.searchsorted(group, group[-1])) if len(group) else 0
        if upto:
            yield out(upto)
            group, fp = group[upto:], fp[upto:]
    if len(group):
        yield out(len(group))


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of each group of near-duplicates: that of the smallest key, null last; of equal keys any one.

    Rows of equal or null keys are rows like others here: each counts by itself. The columns stay as they are.
    """
    at = fresh(df, "_at")  # key and text, by 128 bits
    told = F.md5(F.concat(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("-")), F.lit(":"), F.md5(text_of(F.col(f"`{text}`")))))
    rows = df.withColumn(at, told)
    own = F.struct(F.col(f"`{key}`").isNull().alias("open"), F.col(f"`{key}`").alias("key"), F.col(at).alias("at"))
    marked = settle(fingerprints(rows.select(F.col(f"`{text}`").alias("_text"), own.alias("own")), "_text", shingle=shingle).select("fp", "own"), "fingerprints")
    distinct = settle(marked.groupBy("fp").agg(F.min("own").alias("first")), "distinct")
    labels = components(links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    grouped = distinct.join(labels, "fp", "left").groupBy(F.coalesce("label", "fp").alias("label")).agg(F.min("first").alias("first"))
    stay = settle(grouped.select(F.col("first.at").alias(at)), "stay")
    return rows.dropDuplicates([at]).join(stay, at, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp, component_id): every row's fingerprint, and the smallest key of its group."""
    marked = settle(fingerprints(df.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text", shingle=shingle).select("_key", "fp"), "fingerprints")
    distinct = settle(marked.groupBy("fp").agg(F.min("_key").alias("least")), "distinct")
    labels = components(links(distinct.select("fp")))
    grouped = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    grouped = settle(grouped, "grouped")
    least = grouped.groupBy("label").agg(F.min("least").alias("component_id"))
    found = settle(grouped.join(least, "label").select("fp", "component_id"), "found")
    return marked.join(found, "fp").select(F.col("_key").alias(key), "fp", "component_id")


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the group of near-duplicates it belongs to."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
