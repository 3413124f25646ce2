"""Spelling variants: words that differ by one edit, found by merging the light subtrees of their trie.

*Words.* A task counts the runs of letters of its documents, so a shuffle carries each distinct run once per lot. In the query, a
run whose checksum with its document's id is a multiple of ``ERRATUM`` loses a code point first (planted misspellings).

*Trie.* A node is the hash of a prefix; Spark counts the words below each child, and the child with most words (ties: the
larger code point) is the node's heavy one. Only nodes with two children or more matter. A word leaves a heavy path at each
of its light edges, at most log2(words) of them, as every light edge halves what is below.

*Merging.* At a light edge, with x before it, c on it and s behind it, the word is merged into what lies below x in three ways:

* c replaced: into the heavy child, as x h s, and among the other light words, by equal (length of x, x s);
* c skipped: as x s, unless s begins with c (that pair parts further down);
* the heavy character skipped on the other side: as x h c s.

A word that ends at x leaves by a light edge too. Where merged terminals coincide with a word, the two are one edit apart, and
since two words part at one node only, each pair is found once. Only the small sides move, and they move by joins on the
merged string. A wrong heavy child, should two prefixes have one hash, costs time and never a pair: any choice is right as
long as both words see the same one.

Groups are small by construction: a place's light words differ in one character (at most the alphabet), and a string is reached by
its length times the alphabet. They are reduced to counts and best words without listing pairs. Nodes that hold more than
one word in ``HOT_SHARE`` are at most ``HOT_SHARE`` times the mean length, so they are broadcast; all others are joined by shuffling.

Null and empty texts have no words; a null document id is an empty string in the checksum. Repeated rows count again. Ties
between near words go to the smaller in code-point order. Very long runs are words like any others: a place of theirs
costs a hash, not a prefix. Empty tables give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import settle, text_of

#: Checksums divisible by this plant a misspelling.
ERRATUM = 31
SHORTEST = 7
OCCURRENCES = 2
#: How many times as frequent as a word its form is.
SHARE = 10
#: Distinct words that a task counts at once.
COUNTED = 500_000
#: Of so many words a node may hold one without being called hot.
HOT_SHARE = 1000
LETTERS = "A-Za-zÀ-ÿ"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def occurrences(df: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST, erratum: int = ERRATUM) -> DataFrame:
    """(word, n): the words of ``shortest`` code points or more, some misspelt, and how often each occurs."""
    # a maximal run of that many letters: shorter ones can't become words
    runs = re.compile(f"[{LETTERS}]{{{shortest},}}").findall

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(total.keys()), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return made

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                before = f"{name}:".encode() if name is not None else b":"
                seed = zlib.crc32(before)
                for word, n in Counter(runs(value.translate(_LOWER) if not value.isascii() else value.lower())).items():
                    h = zlib.crc32(word.encode(), seed)
                    if not h % erratum:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < shortest:
                            continue
                    total[word] += n
                if len(total) >= COUNTED:
                    yield out()
        yield out()

    rows = df.select(F.col(key).cast("string").alias("_key"), text_of(text).alias("_text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def places(words: DataFrame) -> DataFrame:
    """(row, at, node, next): each prefix of each word, as a hash of its characters, and the character behind it (empty at the end)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # powers of an odd number modulo 2 ** 64: a prefix's hash is a running sum
        powers = np.ones(1, np.uint64)
        for batch in batches:
            names = batch.column(0).to_numpy()
            texts = batch.column(1).to_pylist()
            for i in range(0, len(texts), 4096):
                chars = np.frombuffer("".join(w + "\0" for w in texts[i : i + 4096]).encode("utf-32-le"), "<u4")
                lengths = np.array([len(w) + 1 for w in texts[i : i + 4096]])
                begins = np.cumsum(lengths) - lengths
                at = np.arange(len(chars)) - np.repeat(begins, lengths)
                while len(powers) <= at.max():
                    powers = np.concatenate([powers, powers * np.uint64(pow(0x9E3779B97F4A7C15, len(powers), 1 << 64))])
                with np.errstate(over="ignore"):
                    mixed = (chars.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
                    mixed = (mixed ^ (mixed >> np.uint64(29))) * powers[at]
                    sums = np.cumsum(mixed)
                    before = sums - mixed
                    node = before - np.repeat(before[begins], lengths)
                kinds, which = np.unique(chars, return_inverse=True)
                behind = pa.DictionaryArray.from_arrays(which.astype(np.int32), pa.array([chr(c) if c else "" for c in kinds])).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(names[i : i + 4096], lengths)), pa.array(at.astype(np.int32)), pa.array(node.view(np.int64)), behind],
                    ["row", "at", "node", "next"],
                )

    return words.select("row", "word").mapInArrow(cut, "row long, at int, node long, next string")


def light_edges(words: DataFrame) -> DataFrame:
    """(row, at, heavy): where each word leaves a heavy path, and the heavy character there."""
    cut = places(words)
    children = cut.groupBy("node", "next").agg(F.count("*").alias("n"))
    nodes = children.groupBy("node").agg(F.count("*").alias("children"), F.sum("n").alias("n"), F.max(F.struct(F.when(F.col("next") != "", F.col("n")).alias("n"), "next")).alias("most"))
    nodes = settle(nodes.where("children > 1").select("node", "n", F.col("most.next").alias("heavy")), "nodes")
    limit = words.count() // HOT_SHARE
    hot, cold = nodes.where(F.col("n") > limit).select("node", F.lit(True).alias("hot"), "heavy"), nodes.where(F.col("n") <= limit).select("node", F.col("heavy").alias("_heavy"))
    marked = cut.join(F.broadcast(hot), "node", "left")
    found = marked.where("hot").drop("hot").unionByName(marked.where("hot is null").drop("hot", "heavy").join(cold.hint("shuffle_hash"), "node").withColumnRenamed("_heavy", "heavy"))
    return found.where("next <> heavy").select("row", "at", "heavy")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n): how many words are one edit away, and the most frequent of them, for words that have any.

    ``words`` has (row, word, n) with a row number each, and should be settled.
    """
    edges = settle(light_edges(words).join(words, "row").select("at", "heavy", "word", "n"), "light")
    x, own, behind = F.expr("substring(word, 1, at)"), F.expr("substring(word, at + 1, 1)"), F.expr("substring(word, at + 2)")
    replaced = F.when(own != "", F.concat(x, "heavy", behind))
    skipped = F.when((own != "") & ~F.startswith(behind, own), F.concat(x, behind))
    filled = F.concat(x, F.col("heavy"), own, behind)
    merged = edges.select("word", "n", F.explode(F.array_compact(F.array(replaced, skipped, filled))).alias("as"))
    met = merged.join(words.select(F.col("word").alias("as"), F.col("n").alias("as_n")), "as")
    one = F.lit(1).cast("long")
    there = met.select("word", one.alias("near"), F.struct((-F.col("as_n")).alias("m"), F.col("as").alias("word")).alias("best"))
    back = met.select(F.col("as").alias("word"), one.alias("near"), F.struct((-F.col("n")).alias("m"), "word").alias("best"))
    # light words beside each other: at most the alphabet in a place
    beside = edges.where(own != "").groupBy("at", F.concat(x, behind).alias("gap")).agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "word"))).alias("all"))
    beside = beside.where(F.size("all") > 1).select("all", F.posexplode("all").alias("nth", "own"))
    beside = beside.select("own.word", (F.size("all") - 1).cast("long").alias("near"), F.when(F.col("nth") == 0, F.col("all")[1]).otherwise(F.col("all")[0]).alias("best"))
    found = there.unionByName(back).unionByName(beside).groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return found.select("word", "n_near", F.col("best.word").alias("near"), (-F.col("best.m")).alias("near_n"))


def ends(links: DataFrame) -> DataFrame:
    """(word, root) for each (word, form): where following the forms ends. Each round doubles the steps, and frequencies fall
    by a factor with each step, so rounds are few."""
    links = settle(links.select("word", F.col("form").alias("to")), "links")
    while True:
        further = links.select(F.col("word").alias("to"), F.col("to").alias("next"))
        after = settle(links.join(further, "to", "left").select("word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "links")
        if after.where("moved").isEmpty():
            return after.select("word", F.col("to").alias("root"))
        links = after.select("word", "to")


def spelling_forms(counts: DataFrame, share: int = SHARE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each (word, n): its most frequent near word if that is ``share`` times as frequent."""
    words = settle(counts.withColumn("row", F.monotonically_increasing_id()), "words")
    held = F.col("near_n") >= share * F.col("n")
    rows = words.join(near_words(words), "word", "left").select(
        "word", F.when(held, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(held, F.col("near_n")).alias("form_n")
    )
    rows = settle(rows, "forms")
    roots = ends(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark, sf_dir: str) -> DataFrame:
    """Every word of 7 letters or more that occurs twice or more, with the word it misspells, if any."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return spelling_forms(occurrences(docs).where(F.col("n") >= OCCURRENCES))
