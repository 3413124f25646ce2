"""Repeated passages: every window of 50 words that also starts in an earlier document, by windows hashed at anchors.

The method named for this operator, compaction of a de Bruijn graph by joins, is *not* the one used here (see README for why,
with figures): no edge is joined to the one that follows it, and no path is compacted. Of the 25-word grams of a window the
smallest is its anchor; a run of windows around an anchor is decided as a whole where all documents that have the anchor have
the same run, and else taken apart into windows, read from the text of one document for each different run
(``docweave.llm.repeats``, which ``op6`` shares). Windows are equal if two 64-bit hashes are, of gram and content: words are not
compared one by one.

A word is removed if a window that covers it also starts in a document with a smaller key. Null texts have no words;
texts of fewer words than a window lose none. Rows of equal keys don't make each other repeat. Null keys are largest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.repeats import Windows, covered, earlier_repeats

WINDOW = 50
K = 25
#: Words whose hash a task remembers at most.
REMEMBERED = 500_000


class Words(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxh64_intdigest(word, 9)
        return h


_WORDS = Words()


def split(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()  # of bytes: ASCII white space


def word_items(text: str) -> np.ndarray:
    words = split(text)
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """(key, n_words, n_removed, kept): every row's words without those that an earlier document has in a window."""
    found = earlier_repeats(df, Windows(word_items, window, k, False), key, text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for value, spans in zip(batch.column(1), batch.column(2), strict=True):
                words = split(value.as_py())
                total.append(len(words))
                gone = 0
                if spans.is_valid:
                    out = covered(len(words), *(spans.values.field(i).to_numpy().astype(np.int64) for i in (0, 1)), window)
                    gone = int(out.sum())
                    words = [words[i] for i in np.flatnonzero(~out)]
                removed.append(gone), kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], [key, "n_words", "n_removed", "kept"])

    return found.select("_key", "_text", "spans").mapInArrow(keep, f"`{key}` long, n_words long, n_removed long, kept string")


def op9_substrings(spark, sf_dir: str) -> DataFrame:
    """Every document's words without the windows of 50 that an earlier document has."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
