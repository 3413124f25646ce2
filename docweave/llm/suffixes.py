"""Repeated bytes: every 100-byte string that also starts earlier, by windows hashed at anchors.

The method named for this operator, bucket-pointer refinement, is *not* the one used here (see README for why, with figures):
no bucket gets identifiers that the sorting of other suffixes looks up at a later offset. What is kept of it is the refinement
of buckets. The strings are bucketed by the 32-byte gram at their anchor (the smallest q-gram of each, so every string has
its anchor at the same place wherever it occurs); buckets of one member end there; the others are refined by fresh hashes of
what a run of strings around the anchor covers, then of parts of eight strings, and at last of single strings
(``docweave.llm.repeats``, which ``op9`` shares). Strings are equal if two 64-bit hashes are, of gram and content: bytes are not
compared one by one.

A byte is removed if a 100-byte string that covers it also starts earlier: in a document with a smaller key, or earlier
in the same. Strings are judged on the input. Null texts are empty; texts shorter than 100 bytes lose nothing. Rows of
equal keys are no earlier than each other. Null keys are largest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.repeats import Windows, covered, earlier_repeats

LENGTH = 100
Q = 32
_CODES = np.random.Generator(np.random.PCG64(6)).integers(0, 1 << 64, 256, np.uint64)


def byte_items(text: str) -> np.ndarray:
    return _CODES[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, q: int = Q) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept): every row's bytes without what also starts earlier; kept is binary."""
    found = earlier_repeats(df, Windows(byte_items, length, q, True, (8, 1)), key, text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, runs, kept = [], [], [], []
            for value, spans in zip(batch.column(1), batch.column(2), strict=True):
                data = value.as_py().encode("utf-8", "surrogatepass")
                total.append(len(data))
                gone = many = 0
                if spans.is_valid:
                    out = covered(len(data), *(spans.values.field(i).to_numpy().astype(np.int64) for i in (0, 1)), length)
                    gone, many = int(out.sum()), int(out[0]) + int((out[1:] & ~out[:-1]).sum())
                    data = np.frombuffer(data, np.uint8)[~out].tobytes()
                removed.append(gone), runs.append(many), kept.append(data)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())], [key, "n_bytes", "n_removed", "n_spans", "kept"])

    return found.select("_key", "_text", "spans").mapInArrow(keep, f"`{key}` long, n_bytes long, n_removed long, n_spans long, kept binary")


def op6_suffixes(spark, sf_dir: str) -> DataFrame:
    """Every document's bytes without the 100-byte strings that also start earlier."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
