"""Best-fit packing of tokenised documents into fixed-length training sequences.

A document becomes its token ids and the end id. Only documents longer than a sequence are cut, into pieces of a whole
sequence each, of which the first takes what is left over. Pieces are then packed by their lengths alone:

1. Large items (above a third of the capacity) share a bin with at most one other large item, so they are matched
   greedily: the longest left with the longest that still fits beside it.
2. Smaller pieces, longest first, go to the bin with the smallest gap that takes them; where none does, to new bins.

Both steps work on the *number* of pieces of each length, at most ``capacity`` numbers: that histogram is all the
driver sees, and the plan it makes from it (runs of equal bins) is bounded by the capacity, whatever the corpus holds.
Spark then ranks the pieces within each length and looks each rank up in the plan. A length that very many pieces share
is ranked in ``SALTS`` parts (by a stored number of each piece, so equal rows part too) whose offsets come from their counts, so
no task gets a whole length.

Null texts are empty: one piece with the end id. Rows with equal keys are packed like any others. An empty table gives
no pieces.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.common import fresh, settle, text_of

CAPACITY = 1024
END = 2
#: Pieces of one length that are ranked in one group, about, and the fewest groups of a length.
GROUP = 200_000
SALTS = 64
#: Words whose ids a task remembers at most.
REMEMBERED = 200_000


class Encoder:
    """Token ids, as little-endian unsigned 32-bit bytes, by a byte-level BPE vocabulary.

    The pattern that splits texts for BPE never joins across a single space between two other characters, and such a
    space belongs to what follows; so most texts can be cut there and the ids of words remembered. Texts with longer
    white space are encoded in one go; texts that hold a special token's string go through the tokenizer file itself.
    """

    def __init__(self, tokenizer: str, ranks: str, pattern: str):
        import base64
        import re

        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        core = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})._core_bpe
        nothing: set[str] = set()

        def encode(text: str) -> bytes:
            return bytes(memoryview(core.encode_to_tiktoken_buffer(text, nothing)))

        self._whole = Tokenizer.from_file(tokenizer)
        self._special = [t.content for t in self._whole.get_added_tokens_decoder().values()]
        self._odd = re.compile(r" \s|\s | $").search
        self._encode = encode

        class Words(dict):
            def __missing__(self, word: str) -> bytes:
                if len(self) >= REMEMBERED:
                    self.clear()
                ids = encode(" " + word)
                self[word] = ids
                return ids

        self._words = Words()

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self._special):
            return np.array(self._whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if self._odd(text):
            return self._encode(text)
        first, *words = text.split(" ")
        return self._encode(first) + b"".join(map(self._words.__getitem__, words))


def pieces(df: DataFrame, files: tuple[str, str, str], key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]): the pieces of every document. ``files``: tokenizer file, rank file, pattern."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, stop = Encoder(*files), np.uint32(end).astype("<u4").tobytes()
        for batch in batches:
            index, piece, start, length, crc, kept = [], [], [], [], [], []
            for i, value in enumerate(batch.column(1).to_pylist()):
                ids = encode(value) + stop
                n = len(ids) // 4
                at, upto, k = 0, n % capacity or min(n, capacity), 0
                while at < n:
                    part = ids[4 * at : 4 * upto]
                    index.append(i), piece.append(k), start.append(at), length.append(upto - at), crc.append(zlib.crc32(part))
                    if with_ids:
                        kept.append(np.frombuffer(part, "<u4").astype(np.int32))
                    at, upto, k = upto, upto + capacity, k + 1
            columns = [batch.column(0).take(pa.array(index, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = [key, "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(kept, pa.list_(pa.int32()))] if with_ids else []), names + ["ids"] * with_ids)

    kind = dict(df.dtypes)[key]
    return df.select(F.col(key), text_of(text).alias("_text")).mapInArrow(cut, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of each length go, from the number of pieces of each length.

    Rows (length, first rank, first bin, pieces per bin, offset): from that rank on, ``pieces per bin`` pieces after
    another go to each bin, the first at that offset. A length's rows are in order of rank.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("a length that no sequence takes")
    ranks = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    bins = 0

    def place(length: int, first: int, many: int, each: int, offset: int) -> None:
        rows.append((length, ranks[length], first, each, offset))
        ranks[length] += many * each
        gap = capacity - offset - each * length
        if gap:
            gaps.setdefault(gap, []).append((first, many))

    # large items: the longest left beside the longest that fits
    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        while left[n]:
            mate = next((m for m in large if left[m] and m + n <= capacity and (m != n or left[n] > 1)), None)
            if mate is None:
                place(n, bins, left[n], 1, 0)
                bins, left[n] = bins + left[n], 0
            elif mate == n:
                many = left[n] // 2
                place(n, bins, many, 2, 0)
                bins, left[n] = bins + many, left[n] - 2 * many
            else:
                many = min(left[n], left[mate])
                rows.append((n, ranks[n], bins, 1, 0))
                ranks[n] += many
                place(mate, bins, many, 1, n)
                bins, left[n], left[mate] = bins + many, left[n] - many, left[mate] - many

    # small ones, longest first: the smallest gap that takes them, else new bins
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            gap = min((g for g in gaps if g >= n), default=None)
            if gap is None:
                each = capacity // n
                many, rest = divmod(left[n], each)
                if many:
                    place(n, bins, many, each, 0)
                    bins += many
                if rest:
                    place(n, bins, 1, rest, 0)
                    bins += 1
                left[n] = 0
                continue
            first, many = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
            each = min(gap // n, left[n])
            used = left[n] // each if left[n] < many * each else many
            if used < many:
                gaps.setdefault(gap, []).append((first + used, many - used))
            place(n, first, used, each, capacity - gap)
            left[n] -= used * each
    return rows


def pack(cut: DataFrame, capacity: int = CAPACITY, key: str = "doc_id", row: str | None = None) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces (with length; see ``pieces``), which should be settled: it is read three times.

    ``row`` names a column with a number of its own for every piece, which goes; without it, pieces of equal keys, numbers and
    ids are dealt out together.
    """
    own = [row] if row else [key, "piece", "ids_crc32"]
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    salts = max(SALTS, max(counts.values(), default=0) // GROUP)
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64(*own), F.lit(salts)).cast("int"))
    parts = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    places = np.array(sorted(plan(counts, capacity)), np.int64).reshape(-1, 5)
    shared = cut.sparkSession.sparkContext.broadcast(places)

    @F.pandas_udf("sequence_id long, offset long")
    def look_up(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        rows = shared.value
        # rows are sorted by (length, first rank): one number for both, as ranks are below 2 ** 50
        at = np.searchsorted((rows[:, 0] << 50) + rows[:, 1], (length.to_numpy() << 50) + rank.to_numpy(), side="right") - 1
        own = rows[at]
        nth = rank.to_numpy() - own[:, 1]
        return pd.DataFrame({"sequence_id": own[:, 2] + nth // own[:, 3], "offset": own[:, 4] + nth % own[:, 3] * own[:, 0]})

    within = Window.partitionBy("length", "_salt").orderBy(*own)
    ranked = salted.withColumn("_row", F.row_number().over(within) - 1).join(parts, ["length", "_salt"])
    out = ranked.withColumn("_place", look_up("length", (F.col("_before") + F.col("_row")).cast("long")))
    return out.select(*[c for c in cut.columns if c != row], "_place.sequence_id", "_place.offset")


def public_vocabulary() -> tuple[str, str, str]:
    """The public byte-level BPE vocabulary: tokenizer file, rank file, split pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def pack_documents(df: DataFrame, files: tuple[str, str, str] | None = None, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: one row per piece, with its sequence and its place there."""
    cut = pieces(df, files or public_vocabulary(), key, text, capacity, end, with_ids)
    row = fresh(cut, "_row")
    return pack(settle(cut.withColumn(row, F.monotonically_increasing_id()), "pieces"), capacity, key, row)


def op3_packing(spark, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of at most 1024 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs)
