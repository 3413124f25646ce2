"""Order-preserving packing: the corpus stays in its order, and dynamic programming chooses where its windows end.

Every document becomes its token ids and the end id. The ids of one partition, in the order of its rows, are one sequence
of places, and a window is a stretch of at most ``capacity`` of them. A window may end

* behind a document, at no cost,
* behind a sentence (a line's end, or a full stop, ``!`` or ``?`` before a space), at ``SENTENCE`` tokens,
* elsewhere, at ``INNER`` tokens: every ``STRIDE`` places where no better end is near, and everywhere in the last window's
  length of a partition.

The cost of a cutting is the sum of these penalties and of the padding. A window is padded to ``capacity`` unless its length
is a power of two, which needs none. With ``cost(j)`` the least cost of all windows up to place j,

    cost(j) = penalty(j) + min(capacity - j + min(cost(i) + i for j - capacity <= i < j), min(cost(j - 2 ** k) for k))

and the inner minimum over a sliding range is kept by a monotone queue, so each place is entered and removed once.

A task reads its partition in blocks of about ``BLOCK`` tokens. A block's last window stays open and begins the next block, so
memory is bounded by a block and the longest document. Nothing is shuffled: windows never cross partitions, whose ends
cost next to nothing as a rest is cut into powers of two. The sequence's number holds the partition's number, so a task
that runs again gives the same rows, provided its input has one order (a scan of files has; settle anything else).

Null texts are empty: a piece with the end id alone. Null and repeated keys are rows like any others. An empty table gives no
pieces. A text without sentences or white space is cut by the third rule.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import text_of

CAPACITY = 2048
END = 1
#: What a cut behind a sentence and a cut elsewhere cost, in tokens of padding.
SENTENCE = 4
INNER = 24
#: Tokens without a better place to cut after which a place of the last kind is offered.
STRIDE = 64
#: Tokens that are cut at once, about.
BLOCK = 1 << 20
#: Words whose ids a worker remembers at most (twice as many while a new lot fills), and how long they may be.
REMEMBERED = 500_000
LONG = 64
#: Printable characters up to U+00FF and spaces, and the vocabulary's own pattern for them in lower case.
LATIN = re.compile("[\\x20-\\x7e\\xa1-\\xff]*").fullmatch
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^ a-zªµºß-öø-ÿ0-9²³¹¼-¾]+").findall
#: A byte-level vocabulary spells a byte as the character of that number where that can be printed, else by the next one above 255.
_UNPRINTED = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
SPELLED = {b: 256 + n for n, b in enumerate(_UNPRINTED)}


class Remembered(dict):
    """What a function gave, for the arguments met lately: full, it starts anew, but what is asked for again comes over."""

    def __init__(self, made: Callable[[str], bytes], most: int = REMEMBERED):
        super().__init__()
        self._made, self._most, self._older = made, most, {}

    def __missing__(self, word: str) -> bytes:
        ids = self._older.get(word)
        if ids is None:
            ids = self._made(word)
        if len(word) <= LONG:
            if len(self) >= self._most:
                self._older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class SentenceEncoder:
    """The token ids of a text and the places behind its sentences.

    A sentence of printable characters up to U+00FF, where each letter is one code point, is split by the vocabulary's pattern
    here, and the ids of its parts are remembered. The pattern never joins across white space, which it drops, so any other
    sentence, and one that may hold a special token, is cut at spaces, and its words go through the tokenizer as they are.
    """

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        whole = Tokenizer.from_file(tokenizer)
        model, special = whole.model, tuple(t.content for t in whole.get_added_tokens_decoder().values())

        def packed(ids: list[int]) -> bytes:
            return struct.pack(f"<{len(ids)}I", *ids)

        def spelled(part: str) -> bytes:
            return packed([t.id for t in model.tokenize(part if part.isascii() else part.encode().decode("latin-1").translate(SPELLED))])

        self._parts = Remembered(spelled).__getitem__
        self._words = Remembered(lambda word: packed(whole.encode(word, add_special_tokens=False).ids)).__getitem__
        self._special = special

    def _sentence(self, sentence: str) -> bytes:
        if LATIN(sentence) and not ("|" in sentence and any(s in sentence for s in self._special)):
            return b"".join(map(self._parts, PARTS(sentence.lower())))
        return b"".join(map(self._words, sentence.split(" ")))

    def __call__(self, text: str) -> tuple[bytes, list[int]]:
        parts = [self._sentence(s) for s in text.replace(". ", ".\n").replace("! ", "!\n").replace("? ", "?\n").split("\n")]
        return b"".join(parts), list(accumulate(len(p) // 4 for p in parts))


@cache
def encoder(tokenizer: str) -> SentenceEncoder:
    """One for all tasks that a worker runs, so that what it remembers serves the next one."""
    return SentenceEncoder(tokenizer)


def offered(doc_ends: np.ndarray, sentence_ends: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end, 0 first, and what an end there costs. The last document's end is the last place."""
    total, stride = int(doc_ends[-1]), min(STRIDE, capacity)
    good = np.unique(np.concatenate([[0], doc_ends, sentence_ends]))
    gaps = np.diff(good)
    wide = np.flatnonzero(gaps > stride)
    many = (gaps[wide] - 1) // stride
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    inner = np.repeat(good[wide], many) + (nth + 1) * stride
    places = np.unique(np.concatenate([good, inner, np.arange(max(total - capacity, 0), total)]))
    cost = np.full(len(places), INNER)
    cost[np.isin(places, sentence_ends, assume_unique=False)] = SENTENCE
    cost[np.searchsorted(places, doc_ends)] = 0
    return places, cost


def cuts(places: np.ndarray, penalty: np.ndarray, capacity: int = CAPACITY) -> list[int]:
    """The ends of the windows of least cost, as numbers of places; a window begins where the one before it ends."""
    short = []
    power = 1
    while power < capacity:
        before = np.searchsorted(places, places - power)
        hit = np.flatnonzero(places[before] == places - power)
        short.append(np.stack([hit, before[hit]]))
        power *= 2
    pairs = np.concatenate(short, axis=1)
    pairs = pairs[:, np.argsort(pairs[0], kind="stable")]
    ends, starts = pairs[0].tolist() + [len(places)], pairs[1].tolist()
    at, fee = places.tolist(), penalty.tolist()
    cost, came = [0] * len(at), [0] * len(at)
    # the queue holds starts with rising cost + place: its first is the best one that is near enough
    queue: deque[tuple[int, int]] = deque([(0, 0)])
    n = 0
    for j in range(1, len(at)):
        here = at[j]
        while at[queue[0][1]] < here - capacity:
            queue.popleft()
        best, start = queue[0]
        best += capacity - here
        while ends[n] == j:
            other = cost[starts[n]]
            if other < best:
                best, start = other, starts[n]
            n += 1
        best += fee[j]
        cost[j], came[j] = best, start
        best += here
        while queue and queue[-1][0] > best:
            queue.pop()
        queue.append((best, j))
    path, j = [], len(at) - 1
    while j:
        path.append(j)
        j = came[j]
    return path[::-1]


def pack_in_order(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END, block: int = BLOCK) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset): the pieces of every document, window by window.

    ``capacity`` is a power of two. The order is that of the rows in each partition; sort within partitions for another one.
    """
    kind = dict(df.dtypes)[key]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, stop = encoder(tokenizer), np.uint32(end).astype("<u4").tobytes()
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 36
        # what is open: documents as (key, ids, places behind sentences, ids of it that are out already)
        docs: list[tuple[pa.Scalar, bytes, list[int], int]] = []
        size = 0
        kept = None

        def closed(last: bool) -> pa.RecordBatch:
            nonlocal docs, size, number
            lengths = np.array([len(ids) // 4 - out for _, ids, _, out in docs])
            doc_ends = np.cumsum(lengths)
            begins = doc_ends - lengths
            inside = [np.array(s) - out + b for (_, _, s, out), b in zip(docs, begins, strict=True)]
            sentences = np.concatenate(inside)
            places, penalty = offered(doc_ends, sentences[sentences > 0], capacity)
            windows = places[cuts(places, penalty, capacity)]
            if not last:
                windows = windows[:-1]
            upto = int(windows[-1]) if len(windows) else 0
            edges = np.unique(np.concatenate([[0], windows, doc_ends[doc_ends < upto]]))
            left, right = edges[:-1], edges[1:]
            owner = np.searchsorted(doc_ends, left, side="right")
            window = np.searchsorted(windows, left, side="right")
            first = np.concatenate([[0], windows])[window]
            done = np.array([out for *_, out in docs])
            start = left - begins[owner] + done[owner]
            crcs = [zlib.crc32(memoryview(docs[o][1])[4 * s : 4 * (s + n)]) for o, s, n in zip(owner.tolist(), start.tolist(), (right - left).tolist(), strict=True)]
            whole = np.array([len(ids) // 4 for _, ids, _, _ in docs])
            keys = pa.array([docs[o][0] for o in owner.tolist()], kept)
            made = pa.RecordBatch.from_arrays(
                [keys, *(pa.array(a, pa.int64()) for a in (start, right - left, crcs, whole[owner], number + window, left - first))],
                [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )
            number += len(windows)
            rest = int(np.searchsorted(doc_ends, upto, side="right"))
            docs = [(k, ids, s, out + max(0, upto - int(b))) for (k, ids, s, out), b in zip(docs[rest:], begins[rest:], strict=True)]
            size = int(doc_ends[-1]) - upto
            return made

        for batch in batches:
            kept = batch.schema.field(0).type
            for k, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids, ends = encode(value.as_py())
                docs.append((k, ids + stop, ends, 0))
                size += len(ids) // 4 + 1
                if size >= block:
                    yield closed(False)
        if docs:
            yield closed(True)

    rows = df.select(F.col(key), text_of(text).alias("_text"))
    return rows.mapInArrow(pack, f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op13_ordered(spark, sf_dir: str) -> DataFrame:
    """All documents in their order, in windows of at most 2048 tokens with little padding."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_in_order(docs, public_tokenizers.path("word_bpe_49k.json"))
