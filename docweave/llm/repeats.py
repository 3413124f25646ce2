"""Which windows of a sequence also start earlier: the search that substring and suffix-array dedup share.

A document is a sequence of items (bytes, or words by their hash). A window is ``length`` consecutive items. To find
windows that also occur elsewhere without a row per window:

* Anchors. Of the ``length - q + 1`` q-grams of a window the one with the smallest hash (the leftmost of equals) is its
  anchor. Equal windows have equal anchors at equal places. Successive windows mostly share theirs, so a document has a
  run of windows per anchor, 2 / (length - q + 2) of its items on average.
* Buckets. Runs are bucketed by the q-gram of their anchor, and within a bucket refined by the identity of all they
  cover. A run whose identity also occurs earlier is a repeat as a whole. A bucket that holds one identity has no other
  repeats: of most q-grams nothing more is looked at.
* Parts. In a bucket of several identities, only the earliest run of each is taken apart, read from its document's text,
  into shorter runs (``parts``) at fixed places from the anchor, and at last into single windows. The bucket of a part is
  what all windows at its place share: where that occurs once, nothing in the part repeats; where it has one identity,
  the part repeats as a whole; the rest goes on to the next, finer parts.

All steps are the same refinement: sort by (bucket, identity, place) and let each one's first stand for the others.
Before each shuffle a batch is refined on its own, so copies that many rows share cross it once per batch; a q-gram
with many identities within a batch is dealt by identity instead, after a marker that its bucket has several. What is
spared that way only saves work; every repeat is decided by identities of 128 bits (q-gram and content).

Order: a document with a smaller key is earlier; with ``same_document`` also an earlier start in the same row. Rows of
equal keys are no earlier than each other. A null key is larger than any other (it counts as the largest long). Rows are
told apart by key and a 64-bit hash of the text, so any share of them may have no key. Rows of equal key and text count as
one in the search, and what it finds holds for each of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import settle, text_of

NULL_KEY = np.iinfo(np.int64).max
#: Items of a text that are hashed at a time.
BLOCK = 1 << 20
#: Identities of one q-gram in a batch from which on its runs are dealt by identity.
MANY = 8
BASE = np.uint64(0x9E3779B97F4A7C13)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
RUNS = "gram long, same long, key long, mark long, start int, many int, lead int, route int"
FOUND = "key long, mark long, start int, many int, gram long, lead int"


@dataclass(frozen=True)
class Windows:
    """``items``: the items of a text as unsigned 64-bit numbers; ``length`` of a window, ``q`` of an anchor; ``parts``: windows of a part, finer and finer to 1."""

    items: Callable[[str], np.ndarray]
    length: int
    q: int
    same_document: bool
    parts: tuple[int, ...] = (1,)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads what lies close."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hashes:
    """Polynomial hashes (modulo 2 ** 64) of any stretch of a sequence."""

    _up = _down = np.ones(1, np.uint64)

    def __init__(self, items: np.ndarray):
        n = len(items)
        if len(Hashes._up) <= n:
            size = max(2 * len(Hashes._up), n + 1)
            Hashes._up = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, BASE)], dtype=np.uint64)
            Hashes._down = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, INVERSE)], dtype=np.uint64)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(items * Hashes._up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * Hashes._down[start])


def _anchors(grams: np.ndarray, window: int) -> np.ndarray:
    """For each window of q-grams, the place of the smallest, leftmost if several are."""
    low = (grams & ~np.uint64(0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= window:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < window:
        low = np.minimum(low[: len(low) - (window - width)], low[window - width :])
    return (low & np.uint64(0xFFFFFF)).astype(np.int64)


def runs(items: np.ndarray, w: Windows) -> tuple[np.ndarray, ...] | None:
    """(gram, same, start, many, lead) of the runs of windows of a sequence; None if it is shorter than a window. ``lead``: from the start to the anchor."""
    if len(items) < w.length:
        return None
    h = Hashes(items)
    at = np.arange(len(items) - w.q + 1)
    grams = h.of(at, at + w.q)
    anchor = _anchors(grams, w.length - w.q + 1)
    start = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    many = np.diff(np.r_[start, len(anchor)])
    place = anchor[start]
    same = mixed(h.of(start, start + many + (w.length - 1)) ^ (((place - start) << 32) | many).astype(np.uint64))
    return grams[place], same, start, many, place - start


def _blocks(items: np.ndarray, w: Windows) -> Iterator[tuple[int, np.ndarray]]:
    """A sequence in blocks that share ``length - 1`` items: each window is in one block."""
    for at in range(0, max(1, len(items) - w.length + 1), BLOCK):
        yield at, items[at : at + BLOCK + w.length - 1]


def _first(*columns: np.ndarray) -> np.ndarray:
    """Of sorted rows: whether a row differs from the one before it in any column."""
    new = np.zeros(len(columns[0]), bool)
    if len(new):
        new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _repeats(gram, same, key, mark, start, w: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by (gram, same, key, mark, start): the first of its identity, and whether a row repeats an earlier one."""
    new = _first(gram, same)
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    repeat = key > key[first]
    if w.same_document:
        own = np.maximum.accumulate(np.where(_first(gram, same, key, mark), np.arange(len(new)), 0))
        repeat |= start > start[own]
    return first, repeat


def _batch(names: str, *columns: np.ndarray | None, n: int) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    fields = [x.split() for x in names.split(", ")]
    arrays = [pa.nulls(n, kinds[kind]) if c is None else pa.array(c.view(np.int64) if c.dtype == np.uint64 else c).cast(kinds[kind]) for (_, kind), c in zip(fields, columns, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _collapse(gram, same, key, mark, start, many, lead, w: Windows) -> Iterator[pa.RecordBatch]:
    """Refine one batch: rows of RUNS, of which those without gram are repeats found already, and those without key markers."""
    order = np.lexsort((start, mark, key, same, gram))
    gram, same, key, mark, start, many, lead = (c[order] for c in (gram, same, key, mark, start, many, lead))
    once = _first(gram, same, key, mark, start)  # rows of equal key and text have all runs in common
    gram, same, key, mark, start, many, lead = (c[once] for c in (gram, same, key, mark, start, many, lead))
    _, repeat = _repeats(gram, same, key, mark, start, w)
    if repeat.any():
        yield _batch(RUNS, None, None, key[repeat], mark[repeat], start[repeat], many[repeat], None, (mixed(key[repeat].astype(np.uint64)) >> np.uint64(33)).astype(np.int64), n=int(repeat.sum()))
        gram, same, key, mark, start, many, lead = (c[~repeat] for c in (gram, same, key, mark, start, many, lead))
    new = _first(gram)
    at = np.cumsum(new) - 1
    several = np.bincount(at[_first(gram, same)], minlength=at[-1] + 1 if len(at) else 0)[at] >= MANY if len(at) else np.zeros(0, bool)
    route = (gram >> np.uint64(33)).astype(np.int64)
    marker = new & several
    if marker.any():
        yield _batch(RUNS, gram[marker], None, None, None, None, None, None, route[marker], n=int(marker.sum()))
    route = np.where(several, (mixed(gram ^ same) >> np.uint64(33)).astype(np.int64), route)
    mark_many = np.where(several, -many, many)  # a negative number says that the bucket has several identities
    yield _batch(RUNS, gram, same, key, mark, start, mark_many, lead, route, n=len(gram))


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column(0).fill_null(int(NULL_KEY)).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)


def _gather(parts: list[tuple], w: Windows) -> Iterator[pa.RecordBatch]:
    if parts:
        yield from _collapse(*(np.concatenate(c) for c in zip(*parts, strict=True)), w)


def _cut(w: Windows) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (key, mark, text): the runs of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, held = [], 0
            for key, mark, text in zip(*_keys(batch), batch.column(2), strict=True):
                items = w.items(text.as_py())
                for at, block in _blocks(items, w):
                    found = runs(block, w)
                    if found is not None:
                        gram, same, start, many, lead = found
                        parts.append((gram, same, np.full(len(gram), key), np.full(len(gram), mark), start + at, many, lead))
                        held += len(gram)
                if held > 2_000_000:
                    yield from _gather(parts, w)
                    parts, held = [], 0
            yield from _gather(parts, w)

    return run


def _parts(block: np.ndarray, start: np.ndarray, many: np.ndarray, lead: np.ndarray, gram: np.ndarray, part: int, w: Windows) -> tuple[np.ndarray, ...]:
    """(gram, same, start, many, lead) of the parts of runs that lie in a block."""
    run = np.repeat(np.arange(len(start)), many)
    first = np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many) + start[run]
    anchor = start[run] + lead[run]
    slot = (anchor - first) // part
    at = np.flatnonzero(_first(run, slot))
    own, slot, anchor, first = run[at], slot[at], anchor[at], first[at]
    size = np.diff(np.r_[at, len(run)])
    h = Hashes(block)
    shared = anchor - part * slot
    bucket = mixed(h.of(shared, shared - (part - 1) + w.length) ^ mixed(gram[own] + slot.astype(np.uint64)))
    same = mixed(h.of(first, first + size + (w.length - 1)) ^ (((anchor - first) << 32) | size).astype(np.uint64))
    return bucket, same, first, size, anchor - first


def _apart(w: Windows, part: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (key, mark, text, runs array<struct<start, many, lead, gram>>): the parts of the runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, held = [], 0
            for key, mark, text, own in zip(*_keys(batch), batch.column(2), batch.column(3), strict=True):
                items = w.items(text.as_py())
                fields = own.values
                start, many, lead = (fields.field(i).to_numpy().astype(np.int64) for i in range(3))
                gram = fields.field(3).to_numpy().view(np.uint64)
                for at, block in _blocks(items, w):
                    mine = (start >= at) & (start < at + BLOCK)
                    if mine.any():
                        bucket, same, first, size, to = _parts(block, start[mine] - at, many[mine], lead[mine], gram[mine], part, w)
                        parts.append((bucket, same, np.full(len(same), key), np.full(len(same), mark), first + at, size, to))
                        held += len(same)
                if held > 2_000_000:
                    yield from _gather(parts, w)
                    parts, held = [], 0
            yield from _gather(parts, w)

    return run


def _refine(w: Windows, ask: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From sorted RUNS: rows of FOUND. Without gram: repeats. With one (if ``ask``): the earliest runs of a bucket of several identities.

    A stream over the sorted partition: it remembers the bucket and the identity it is in, and one run that may still
    turn out to have company.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (gram, same, key, mark, marker, start) of the last row, the key that came first of its identity, and that key's and mark's first start
        lead_key = lead_start = several = None
        alone: list[tuple] = []  # leaders of the bucket's only identity so far
        for batch in batches:
            gram = batch.column(0)
            known = gram.is_null()
            if known.true_count:
                found = batch.filter(known)
                yield _batch(FOUND, *(found.column(i).to_numpy() for i in range(2, 6)), None, None, n=found.num_rows)
            rest = batch.filter(gram.is_valid())
            if not rest.num_rows:
                continue
            marker = rest.column(2).is_null().to_numpy(zero_copy_only=False)
            gram = rest.column(0).to_numpy().view(np.uint64)
            same, key, mark, start, many, to = (rest.column(i).fill_null(0).to_numpy() for i in range(1, 7))
            same = same.view(np.uint64)
            n = len(gram)
            new_gram, new_same = _first(gram), _first(gram, same, marker)
            if last is not None:
                new_gram[0] = gram[0] != last[0]
                new_same[0] = new_gram[0] or marker[0] != last[4] or same[0] != last[1]
            # the key that came first of each identity
            first = np.maximum.accumulate(np.where(new_same, np.arange(n), -1))
            lead = np.where(first >= 0, key[np.maximum(first, 0)], lead_key if lead_key is not None else 0)
            repeat = key > lead
            # the start that came first of each identity in a document
            new_own = _first(gram, same, key, mark, marker)
            new_own[0] = last is None or (gram[0], same[0], key[0], mark[0], marker[0]) != last[:5]
            own = np.maximum.accumulate(np.where(new_own, np.arange(n), -1))
            own_start = np.where(own >= 0, start[np.maximum(own, 0)], lead_start if lead_start is not None else 0)
            again = ~_first(gram, same, key, mark, marker, start)  # of another row of equal key and text
            again[0] = not new_own[0] and start[0] == last[5]
            if w.same_document:
                repeat |= start > own_start
            repeat &= ~marker & ~again
            if repeat.any():
                yield _batch(FOUND, key[repeat], mark[repeat], start[repeat], np.abs(many[repeat]), None, None, n=int(repeat.sum()))
            if ask:
                # buckets of several identities: a marker, a flag, or a second identity
                bucket = np.cumsum(new_gram)
                score = np.bincount(bucket, weights=new_same + 2.0 * marker + 2.0 * (many < 0), minlength=bucket[-1] + 1)
                if not new_gram[0]:
                    score[0] += several or 0
                leader = ~repeat & ~marker & ~again
                open_at = bucket == bucket[-1]
                ripe = leader & (score[bucket] >= 2)
                if bucket[-1] > bucket[0] or new_gram[0]:
                    if not new_gram[0] and score[0] >= 2 and alone:
                        yield from self_rows(alone)
                    alone = []
                elif score[bucket[0]] >= 2 and alone:
                    yield from self_rows(alone)
                    alone = []
                if ripe.any():
                    yield _batch(FOUND, key[ripe], mark[ripe], start[ripe], np.abs(many[ripe]), gram[ripe], to[ripe], n=int(ripe.sum()))
                several = score[bucket[-1]]
                if several < 2:
                    wait = leader & open_at
                    alone += [tuple(x) for x in zip(key[wait].tolist(), mark[wait].tolist(), start[wait].tolist(), np.abs(many[wait]).tolist(), gram[wait].tolist(), to[wait].tolist(), strict=True)]
            last, lead_key, lead_start = (gram[-1], same[-1], key[-1], mark[-1], marker[-1], start[-1]), lead[-1], own_start[-1]

    def self_rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        columns = [np.array(c, np.uint64 if i == 4 else np.int64) for i, c in enumerate(zip(*rows, strict=True))]
        yield _batch(FOUND, *columns, n=len(rows))

    return run


def _sorted(rows: DataFrame) -> DataFrame:
    """Rows of RUNS dealt by route and sorted so that a marker comes first in its bucket."""
    return rows.repartition("route").sortWithinPartitions("gram", "same", "key", "mark", "start")


def earlier_repeats(df: DataFrame, w: Windows, key: str, text: str) -> DataFrame:
    """(_key, _mark, _text, spans): every row of ``df`` with the items that windows which also start earlier cover.

    ``spans`` is an array of (start, many): ``many`` successive windows from ``start`` on; null where there are none.
    """
    value = text_of(text)
    rows = df.select(F.col(key).cast("long").alias("_key"), F.xxhash64(value).alias("_mark"), value.alias("_text"))
    cut = rows.mapInArrow(_cut(w), RUNS)
    found = settle(_sorted(cut).mapInArrow(_refine(w, True), FOUND), "runs")
    repeats = found.where("gram is null").select("key", "mark", "start", "many")
    for part in w.parts:
        asked = found.where("gram is not null").groupBy("key", "mark").agg(F.collect_set(F.struct("start", "many", "lead", "gram")).alias("runs"))
        apart = _with_text(rows, asked, "inner").select("_key", "_mark", "_text", "runs").mapInArrow(_apart(w, part), RUNS)
        found = settle(_sorted(apart).mapInArrow(_refine(w, part > 1), FOUND), f"parts-{part}")
        repeats = repeats.union(found.where("gram is null").select("key", "mark", "start", "many"))
    spans = repeats.groupBy("key", "mark").agg(F.collect_set(F.struct("start", "many")).alias("spans"))
    return _with_text(rows, spans, "left").select("_key", "_mark", "_text", "spans")


def _with_text(rows: DataFrame, by_row: DataFrame, how: str) -> DataFrame:
    """Join what was found of a row (its own, so no larger than its text) to the row; the texts are not sorted for it."""
    keyed = rows.withColumn("key", F.coalesce("_key", F.lit(int(NULL_KEY))))
    return keyed.join(by_row.withColumnRenamed("mark", "_mark").hint("shuffle_hash"), ["key", "_mark"], how)


def covered(n: int, starts: np.ndarray, many: np.ndarray, length: int) -> np.ndarray:
    """Which of n items the windows cover."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + many + length - 1, n), -1)
    return np.cumsum(steps[:n]) > 0
