"""Hard-negative mining over product-quantised vectors, exact to the last row.

A row is a whole-number vector (each component times 256, rounded down) and its score is its inner product with an anchor.
For every anchor and each of its best rows of the same label (its positives), the best rows of other labels whose score is a
given share of the positive's are wanted.

*Index.* The components are cut into ``PARTS`` parts; each part of a row is replaced by the number of the nearest of
``CENTRES`` centres of that part, and the length of what is left over is stored beside it. Centres are whole numbers, fitted on
at most ``SAMPLE`` rows taken by a hash of their id; every row is encoded and the index is written as a table once.

*Search.* Anchors are taken in blocks of ``ANCHORS``, which are broadcast: their size is bounded whatever the table holds. A
task looks an anchor's scores up (a table of a part's centre and anchor, added over the parts) for all rows of a batch.
The true score differs by at most the sum over parts of (length of the anchor's part) x (length left over), so each pair has
a range that holds its score. A row is dropped only if its range lies outside what is asked for or below the k-th best that
is certain; the rest are scored exactly with whole numbers. A task keeps the best per anchor, and what tasks kept is
ranked by Spark. The first pass finds positives, the second the rows in the window that each of them opens.

The search is anchors times rows by its nature (a stated query set against all rows): a pass over the index per block of
anchors, no shuffle but that of what tasks kept.

Rows without a label, id or vector, with a component that is null, not finite or beyond ``LARGEST``, and vectors of another
length than the commonest one take no part. A row with the anchor's own id is the anchor, never its match; anchors with the
same id are one (the least label, then vector); other repeated rows count one by one. Ties go to the smaller id. An anchor with
fewer matches gets all there are. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.common import settle

PARTS = 32
CENTRES = 128
#: Rows that the centres are fitted on, at most.
SAMPLE = 8192
#: Anchors of one pass over the index.
ANCHORS = 16384
#: Rows and anchors that are compared at once.
ROWS = 4096
TOGETHER = 128
#: A component (times 256) is at most this far from zero: no score leaves 64 bits.
LARGEST = 1 << 24
POSITIVES = 5
NEGATIVES = 10


def whole_rows(df: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    """(id, label, vec array<int>): the rows that take part."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * 256))
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * 256) < LARGEST))
    rows = df.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), F.when(good, scaled).cast("array<int>").alias("vec"))
    rows = rows.where("id is not null and label is not null and size(vec) > 0")
    common = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("vec") == (common["n"] if common else 0))


def centres(sample: np.ndarray, parts: int = PARTS, many: int = CENTRES, rounds: int = 8) -> list[np.ndarray]:
    """Whole-number centres of each part, by k-means from rows spread over the sample; the same for the same sample."""
    found = []
    for part in np.array_split(sample.astype(np.float64), min(parts, sample.shape[1]), axis=1):
        own = np.unique(part, axis=0)
        own = own[np.linspace(0, len(own) - 1, min(many, len(own))).astype(int)]
        for _ in range(rounds):
            nearest = ((own**2).sum(1) - 2 * part @ own.T).argmin(1)
            sums = np.zeros_like(own)
            np.add.at(sums, nearest, part)
            counts = np.bincount(nearest, minlength=len(own))
            own = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], own)
        found.append(np.rint(own).astype(np.int64))
    return found


def indexed(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(id, label, vec, codes, left): each row with its parts' centres, a byte each, and the lengths left over, rounded up."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            vec = batch.column(2).flatten().to_numpy().reshape(n, -1).astype(np.int64)
            codes, left = np.empty((n, len(books)), np.uint8), np.empty((n, len(books)), np.float32)
            for m, (part, book) in enumerate(zip(np.array_split(vec, len(books), axis=1), books, strict=True)):
                nearest = ((book.astype(np.float64) ** 2).sum(1) - 2.0 * part.astype(np.float64) @ book.T.astype(np.float64)).argmin(1)
                over = np.sqrt(((part - book[nearest]).astype(np.float64) ** 2).sum(1))
                codes[:, m], left[:, m] = nearest, np.nextafter((over * (1 + 1e-6)).astype(np.float32), np.float32(np.inf))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([v.tobytes() for v in vec.astype("<i4")], pa.binary()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array([x.tobytes() for x in left], pa.binary())],
                ["id", "label", "vec", "codes", "left"],
            )

    return rows.mapInArrow(encode, "id long, label long, vec binary, codes binary, left binary")


class Anchors:
    """A block of anchors with their ids, labels, vectors, and the tables of their scores with each centre."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vec: np.ndarray, books: list[np.ndarray]):
        self.ids, self.labels, self.vec, self.books = ids, labels, vec, books
        self.windows = np.zeros((len(ids), 0, 2), np.int64)

    def tables(self, at: slice) -> tuple[list[np.ndarray], np.ndarray]:
        """Scores of the anchors with each part's centres, and the lengths of the anchors' parts."""
        parts = np.array_split(self.vec[at], len(self.books), axis=1)
        lengths = np.stack([np.sqrt((p.astype(np.float64) ** 2).sum(1)) for p in parts], axis=1)
        return [p @ b.T for p, b in zip(parts, self.books, strict=True)], lengths


class Best:
    """The best k (score, id) of each of many groups; ties go to the smaller id. What was met counts from then on as a floor."""

    LOW = -np.iinfo(np.int64).max

    def __init__(self, groups: int, k: int):
        self.score, self.id = np.full((groups, k), self.LOW), np.full((groups, k), np.iinfo(np.int64).max)

    def floor(self, at: slice) -> np.ndarray:
        return self.score[at, -1]

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        k = self.score.shape[1]
        met = np.unique(group)
        held = np.repeat(met, k), self.score[met].ravel(), self.id[met].ravel()
        group, score, ids = (np.concatenate(x) for x in zip(held, (group, score, ids), strict=True))
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        nth = np.arange(len(group)) - np.searchsorted(group, group)
        keep = nth < k
        self.score[group[keep], nth[keep]], self.id[group[keep], nth[keep]] = score[keep], ids[keep]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        group, nth = np.nonzero(self.score > self.LOW)
        return group, self.score[group, nth], self.id[group, nth]


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, or the least number where a row is shorter."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def _exact(block: Anchors, a: np.ndarray, vec: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a), np.int64)
    for i in range(0, len(a), 1 << 16):
        out[i : i + (1 << 16)] = np.einsum("ij,ij->i", block.vec[a[i : i + (1 << 16)]], vec[b[i : i + (1 << 16)]])
    return out


def search(index: DataFrame, block: Anchors, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor, nth, score, id): what tasks kept; the best are among them.

    Without windows: the best rows of the anchors' own labels (nth is 0). With windows: the best of other labels in each.
    """
    shared = index.sparkSession.sparkContext.broadcast(block)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        count, windows = block.windows.shape[:2]
        own = windows == 0
        best = Best(count, positives) if own else Best(count * windows, negatives)
        for batch in _sliced(batches):
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            n = len(ids)
            vec = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<i4").reshape(n, -1).astype(np.int64)
            codes = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(n, -1).T
            left = np.frombuffer(b"".join(batch.column(4).to_pylist()), "<f4").reshape(n, -1).T.astype(np.float64)
            for first in range(0, count, TOGETHER):
                at = slice(first, min(first + TOGETHER, count))
                tables, lengths = block.tables(at)
                about = np.zeros((at.stop - first, n), np.int64)
                for table, code in zip(tables, codes, strict=True):
                    about += table[:, code]
                bound = np.ceil(lengths @ left * (1 + 1e-9))
                low, high = about - bound, about + bound
                same = block.labels[at, None] == labels
                other = block.ids[at, None] != ids
                if own:
                    fit = same & other
                    floor = np.maximum(_kth(np.where(fit, low, -np.inf), positives), best.floor(at))
                    a, b = np.nonzero(fit & (high >= floor[:, None]))
                    if len(a):
                        best.add(a + first, _exact(block, a + first, vec, b), ids[b])
                    continue
                fit = ~same & other
                wanted, floors = np.zeros(fit.shape, bool), []
                for w in range(windows):
                    bottom, top = block.windows[at, w, 0, None], block.windows[at, w, 1, None]
                    sure = np.where(fit & (low >= bottom) & (high <= top), low, -np.inf)
                    floors.append(np.maximum(_kth(sure, negatives), best.score[first * windows + w : at.stop * windows : windows, -1]))
                    wanted |= (low <= top) & (high >= np.maximum(floors[w][:, None], bottom)) & (bottom <= top)
                a, b = np.nonzero(fit & wanted)
                if not len(a):
                    continue
                score = _exact(block, a + first, vec, b)
                for w in range(windows):
                    inside = (score >= block.windows[a + first, w, 0]) & (score <= block.windows[a + first, w, 1]) & (score >= floors[w][a])
                    if inside.any():
                        best.add((a[inside] + first) * windows + w, score[inside], ids[b[inside]])
        group, score, found = best.rows()
        anchor, nth = (group, np.zeros_like(group)) if own else (group // windows, group % windows)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (block.ids[anchor], nth, score, found)], ["anchor", "nth", "score", "id"])

    return index.mapInArrow(scan, "anchor long, nth long, score long, id long")


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            yield batch.slice(i, ROWS)


def hard_negatives(rows: DataFrame, anchor: Column, low: int = 30, high: int = 90, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows (id, label, vec) for which ``anchor`` holds.

    A negative's score is between ``low`` and ``high`` hundredths of the positive's.
    """
    spark = rows.sparkSession
    # a bounded sample for the centres only
    sample = [r["vec"] for r in rows.select("id", "vec").orderBy(F.xxhash64("id", "vec")).limit(SAMPLE).collect()]
    made = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not sample:
        return spark.createDataFrame([], made)
    books = centres(np.array(sample, np.int64))
    index = settle(indexed(rows, books), "quantised")
    chosen = settle(index.where(anchor).groupBy("id").agg(F.min(F.struct("label", "vec")).alias("own")).select("id", "own.*"), "anchors")
    edges = chosen.agg(F.count("*").alias("n")).first()["n"]
    found, after = None, None
    for _ in range(0, edges, ANCHORS):
        rest = chosen if after is None else chosen.where(F.col("id") > after)
        part = rest.orderBy("id").limit(ANCHORS).collect()  # one block of anchors
        after = part[-1]["id"]
        vec = np.stack([np.frombuffer(r["vec"], "<i4") for r in part]).astype(np.int64)
        block = Anchors(np.array([r["id"] for r in part]), np.array([r["label"] for r in part]), vec, books)
        order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
        firsts = search(index, block, positives, negatives).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
        firsts = firsts.select(F.col("anchor").alias("anchor_id"), (F.col("rank") - 1).cast("long").alias("nth"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        best = firsts.collect()  # ``positives`` rows of each anchor of the block
        place = {r["id"]: i for i, r in enumerate(part)}
        block = Anchors(block.ids, block.labels, vec, books)
        block.windows = np.tile(np.array([1, 0], np.int64), (len(part), positives, 1))
        for r in best:
            score = r["positive_score"]
            block.windows[place[r["anchor_id"]], r["nth"]] = (-(-low * score // 100), high * score // 100)
        pairs = spark.createDataFrame(best, firsts.schema) if best else firsts.limit(0)
        order = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), "id")
        kept = search(index, block, positives, negatives).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
        kept = kept.withColumnRenamed("anchor", "anchor_id").join(F.broadcast(pairs), ["anchor_id", "nth"])
        kept = kept.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        found = kept if found is None else found.union(kept)
    return found if found is not None else spark.createDataFrame([], made)


def op11_negatives(spark, sf_dir: str) -> DataFrame:
    """For rows whose id is divisible by 100 and five positives each: up to ten rows of other labels at 30 to 90 % of the positive's score."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(whole_rows(table, "vec_id", "embedding", label), F.col("id") % 100 == 0)


OP11_SQL = """
with e as (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as double)) as vec
  from embeddings
  where label is not null and embedding is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
scored as (
  select a.id as a, r.id as id, a.label = r.label as same, cast(list_dot_product(a.vec, r.vec) as bigint) as score
  from e a, e r where a.id % 100 = 0 and a.id <> r.id),
positives as (
  select a, id as p, score as ps from (select *, row_number() over (partition by a order by score desc, id) as n from scored where same) where n <= 5),
ranked as (
  select p.a, p.p, p.ps, s.id, s.score, row_number() over (partition by p.a, p.p order by s.score desc, s.id) as n
  from positives p join scored s on s.a = p.a and not s.same and 30 * p.ps <= 100 * s.score and 100 * s.score <= 90 * p.ps)
select a as anchor_id, p as positive_id, cast(n as integer) as rank, id as negative_id, ps as positive_score, score as negative_score from ranked where n <= 10
"""
