"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the 1- to 3-grams of lower-cased labelled texts into hash buckets per language, on Spark, and sums the
counts by (language, bucket): the model is a matrix of languages x buckets, whatever the corpus holds, and a prior per
language from the number of its documents. The matrix has at most ``CELLS`` cells: 32,768 buckets for up to 512
languages, fewer for more. It may be fitted on a bounded sample (``fit_rows`` documents per language, chosen by a hash of
the key; whole texts); the priors count all.

Scoring broadcasts the matrix of log-probabilities. The texts of an Arrow batch are one sequence of characters; their
n-grams are the sparse rows of a matrix of texts x buckets, and its product with the log-probabilities is a gather and a
sum over each text's stretch, in numpy, ``BLOCK`` characters at a time.

A text that is null or holds no letter is ``und`` with score 0. Ties go to the language that sorts first. With no
labelled rows every text is ``und``. Long texts are scored whole. Scores are rounded to six digits, so equal texts
get equal results whatever the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Log-probabilities that a model holds at most, and buckets of a language at most: together what is broadcast, 64 MB.
CELLS = 1 << 24
BUCKET_BITS = 15
GRAMS = (1, 2, 3)
#: Documents per language that the model is fitted on, about; None: all.
FIT_ROWS = 4000
BLOCK = 1 << 18

Model = tuple[list[str], np.ndarray, np.ndarray]


def bucket_bits(languages: int) -> int:
    """How many bits number the buckets, so that the matrix stays within ``CELLS``."""
    return min(BUCKET_BITS, max(1, CELLS // max(1, languages)).bit_length() - 1)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _buckets(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The hash bucket of the n-gram that starts at each place but the last n - 1."""
    size = len(codes) - n + 1
    h = np.full(max(size, 0), n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for k in range(n):
        h = (h ^ codes[k : k + len(h)]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
    return (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)


def sequences(texts: list[str], block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts as stretches of one sequence, block by block: the codes, and the text (its place in the list) of each code.

    A text that a block cuts goes on in the next behind the characters that its n-grams still need; those have a negative
    number (-1 - place), which says that no n-gram of this block ends there.
    """
    held, owner, size = [], [], 0
    for place, text in enumerate(texts):
        codes, at = _codes(text), 0
        while at < len(codes):
            back = min(at, max(GRAMS) - 1)  # where at > 0 the block is new
            take = min(len(codes) - at, block - size)
            held.append(codes[at - back : at + take])
            owner.append(np.r_[np.full(back, -1 - place), np.full(take, place)])
            at, size = at + take, size + take
            if size == block:
                yield np.concatenate(held), np.concatenate(owner)
                held, owner, size = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(owner)


def grams(codes: np.ndarray, owner: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: the buckets of all n-grams that lie in one text, and that text, which never decreases."""
    text = np.where(owner < 0, -1 - owner, owner)
    for n in GRAMS:
        whole = (text[: len(text) - n + 1] == text[n - 1 :]) & (owner[n - 1 :] >= 0)
        yield _buckets(codes, n, bits)[whole], text[n - 1 :][whole]


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", fit_rows: int | None = FIT_ROWS) -> Model:
    """(languages, log-probabilities of shape (buckets, languages), log-priors). Rows without text or language don't count.

    What comes to the driver is the summed matrix, at most ``CELLS`` numbers, not rows of the corpus.
    """
    rows = labelled.select(F.col(key).alias("_k"), F.col(text).alias("_t"), F.col(lang).alias("_l")).where("_t is not null and _l is not null")
    sizes = {r[0]: r[1] for r in rows.groupBy("_l").count().collect()}
    names = sorted(sizes)
    bits = bucket_bits(len(names))
    counts = np.zeros((1 << bits, len(names)))
    if not names:
        return names, counts, np.zeros(0)
    if fit_rows is not None:
        share = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, min(1.0, fit_rows / n))])
        draw = F.pmod(F.xxhash64(F.col("_k"), F.lit(7)), F.lit(1 << 20)) / float(1 << 20)
        rows = rows.where(draw < share[F.col("_l")])

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for frame in frames:
            for name, own in frame.groupby("_l")["_t"]:
                total = sums.setdefault(name, np.zeros(1 << bits, np.int64))
                for codes, owner in sequences(own.tolist()):
                    for found, _ in grams(codes, owner, bits):
                        total += np.bincount(found, minlength=1 << bits)
        for name, total in sums.items():
            at = np.flatnonzero(total)
            yield pd.DataFrame({"lang": name, "bucket": at.astype(np.int32), "n": total[at]})

    # at most a sum per bucket and language: 2 ** 24, whatever the corpus holds
    summed = rows.select("_l", "_t").mapInPandas(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts[summed["bucket"], summed["lang"].map({n: j for j, n in enumerate(names)}).to_numpy(int)] = summed["n"]
    documents = np.array([sizes[n] for n in names], float)
    return names, np.log((counts + 0.5) / (counts.sum(0) + 0.5 * len(counts))), np.log((documents + 1) / (documents.sum() + len(names)))


def scores(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """The log-likelihood of each text in each language; a block gathers about four million log-probabilities at most."""
    total = np.zeros((len(texts), weights.shape[1]))
    bits = len(weights).bit_length() - 1
    for codes, owner in sequences(texts, max(1 << 12, min(BLOCK, (1 << 22) // max(1, weights.shape[1])))):
        for found, text in grams(codes, owner, bits):
            if len(found):
                first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
                total[text[first]] += np.add.reduceat(weights[found], first, axis=0, dtype=np.float64)
    return total


def predict(df: DataFrame, model: Model, text: str = "text", to: str = "language") -> DataFrame:
    """Adds the struct (lang string, score double): the likeliest language and its posterior probability."""
    names, weights, priors = model
    shared = df.sparkSession.sparkContext.broadcast((names, weights.astype(np.float32), priors))

    @F.pandas_udf("lang string, score double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, weights, priors = shared.value
        for s in texts:
            lang, sure = np.full(len(s), "und", object), np.zeros(len(s))
            read = np.array([t is not None and any(map(str.isalpha, t)) for t in s], bool) & bool(names)
            if read.any():
                odds = scores(s[read].tolist(), weights) + priors
                odds = np.exp(odds - odds.max(1, keepdims=True))
                best = odds.argmax(1)
                lang[read] = np.array(names, object)[best]
                sure[read] = np.round(odds[np.arange(len(best)), best] / odds.sum(1), 6)
            yield pd.DataFrame({"lang": lang, "score": sure})

    return df.withColumn(to, score(F.col(text)))


def held_out(key: str = "doc_id", folds: int = 5) -> Column:
    """Whether a document's key falls in the fold that no training sees. A null key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0, F.lit(False))


def op10_language(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out()))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))
