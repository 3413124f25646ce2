"""Hard negatives, spelling variants and order-preserving packing against plain versions, on the small tables and on odd rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docweave.llm import negatives, ordered, spelling

LETTERS = "abcdefg"


def _near(word: str, rng: random.Random) -> str:
    at = rng.randrange(len(word))
    return rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice(LETTERS) + word[at:], word[:at] + rng.choice(LETTERS) + word[at + 1 :]])


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("odd"))
    rng = random.Random(3)
    base = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(7, 10))) for _ in range(25)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "Éclairées", "éclairées", "straßen×÷"]
    texts = [None, "", " \n\t ", "word " * 9000, "x" * 5000, "x" * 5000, "no end " * 700 + ".", "A sentence. Another! A third? " * 300, "<|endoftext|> İstanbul ΑΣ \x1c   ok"]
    for _ in range(120):
        word = rng.choice(base)
        texts.append(" ".join([word.title()] * rng.randint(1, 30) + [_near(word, rng)] * rng.randint(0, 2) + [rng.choice(base)]))
    rows = [(i if i % 11 else None, t, "en", 1, "x") for i, t in enumerate(texts)] + [(5, texts[8], "en", 1, "x")] * 3
    spark.createDataFrame(rows, "doc_id long, text string, lang string, row int, word string").write.parquet(f"{at}/documents.parquet")
    vectors = [(i, [float(x) for x in np.round(np.random.default_rng(i % 40).normal(size=6), 2)], i % 3) for i in range(350)]
    vectors += [(400, None, 1), (401, [0.5] * 6, None), (402, [0.5, None, 0.0, 0.0, 0.0, 0.0], 1), (403, [float("nan")] * 6, 1), (404, [float("inf")] * 6, 1), (None, [0.1] * 6, 2), (200, vectors[200][1], 2), (7, [0.0] * 6, 1)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").withColumns({"id": F.lit("x"), "score": F.lit(1)}).write.parquet(f"{at}/embeddings.parquet")
    return at


def empty(spark, at: str, table: str, to) -> str:
    spark.read.parquet(f"{at}/{table}.parquet").limit(0).write.mode("overwrite").parquet(f"{to}/{table}.parquet")
    return str(to)


def key(r):
    return tuple((x is None, str(x)) for x in r)


# ---------------------------------------------------------------- hard negatives


def plain_negatives(rows):
    good = [(i, l, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, l in rows if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    good = [(i, (l + 1) % 10 if i % 7 == 0 else l, v) for i, l, v in good]
    out = []
    for a in sorted({i for i, *_ in good if i % 100 == 0}):
        _, label, vec = min((r for r in good if r[0] == a), key=lambda r: r[1])
        scored = sorted((-sum(x * y for x, y in zip(vec, v, strict=True)), i, l) for i, l, v in good if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            window = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i, _) in enumerate(window)]
    return sorted(out)


def test_negatives_of_odd_rows(spark, odd):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{odd}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in negatives.op11_negatives(spark, odd).collect())
    assert got == plain_negatives(rows) and len(got) > 50


def test_negatives_against_sql(spark, small):
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{small}/embeddings.parquet'")
    assert sorted(tuple(r) for r in negatives.op11_negatives(spark, small).collect()) == sorted(con.sql(negatives.OP11_SQL).fetchall())


def test_negatives_in_blocks_of_anchors(spark, odd, monkeypatch):
    whole = sorted(tuple(r) for r in negatives.op11_negatives(spark, odd).collect())
    monkeypatch.setattr(negatives, "ANCHORS", 2)
    assert sorted(tuple(r) for r in negatives.op11_negatives(spark, odd).collect()) == whole


def test_negatives_of_nothing(spark, odd, tmp_path):
    assert negatives.op11_negatives(spark, empty(spark, odd, "embeddings", tmp_path)).collect() == []


def test_ranges_hold_scores():
    rng = np.random.default_rng(1)
    vec = rng.integers(-300, 300, (500, 10))
    books = negatives.centres(vec[:100], 5, 16)
    block = negatives.Anchors(np.arange(20), np.zeros(20), vec[:20], books)
    tables, lengths = block.tables(slice(0, 20))
    about, bound = np.zeros((20, 500)), np.zeros((20, 500))
    for m, (part, book) in enumerate(zip(np.array_split(vec, 5, axis=1), books, strict=True)):
        code = ((part[:, None] - book) ** 2).sum(2).argmin(1)
        about += tables[m][:, code]
        bound += lengths[:, m, None] * np.sqrt(((part - book[code]) ** 2).sum(1))
    assert (np.abs(vec[:20] @ vec.T - about) <= bound + 1e-6).all()


# ---------------------------------------------------------------- spelling variants


def plain_forms(docs, shortest=7):
    counts: Counter[str] = Counter()
    for name, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if name is None else name}:{word}".encode())
            counts[word[: h % len(word)] + word[h % len(word) + 1 :] if h % 31 == 0 else word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= 2}
    alphabet = sorted(set("".join(words)))
    near = {}
    for w in words:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + c + w[i + d :] for i in range(len(w) + 1) for c in alphabet for d in (0, 1)}
        near[w] = {v for v in edits if v in words and v != w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 10 * words[w]:
            form[w] = best
    rows = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(rows, key=key)


@pytest.mark.parametrize("which", ["small", "odd"])
def test_spelling_forms(spark, small, odd, which):
    at = small if which == "small" else odd
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "text").collect()]
    docs = [(k, t if t is None or len(t) < 4000 or " " in t else t) for k, t in docs]
    got = sorted((tuple(r) for r in spelling.op12_spelling(spark, at).collect()), key=key)
    want = plain_forms([(k, t) for k, t in docs if not (t and set(t) == {"x"})])
    long = [r for r in got if set(r[0]) == {"x"}]
    assert [r for r in got if r not in long] == want and any(r[1] for r in got)
    assert which == "small" or sum(r[3] for r in long) == 2


def test_chains_of_forms_and_the_alphabet(spark):
    counts = [("aaaaaaa", 1000), ("aaaaaab", 100), ("aaaaabb", 10), ("aaaabbb", 1)] + [(f"zz{c}zzzz", 2) for c in "bcdefghij"] + [("zzzzzzz", 20), ("zzzzzz", 3), ("zzzzzzzz", 3)]
    got = {r["word"]: r for r in spelling.spelling_forms(spark.createDataFrame(counts, "word string, n long")).collect()}
    assert [got[w]["root"] for w in ("aaaaaaa", "aaaaaab", "aaaaabb", "aaaabbb")] == ["aaaaaaa"] * 4
    assert got["aaaabbb"]["form"] == "aaaaabb" and got["aaaabbb"]["form_n"] == 10
    assert got["zzzzzzz"]["n_near"] == 11 and got["zzbzzzz"]["n_near"] == 10 and got["zzbzzzz"]["form"] == "zzzzzzz" and got["zzzzzz"]["form"] is None


def test_no_words(spark, odd, tmp_path):
    assert spelling.op12_spelling(spark, empty(spark, odd, "documents", tmp_path)).collect() == []


# ---------------------------------------------------------------- packing in order


@pytest.fixture(scope="module")
def vocabulary():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("which", ["small", "odd"])
def test_every_id_once_and_in_order(spark, small, odd, which, vocabulary):
    at = small if which == "small" else odd
    whole = Tokenizer.from_file(vocabulary)
    want = Counter(np.array([*whole.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for r in spark.read.parquet(f"{at}/documents.parquet").collect())
    rows = ordered.op13_ordered(spark, at).collect()
    windows = defaultdict(list)
    for r in rows:
        windows[r["sequence_id"]].append(r)
    tokens = padding = 0
    for own in windows.values():
        place = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == place and r["length"] > 0
            place += r["length"]
        assert place <= 2048
        tokens += place
        padding += 2048 - place if place & (place - 1) else 0
    assert tokens == sum(len(ids) // 4 * n for ids, n in want.items()) and padding < 0.02 * tokens
    # pieces of a row follow each other in the order of windows, so a walk along them rebuilds every row
    made: Counter[tuple] = Counter()
    walk = sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    open_: list = []
    for r in walk:
        if r["start"] == 0:
            open_ = []
        open_.append((r["start"], r["length"], r["ids_crc32"]))
        if r["start"] + r["length"] == r["doc_tokens"]:
            made[tuple(open_)] += 1
    for pieces, n in made.items():
        ids = next(i for i in want if want[i] >= 1 and len(i) // 4 == pieces[-1][0] + pieces[-1][1] and all(zlib.crc32(i[4 * s : 4 * (s + k)]) == c for s, k, c in pieces))
        want[ids] -= n
    assert not +want


def test_least_cost():
    rng = random.Random(4)
    for _ in range(60):
        capacity = 32
        ends = np.cumsum([rng.randint(1, 70) for _ in range(rng.randint(1, 12))])
        sentences = np.array(sorted(rng.sample(range(1, int(ends[-1]) + 1), min(int(ends[-1]), 9))))
        places, fee = ordered.offered(ends, sentences, capacity)
        found, at, total = ordered.cuts(places, fee, capacity), 0, 0
        for j in found:
            n = places[j] - places[at]
            assert 0 < n <= capacity
            total += fee[j] + (0 if n & (n - 1) == 0 else capacity - n)
            at = j
        cost = [0] + [10**9] * (len(places) - 1)
        for j in range(1, len(places)):
            for i in range(j):
                n = int(places[j] - places[i])
                if n <= capacity:
                    cost[j] = min(cost[j], cost[i] + int(fee[j]) + (0 if n & (n - 1) == 0 else capacity - n))
        assert at == len(places) - 1 and total == cost[-1]


def test_blocks_change_no_row(spark, odd, vocabulary):
    docs = spark.read.parquet(f"{odd}/documents.parquet").coalesce(1)
    one = ordered.pack_in_order(docs, vocabulary).collect()
    many = ordered.pack_in_order(docs, vocabulary, block=3000).collect()
    pieces = lambda rows: (sum(r["length"] for r in rows), {(r["doc_id"], r["doc_tokens"]) for r in rows})
    assert pieces(one) == pieces(many)


def test_ids_of_odd_characters(vocabulary):
    rng, whole, encode = random.Random(2), Tokenizer.from_file(vocabulary), ordered.SentenceEncoder(vocabulary)
    parts = ["a", "'s", "'", "Z", "É", "é", "́", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "1", "23", "!!", ". ", "? ", "<|endoftext|>", "<|", "|>", "ß", "İ", "ΑΣ", "ﬁ", "中", "😀", "\0", "\r\n", "'LL", "²", "ª", "µ", "×", "·"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
        assert np.frombuffer(encode(text)[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_no_documents(spark, odd, tmp_path):
    assert ordered.op13_ordered(spark, empty(spark, odd, "documents", tmp_path)).collect() == []
