"""Personal data by bootstrapped contextual extraction, with DataFrame and SQL functions only.

Seeds. Four patterns find e-mail addresses, IP addresses, card numbers (Luhn) and phone numbers, leftmost and without
overlaps per kind; a match that fails its test is dropped and not retried. A fifth kind, secrets, starts from two shapes:
access key ids and long hexadecimal digests with letters and digits.

Bootstrapping. A seed's lexical patterns are the two words before it, the one before, the one after, the one before
together with the one after, and its character shape (kinds of characters, power of two of its length). Words next to a
seed reach to the match of the same kind before or after it; punctuation at their ends doesn't count, a sign that joins
them to it (``password=``) does. Instances are the distinct seeds, and the distinct candidates: words with a digit or an @
that no seed covers. The graph of patterns and instances is scored in rounds:

* a pattern, for a kind: (its seeds + the scores of its candidates) / (its instances + 1); it takes ``SUPPORT`` distinct
  seeds, ``SUPPORT_ONE`` if it is a single word, and a shape never counts more than ``SHAPE_CAP``;
* a candidate, for a kind: 1 - product of (1 - score) over its patterns with a score of a half or more.

Candidates that end at ``ACCEPT`` or more become spans of the kind that scores highest (first in the list of kinds if
equal), wherever they occur. Seeds always stay.

Scale. Rows are reduced to seeds and candidates where they are read; edges are grouped (combined before the shuffle) to
distinct pairs, so copies of a passage count once; only edges of supported patterns enter the rounds. Joins on a pattern
that precedes very many words are joins of two shuffled sides that adaptive execution splits. Words of over ``LONGEST``
characters are told by their digest.

Null texts are empty. Offsets are code points, ends exclusive. Texts are searched whole, in time linear in their length.
Equal rows get equal spans. Columns that are kept may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions.find import gaps, let, replace_matches, running
from docweave.llm.common import settle, text_of

KINDS = ("email", "ip", "card", "phone", "secret")
#: Kinds of the base, in the order of the contract.
BASE = 4
#: The patterns of the kinds. Look-behinds and possessive loops keep the search linear and leave every match as it is.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9])(?:A[A-Z]IA[A-Z0-9]{16}+|(?=[0-9]*+[a-f])(?=[a-f]*+[0-9])[0-9a-f]{16,}+)(?![A-Za-z0-9])",
}
#: What a text must hold for a kind to be searched at all.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "secret": r"[0-9A-Za-z]{16}"}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_PARTS = r"\s=\"'<>{}|;,"
CANDIDATE = rf"(?<![^{_PARTS}])[^{_PARTS}0-9@]*+[0-9@][^{_PARTS}]*+"
MASK = ""
SUPPORT = 3
SUPPORT_ONE = 5
SHAPE_CAP = 0.5
ROUNDS = 3
ACCEPT = 0.8
#: Characters from which on a word next to an identifier is told by its digest.
LONGEST = 64
_CHUNK = 64
PLACE = "start:int, kind:int, end:int"
SEED = f"{PLACE}, value:string, patterns:array<string>"
OPEN = "start:int, end:int, value:string, patterns:array<string>"


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def _valid(kind: str, match: Column) -> Column:
    if kind in ("email", "secret"):
        return F.lit(True)
    if kind == "ip":
        return match.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(9, 15)

    def luhn(d: Column) -> Column:
        def part(i: Column) -> Column:
            n = F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
            return F.when(i % 2 == 0, n).otherwise(F.floor(n * 2 / 10).cast("int") + n * 2 % 10)

        return F.length(d).between(12, 19) & (_total(F.transform(F.sequence(F.lit(0), F.least(F.length(d), F.lit(19)) - 1), part)) % 10 == 0)

    return let(digits, luhn)


# ---------------------------------------------------------------- patterns


def _word(word: Column) -> Column:
    """A word next to an identifier: lower case, without punctuation at its ends; what was hidden is an identifier."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(word), rf"{MASK}++", "<id>"), r"^[\"'(\[]++|[.!?:;,)\]]++$", "")
    return F.when(F.length(bare) > LONGEST, F.md5(bare)).otherwise(bare)


def shape(value: Column) -> Column:
    """Kinds of characters of a value and the power of two of its length."""
    has = [F.when(value.rlike(c), n).otherwise("") for c, n in (("[a-z]", "a"), ("[A-Z]", "A"), ("[0-9]", "9"), ("@", "@"), (r"[^A-Za-z0-9@]", "."))]
    return F.concat(*has, F.floor(F.log2(F.greatest(F.length(value), F.lit(1)).cast("double"))).cast("string"))


def _patterns(value: Column, before: Column, after: Column) -> Column:
    """The lexical patterns of an instance between two gaps."""
    one, two = F.regexp_extract(before, r"(?<!\S)(\S++)\s*+$", 1), F.regexp_extract(before, r"(?<!\S)(\S++)\s++\S++\s*+$", 1)
    near = F.struct(_word(one).alias("l"), _word(two).alias("ll"), _word(F.regexp_extract(after, r"^[.!?:;,)\]\"']*+\s++(\S++)", 1)).alias("r"))

    def made(n: Column) -> Column:
        said = (n["l"] != "", n["ll"] != "", n["r"] != "")
        return F.filter(
            F.array(
                F.when(said[0] & said[1], F.concat(F.lit("b "), n["ll"], F.lit(" "), n["l"])),
                F.when(said[0], F.concat(F.lit("l "), n["l"])),
                F.when(said[2], F.concat(F.lit("r "), n["r"])),
                F.when(said[0] & said[2], F.concat(F.lit("a "), n["l"], F.lit(" "), n["r"])),
                F.concat(F.lit("s "), shape(value)),
            ),
            lambda p: p.isNotNull(),
        )

    return let(near, made)


def _matches(text: Column, pattern: str, make: Callable[[Column, Column, Column, Column], Column]) -> Column:
    """``make(match, start, gap before it, gap behind it)`` for every match of a pattern that is never empty."""

    def of(found: Column) -> Column:
        def cut(between: Column) -> Column:
            steps = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda g, m: F.length(g) + F.length(m))
            return let(running(steps), lambda sums: F.transform(found, lambda m, i: make(m, sums[i] + F.length(between[i]), between[i], between[i + 1])))

        return let(gaps(text, pattern), cut)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), of)


def _none(fields: str) -> Column:
    return F.from_json(F.lit("[]"), f"array<struct<{fields}>>")


def _seed(number: int, kind: str) -> Callable[[Column, Column, Column, Column], Column]:
    def make(m: Column, start: Column, before: Column, after: Column) -> Column:
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), (start + F.length(m)).alias("end"), F.lower(m).alias("value"), _patterns(m, before, after).alias("patterns"))
        return F.when(_valid(kind, m), span)

    return make


def seeds(text: Column) -> Column:
    """array<struct<start, kind (number), end, value, patterns>> of every seed, by start and then kind."""
    found = []
    for number, kind in enumerate(KINDS):
        spans = F.filter(_matches(text, PATTERNS[kind], _seed(number, kind)), lambda s: s.isNotNull())
        found.append(F.when(text.rlike(HINTS[kind]), spans).otherwise(_none(SEED)))
    return F.array_sort(F.concat(*found))


def _masked(text: Column, spans: Column) -> Column:
    """The text with the characters of every seed hidden, one kind after another; only texts with seeds of a kind pay for it."""
    for number, kind in enumerate(KINDS):
        hide = _hide(kind)
        text = F.when(F.exists(spans, _is(number)), replace_matches(text, PATTERNS[kind], hide)).otherwise(text)
    return text


def _hide(kind: str) -> Callable[[Column], Column]:
    return lambda m: F.when(_valid(kind, m), F.repeat(F.lit(MASK), F.length(m))).otherwise(m)


def candidates(text: Column, spans: Column) -> Column:
    """array<struct<start, end, value, patterns>> of the words that may be identifiers and that no seed covers."""

    def make(m: Column, start: Column, before: Column, after: Column) -> Column:
        def of(c: Column) -> Column:
            return F.struct(start.alias("start"), (start + F.length(c)).alias("end"), F.lower(c).alias("value"), _patterns(c, before, after).alias("patterns"))

        return let(F.regexp_replace(m, r"[.:!?)\]]++$", ""), of)

    free = F.when(F.size(spans) > 0, _masked(text, spans)).otherwise(text)
    found = let(free, lambda t: F.filter(_matches(t, CANDIDATE, make), lambda c: (F.length(c["value"]) > 0) & ~F.contains(c["value"], F.lit(MASK))))
    return F.when(text.rlike("[0-9@]"), found).otherwise(_none(OPEN))


# ---------------------------------------------------------------- the graph


def _support(pattern: Column) -> Column:
    return F.when(F.substring(pattern, 1, 1).isin("l", "r"), SUPPORT_ONE).otherwise(SUPPORT)


def _score(hits: Column, instances: Column, pattern: Column) -> Column:
    plain = hits / (instances + 1)
    return F.when(pattern.startswith("s "), F.least(plain, F.lit(SHAPE_CAP))).otherwise(plain)


def scored_candidates(seeded: DataFrame, open_: DataFrame) -> DataFrame:
    """(value, kind): the candidates that the graph of patterns and instances accepts.

    ``seeded``: pattern, kind, value of seeds; ``open_``: pattern, value of candidates. Repeated edges count once.
    """
    seed_edges = seeded.groupBy("pattern", "kind", "value").agg(F.count("*").alias("n"))
    patterns = settle(seed_edges.groupBy("pattern", "kind").agg(F.count("*").alias("seeds")).where(F.col("seeds") >= _support(F.col("pattern"))), "patterns")
    supported = patterns.select("pattern").distinct()
    known = seed_edges.join(supported, "pattern").select("pattern", "value").distinct()
    edges = settle(open_.groupBy("pattern", "value").agg(F.count("*").alias("n")).join(supported, "pattern").select("pattern", "value"), "edges")
    sizes = settle(known.union(edges).groupBy("pattern").agg(F.count("*").alias("instances")), "sizes")
    base = patterns.join(sizes, "pattern")
    scores = settle(base.select("pattern", "kind", _score(F.col("seeds"), F.col("instances"), F.col("pattern")).alias("score")), "scores")
    for _ in range(ROUNDS):
        doubt = F.sum(F.log1p(-F.least(F.col("score"), F.lit(0.999999))))
        values = settle(edges.join(scores.where("score >= 0.5"), "pattern").groupBy("value", "kind").agg((1 - F.exp(doubt)).alias("trust")), "values")
        gained = edges.join(values, "value").groupBy("pattern", "kind").agg(F.sum("trust").alias("gained"))
        hits = F.col("seeds") + F.coalesce("gained", F.lit(0.0))
        scores = settle(base.join(gained, ["pattern", "kind"], "left").select("pattern", "kind", _score(hits, F.col("instances"), F.col("pattern")).alias("score")), "scores")
    best = values.where(F.col("trust") >= ACCEPT).groupBy("value").agg(F.min(F.struct((-F.col("trust")).alias("t"), "kind")).alias("best"))
    return best.select("value", F.col("best.kind").alias("kind"))


def find_spans(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), base: str = "base", spans: str = "spans") -> DataFrame:
    """(*keep, ``base``, ``spans``): arrays of struct<start, kind, end>, the seeds and all spans, by start and then kind.

    What is kept is read as it is, so a column may be called like anything inside; only ``base`` and ``spans`` must differ from it.
    """
    own = [F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(keep)]
    rows = df.select(*own, text_of(F.col(f"`{text}`")).alias("_text")).withColumn("_seeds", seeds(F.col("_text"))).withColumn("_open", candidates(F.col("_text"), F.col("_seeds")))
    rows = settle(rows.drop("_text").withColumn("_row", F.monotonically_increasing_id()), "spans")
    seeded = rows.select(F.explode("_seeds").alias("s")).select("s.kind", "s.value", F.explode("s.patterns").alias("pattern"))
    open_ = rows.select("_row", F.explode("_open").alias("c")).select("_row", "c.*")
    accepted = scored_candidates(seeded, open_.select("value", F.explode("patterns").alias("pattern")))
    more = open_.join(accepted, "value").groupBy("_row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("_more"))
    seeds_only = F.transform("_seeds", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    joined = rows.select("_row", *[F.col(f"_keep{i}") for i in range(len(keep))], seeds_only.alias("_base")).join(more, "_row", "left")
    every = F.when(F.col("_more").isNull(), F.col("_base")).otherwise(F.array_sort(F.concat("_base", F.coalesce("_more", F.array().cast(f"array<struct<{PLACE}>>")))))
    return joined.select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], F.col("_base").alias(base), every.alias(spans))


# ---------------------------------------------------------------- results


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _reached(ends: Column) -> Column:
    """For each of an array of numbers the largest before it (0 for none), by chunks."""
    tops = F.transform(F.sequence(F.lit(0), F.floor((F.size(ends) - 1) / _CHUNK).cast("int")), lambda c: F.array_max(F.slice(ends, c * _CHUNK + 1, F.lit(_CHUNK))))

    def of(chunks: Column) -> Column:
        before = F.transform(chunks, lambda _, c: F.coalesce(F.array_max(F.slice(chunks, F.lit(1), c)), F.lit(0)))

        def each(b: Column) -> Column:
            return F.transform(ends, lambda _, i: F.greatest(b[F.floor(i / _CHUNK).cast("int")], F.coalesce(F.array_max(F.slice(ends, F.floor(i / _CHUNK).cast("int") * _CHUNK + 1, i % _CHUNK)), F.lit(0))))

        return let(before, each)

    return let(tops, of)


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans count as one, of the first one's kind.

    Pieces are cut from the text's fixed-width form, so each costs its own length.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def rebuilt(wide: Column) -> Column:
        def cut(a: Column, b: Column) -> Column:  # behind a letter, so that no byte-order mark is seen at the start
            return F.substring(F.decode(F.concat(F.lit(bytes((0, 0, 0, 65))), F.substring(wide, 4 * a + 1, 4 * (b - a))), "UTF-32"), F.lit(2), b - a)

        def joined(reached: Column) -> Column:
            parts = F.zip_with(spans, reached, lambda s, r: F.when(s["start"] >= r, F.concat(cut(r, s["start"]), names[s["kind"]])).otherwise(""))
            last = F.array_max(F.transform(spans, lambda s: s["end"]))
            return F.array_join(F.concat(parts, F.array(cut(last, F.length(text)))), "")

        return let(_reached(F.transform(spans, lambda s: s["end"])), joined)

    return F.when(F.size(spans) == 0, text).otherwise(let(F.encode(text, "UTF-32"), rebuilt))


def _is(number: int) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == number


def op1_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in every text of documents.

    Beside the columns asked for: ``secrets`` (spans of that kind, which the others leave out), ``n_secret``, ``n_added``
    (spans of the four kinds that the method added) and ``n_spans`` (all spans of all kinds).
    """
    found = find_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = [F.size(F.filter("base", _is(n))).cast("long").alias(f"n_{k}") for n, k in enumerate(KINDS[:BASE])]
    asked = lambda c: F.filter(c, lambda s: s["kind"] < BASE)
    return found.select(
        "doc_id",
        *count,
        F.sha2(written(asked("base")), 256).alias("base_sha256"),
        written(asked("spans")).alias("spans"),
        written(F.filter("spans", _is(BASE))).alias("secrets"),
        F.size(F.filter("spans", _is(BASE))).cast("long").alias("n_secret"),
        (F.size(asked("spans")) - F.size(asked("base"))).cast("long").alias("n_added"),
        F.size("spans").cast("long").alias("n_spans"),
    )
