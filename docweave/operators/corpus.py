"""From documents to a balanced corpus of text blocks: filter, sample, dedupe, cap, stratify, count.

Order matters: sampling comes before dedupe, so a block that is sampled out is not replaced. Every choice depends on
the data alone (keys and their digests), never on partitions: a rerun or another cluster chooses the same blocks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.functions.find import let


@dataclass(frozen=True)
class BlockFilter:
    """Thresholds of a good block."""

    min_chars: int = 40
    max_chars: int = 2000
    min_alpha: float = 0.5
    max_digit: float = 0.4
    max_upper: float = 0.6
    min_line: int = 50
    tables: bool = False

    def __call__(self, text: Column) -> Column:
        good = F.length(text).between(self.min_chars, self.max_chars)
        if not self.tables:
            good &= ~text.rlike(r"(?i)^\s*<TABLE") & ~(F.contains(text, F.lit("|")) & (tx.digit_ratio(text) > 0.15))
        good &= (tx.alpha_ratio(text) >= self.min_alpha) & (tx.digit_ratio(text) <= self.max_digit) & (tx.upper_ratio(text) <= self.max_upper)
        return good & (tx.average_line(text) >= self.min_line) if self.min_line > 0 else good


def blocks(df: DataFrame, text: str = "text", separator: str = "\n") -> DataFrame:
    """A row per block: ``pos`` and ``block`` beside the other columns."""
    return df.select(*[c for c in df.columns if c != text], F.posexplode(F.split(text, separator)).alias("pos", "block"))


def clean_good(df: DataFrame, block: str = "block", keep: BlockFilter = BlockFilter()) -> DataFrame:
    """Blocks cleaned, and only the good ones."""
    return df.withColumn(block, tx.clean_block(F.col(block))).where(keep(F.col(block)))


def good_blocks(df: DataFrame, text: str = "text", keep: BlockFilter = BlockFilter(), separator: str = "\n") -> DataFrame:
    """``blocks`` and ``clean_good`` in one: each line is cleaned and judged once, inside its document's array.

    A filter behind a projection would be pushed below it with the whole cleaning written out at every use; one on the
    rows of an outer explode stays where it is. Null texts have no blocks.
    """
    lines = F.transform(F.split(text, separator), lambda line, i: F.struct(i.alias("pos"), let(tx.clean_block(line), lambda b: F.when(keep(b), b)).alias("block")))
    rest = [c for c in df.columns if c != text]
    held = df.select(*rest, F.explode_outer(F.filter(lines, lambda b: b["block"].isNotNull())).alias("_b"))
    return held.where(F.col("_b").isNotNull()).select(*rest, "_b.pos", "_b.block")


def first_of_each(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """The first row, in ``order``, of each key. Rows are combined before the shuffle, so a key may hold any share of them."""
    rest = [c for c in df.columns if c not in order]
    return df.groupBy(key.alias("_key")).agg(F.min(F.struct(*order, *rest)).alias("_row")).select(*[F.col(f"_row.{c}").alias(c) for c in df.columns])


def draw(seed: int, *parts: str) -> Column:
    """A digest that orders rows at random but always alike."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts]))


def sample_per_group(df: DataFrame, group: str, k: int, seed: int, *parts: str) -> DataFrame:
    """``k`` rows of each group, by digest. Spark's limit on ranks cuts a group before its shuffle."""
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(draw(seed, group, *parts))))
    return ranked.where(F.col("_n") <= k).drop("_n")


def cap_per_group(df: DataFrame, group: str, k: int, order: list[str]) -> DataFrame:
    """The first ``k`` rows of each group; rows without a group are not capped."""
    named, free = df.where(F.col(group).isNotNull()), df.where(F.col(group).isNull())
    ranked = named.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.where(F.col("_n") <= k).drop("_n").unionByName(free)


def decade(year: Column) -> Column:
    """1990s for 1994; unknown for none."""
    return F.when(year.isNull(), F.lit("unknown")).otherwise(F.concat((F.floor(year / 10) * 10).cast("string"), F.lit("s")))


def stratify(df: DataFrame, stratum: Column, target: int, seed: int, *parts: str) -> DataFrame:
    """``target`` rows (or all): an equal quota per stratum, and the rest from what the larger strata have left, by digest.

    ``parts`` tell rows apart; no row is taken twice. Only two numbers come to the driver. A stratum's quota is cut off
    before its shuffle, and what is left of it is found by comparing digests with that of the last row in the quota, so no
    task ranks a whole stratum.
    """
    tagged = df.withColumn("_s", stratum).withColumn("_d", draw(seed, *parts))
    counts = tagged.groupBy("_s").agg(F.count("*").alias("_n"))
    quota = target // max(1, counts.count())
    short = target - (counts.agg(F.sum(F.least("_n", F.lit(quota)))).first()[0] or 0)
    first = tagged.withColumn("_n", F.row_number().over(Window.partitionBy("_s").orderBy("_d"))).where(F.col("_n") <= quota).drop("_n")
    last = first.groupBy("_s").agg(F.max("_d").alias("_last")).withColumnRenamed("_s", "_of")
    beyond = tagged.join(last, F.col("_s").eqNullSafe(F.col("_of")), "left").where(F.col("_last").isNull() | (F.col("_d") > F.col("_last"))).drop("_of", "_last")
    return first.unionByName(beyond.orderBy("_d").limit(max(0, short))).drop("_s", "_d")


def build(docs: DataFrame, key: str, group: str, seed: int = 42, per_document: int = 10, per_group: int = 100, keep: BlockFilter = BlockFilter()) -> DataFrame:
    """The corpus: good blocks, sampled per document, first of equals, capped per group."""
    good = good_blocks(docs, keep=keep)
    sampled = sample_per_group(good, key, per_document, seed, "pos")
    unique = first_of_each(sampled, tx.dedupe_key(F.col("block")), [key, "pos"])
    return cap_per_group(unique, group, per_group, [key, "pos"])


STEPS = ("good", "sampled", "unique", "kept")


def build_observed(docs: DataFrame, key: str, group: str, path: str, seed: int = 42, per_document: int = 10, per_group: int = 100, keep: BlockFilter = BlockFilter()) -> dict[str, int]:
    """Write the corpus of ``build`` to ``path`` and tell how many blocks each step left: counted while they pass, in the job that writes."""
    seen = {name: Observation(name) for name in STEPS}
    count = F.count(F.lit(1)).alias("n")
    good = good_blocks(docs, keep=keep).observe(seen["good"], count)
    sampled = sample_per_group(good, key, per_document, seed, "pos").observe(seen["sampled"], count)
    unique = first_of_each(sampled, tx.dedupe_key(F.col("block")), [key, "pos"]).observe(seen["unique"], count)
    cap_per_group(unique, group, per_group, [key, "pos"]).observe(seen["kept"], count).write.parquet(path)
    return {name: o.get["n"] for name, o in seen.items()}


def funnel(df: DataFrame, block: Column, **stages: Callable[[Column], Column]) -> DataFrame:
    """One row: how many blocks (of the array ``block``) meet each condition and all before it, and their share in percent, from one scan."""
    names = list(stages)
    met = F.transform(block, lambda x: let(tx.clean_block(x), lambda b: F.struct(*[stages[n](b).alias(n) for n in names])))
    rows = df.select(F.explode_outer(met).alias("_m")).where(F.col("_m").isNotNull())
    sums, all_met = [F.count("*").alias("n_all")], F.lit(True)
    for name in names:
        all_met = all_met & F.col(f"_m.{name}")
        sums.append(F.coalesce(F.sum(F.when(all_met, 1).otherwise(0)), F.lit(0)).cast("bigint").alias(f"n_{name}"))
    counted = rows.agg(*sums)
    return counted.select("*", *[F.round(100 * F.col(f"n_{n}") / F.greatest("n_all", F.lit(1)), 2).alias(f"pct_{n}") for n in names])
