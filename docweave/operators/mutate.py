"""Variations of numbers that keep their labels: scaled, shifted, restyled, re-united, in another currency.

Random choices are functions of a seed and the row's own values, so a rerun, another partitioning or another cluster
makes the same variations.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions import numbers as nm
from docweave.functions import text as tx
from docweave.functions import vocabulary as v
from docweave.functions.find import let, replace_matches
from docweave.functions.patterns import NUMBER, any_of

STRATEGIES = ("preserve", "shared_scale", "shared_offset", "shared_affine", "independent_scale", "independent_offset", "random")
# By the largest magnitude, how far a scale may go.
SCALES = ((10, 1.5, 6.0), (100, 1.2, 4.0), (1_000, 0.75, 3.0), (100_000, 0.25, 3.0))
BEYOND = (0.05, 2.0)
OFFSET = 0.75


def uniform(low: Column | float, high: Column | float, *parts: Column) -> Column:
    """A number from low to high that the parts decide."""
    low, high = (x if isinstance(x, Column) else F.lit(float(x)) for x in (low, high))
    return low + (high - low) * (tx.decided(*parts) / float(1 << 32))


def chosen(options: list[Column], *parts: Column) -> Column:
    """One of some expressions, as the parts decide."""
    return F.array(*options)[(tx.decided(*parts) % len(options)).cast("int")]


def _scale(magnitude: Column, *parts: Column) -> Column:
    out = F.when(magnitude == 0, uniform(1.2, 4.0, *parts))
    for bound, low, high in SCALES:
        out = out.when(magnitude < bound, uniform(low, high, *parts))
    return out.otherwise(uniform(*BEYOND, *parts))


def _offset(magnitude: Column, *parts: Column) -> Column:
    return uniform(-OFFSET, OFFSET, *parts) * F.greatest(magnitude, F.lit(10.0))


def numbers(values: Column, seed: Column, strategy: str = "shared_scale") -> Column:
    """An array of doubles varied: whole ones stay whole, none becomes negative or zero.

    Shared strategies draw once per array, independent ones once per number.
    """
    if strategy not in STRATEGIES:
        raise ValueError(strategy)
    if strategy == "random":
        shared = [numbers(values, seed, s) for s in STRATEGIES[1:4]]
        lone = [numbers(values, seed, s) for s in STRATEGIES[4:6]]
        return F.when(F.size(values) == 1, chosen([*shared, *lone], seed, F.lit("pick"))).otherwise(chosen(shared, seed, F.lit("pick")))
    return let(values, lambda own: let(F.coalesce(F.array_max(F.transform(own, F.abs)), F.lit(0.0)), lambda largest: _vary(own, largest, seed, strategy)))


def _vary(values: Column, largest: Column, seed: Column, strategy: str) -> Column:

    def vary(n: Column, i: Column) -> Column:
        lone = [seed, i, F.lit("n")]
        out = {
            "preserve": lambda: n,
            "shared_scale": lambda: n * _scale(largest, seed, F.lit("s")),
            "shared_offset": lambda: n + _offset(largest, seed, F.lit("o")),
            "shared_affine": lambda: n * _scale(largest, seed, F.lit("s")) + _offset(largest, seed, F.lit("o")),
            "independent_scale": lambda: n * _scale(F.abs(n), *lone),
            "independent_offset": lambda: n + _offset(F.abs(n), *lone),
        }[strategy]()
        whole = F.when(n == F.floor(n), F.round(out)).otherwise(F.round(out, 2))
        return whole if strategy == "preserve" else let(F.abs(whole), lambda x: F.when(x == 0, F.greatest(F.lit(1.0), F.abs(n))).otherwise(x))

    return F.transform(values, vary)


def _first_number(text: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(text, f"({NUMBER})", 1), ",", "").try_cast("double")


def _with_number(text: Column, figure: Column) -> Column:
    """A text with its first number replaced."""
    return F.concat(F.regexp_extract(text, rf"(?s)^(.*?){NUMBER}", 1), figure, F.regexp_extract(text, rf"(?s)^.*?{NUMBER}(.*)$", 1))


def _formatted(n: Column, *parts: Column) -> Column:
    small, middle = [nm.plain(n), nm.with_commas(n)], [nm.with_commas(n), nm.in_magnitude(n)]
    large = [nm.with_commas(n), nm.in_magnitude(n), nm.in_magnitude(n, "short"), nm.in_magnitude(n, "financial")]
    return F.when(n < 1e3, chosen(small, *parts)).when(n < 1e5, chosen(middle, *parts)).otherwise(chosen(large, *parts))


def _varied(text: Column, seed: Column, strategy: str) -> Column:
    return numbers(F.array(_first_number(text)), seed, strategy)[0]


def _of(text: Column, seed: Column, body) -> Column:
    """``body`` over a text and a seed that are evaluated once."""
    return let(F.struct(text.alias("t"), seed.alias("s")), lambda x: body(x["t"], x["s"]))


def money(text: Column, seed: Column, strategy: str = "shared_scale") -> Column:
    """An amount varied and restyled; no decimals from 10,000 on."""
    return _of(text, seed, lambda t, s: _money(t, s, strategy))


def _money(text: Column, seed: Column, strategy: str) -> Column:
    bare = F.regexp_replace(text, r"(?i)\s*(?:thousand|million|billion|trillion|mm|bn|[kmbt])\b", "")
    n = let(_varied(text, seed, strategy), lambda x: F.when(x >= 10_000, F.round(x)).otherwise(x))
    return let(n, lambda x: _with_number(bare, _formatted(x, seed, F.lit("f"))))


def percent(text: Column, seed: Column, strategy: str = "shared_scale") -> Column:
    return _with_number(text, nm.plain(F.least(F.round(_varied(text, seed, strategy), 2), F.lit(999.0))))


def shares(text: Column, seed: Column, strategy: str = "shared_scale") -> Column:
    return let(F.round(_varied(text, seed, strategy)), lambda n: _with_number(text, chosen([nm.plain(n), nm.with_commas(n)], seed, F.lit("f"))))


def quantity(text: Column, seed: Column, strategy: str = "shared_scale") -> Column:
    """A quantity in another unit of its dimension, converted and varied."""
    out = F.when(F.lit(False), text)
    for dimension in dict.fromkeys(u[1] for u in v.UNITS):
        own = [u for u in v.UNITS if u[1] == dimension and not u[3]]
        to_base = F.create_map(*[F.lit(x) for u in own for x in (u[0].lower(), u[2])])
        surface = F.regexp_extract(F.lower(text), rf"({any_of(u[0] for u in own)})s?\b", 1)
        names, factors = F.array(*[F.lit(u[0]) for u in own]), F.array(*[F.lit(u[2]) for u in own])
        pick = (tx.decided(seed, F.lit("unit")) % len(own)).cast("int")
        n = numbers(F.array(_first_number(text) * to_base[surface] / factors[pick]), seed, strategy)[0]
        form = F.concat(nm.with_commas(F.round(n, 3)), F.lit(" "), names[pick], F.when(names[pick].rlike("(?:feet|foot|inch)$"), "").otherwise("s"))
        out = out.when((surface != "") & text.rlike(rf"(?i)\b{any_of(u[0] for u in own)}s?\b"), form)
    return out.otherwise(_with_number(text, nm.plain(_varied(text, seed, strategy))))


def reference(text: Column, seed: Column) -> Column:
    """A reference to another number of the same width, never the same."""

    def other(m: Column) -> Column:
        top = F.pow(F.lit(10.0), F.length(m)).cast("bigint")
        step = 1 + tx.decided(seed, m) % (top - 1)
        return _fit(F.pmod(m.cast("bigint") + step, top), F.length(m))

    return replace_matches(text, r"\b\d{1,15}", other)


def _fit(n: Column, width: Column) -> Column:
    text = n.cast("string")
    return F.concat(F.repeat(F.lit("0"), width - F.length(text)), text)


def time(text: Column, seed: Column) -> Column:
    """A date up to ten years away, or a year up to 25 years away (1900 to 2100); other times restyled as they are."""
    date = F.try_to_date(F.regexp_extract(text, r"([A-Z][a-z]+ \d{1,2}, \d{4})", 1), "MMMM d, yyyy")
    moved = F.date_add(date, F.round(uniform(-3650, 3650, seed, F.lit("d"))).cast("int"))
    year = F.regexp_extract(text, r"\b((?:19|20)\d{2})\b", 1).try_cast("int")
    other = F.greatest(F.lit(1900), F.least(F.lit(2100), year + F.round(uniform(-25, 25, seed, F.lit("y"))).cast("int")))
    return F.when(date.isNotNull(), F.date_format(moved, "MMMM d, yyyy")).when(year.isNotNull(), F.concat(F.regexp_extract(text, r"^(.*?)\b(?:19|20)\d{2}\b", 1), other.cast("string"), F.regexp_extract(text, r"\b(?:19|20)\d{2}\b(.*)$", 1))).otherwise(text)


def worker_terms(text: Column, seed: Column) -> Column:
    """A text whose words for workers are replaced by the next of their pool but ``seed`` - 1; plurals and pools stay."""
    out = text
    for pool in v.WORKER_POOLS.values():
        names = F.array(*[F.lit(w) for w in pool])
        out = replace_matches(out, rf"(?i)\b{any_of(pool)}\b", _next_of(names, len(pool), seed))
    return out


def _next_of(names: Column, n: int, seed: Column):
    return lambda m: F.get(names, F.pmod(F.array_position(names, F.lower(m)) - 1 + seed, F.lit(n)).cast("int"))


def span_text(text: Column, label: Column, seed: Column) -> Column:
    """A span varied as its label asks."""
    return let(F.struct(text.alias("t"), label.alias("l"), seed.alias("s")), lambda x: _span_text(x["t"], x["l"], x["s"]))


def _span_text(text: Column, label: Column, seed: Column) -> Column:
    return (
        F.when(label == "TIME", time(text, seed))
        .when(label == "MONEY", money(text, seed))
        .when(label.startswith("PCT"), percent(text, seed))
        .when(label == "SHARE", shares(text, seed))
        .when(label == "REFERENCE", reference(text, seed))
        .when(label.isin("PROPER_NUM", "ADDRESS"), text)
        .otherwise(nm.restyled(text))
    )
