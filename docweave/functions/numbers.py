"""Numbers in prose: words to figures, figures to words, and one way of writing each. Catalyst expressions throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions import vocabulary as v
from docweave.functions.find import gaps, let, replace_matches
from docweave.functions.patterns import FIGURE, UNTIL, any_of
from docweave.functions.text import stable_hash, tidy

_SCALE = "|".join(v.SCALES)
_SYMBOLS = any_of([s for c in v.CURRENCIES for s in c[1] if not s[-1].isalpha()])
_WORD = f"(?:{'|'.join([*v.ONES, *v.TENS])})"
_NUMERAL = f"(?:{'|'.join([*v.ONES, *v.TENS, *v.SCALES, 'point'])})"
# Percent in words.
_PERCENT = ("percent", "per cent", "per-cent")


def _values(words: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for w, n in words.items() for x in (w, float(n))])


def plain(number: Column) -> Column:
    """A number (double) as a string without exponent or trailing zeros."""
    return F.regexp_replace(number.cast("decimal(38,8)").cast("string"), r"\.?0+$", "")


def bracketed(text: Column) -> Column:
    """Standalone numbers of four or five digits in ``<>``, so that years and postal codes can be told later."""
    return F.regexp_replace(text, r"(?<![\w.)\]-])\b(\d{4,5}(?:\.\d+)*(?:-\d+)*)\b", "<$1>")


def fraction_words(text: Column) -> Column:
    """three-fourths as 75%."""
    pattern = rf"(?i)\b(?:{'|'.join(v.ONES)})-(?:{'|'.join(v.FRACTIONS)})s?\b"

    def percent(m: Column) -> Column:
        parts = F.split(F.lower(m), "-")
        below = F.coalesce(_values(v.FRACTIONS)[parts[1]], _values(v.FRACTIONS)[F.regexp_replace(parts[1], "s$", "")])
        return F.concat(plain(F.round(_values(v.ONES)[parts[0]] / below * 100, 4)), F.lit("%"))

    return replace_matches(text, pattern, percent)


def loose_amounts(text: Column) -> Column:
    """a few, a, half a, a quarter of a, three quarters of a: before a scale, as figures or words of figures.

    ``a`` alone counts only where no part of a whole or ``few`` has claimed it, so the parts come first.
    """
    parts = {r"three\s+quarters": 0.75, r"a\s+quarter": 0.25, "half": 0.5}
    rules = [(rf"{part}\s+(?:of\s+)?(?:a\s+)?", f"{share} ") for part, share in parts.items()]
    for phrase, figure in [*rules, (r"a\s+few\s+", "three "), (r"a\s+", "one ")]:
        text = F.regexp_replace(text, rf"(?i)\b{phrase}(?=(?:{_SCALE})\b)", figure)
    return text


def word_value(phrase: Column) -> Column:
    """What a phrase of number words stands for; ``and`` is skipped."""
    figures, scales = _values({**v.ONES, **v.TENS}), _values(v.SCALES)
    words = F.filter(F.split(F.regexp_replace(F.lower(phrase), r"[\s-]+", " "), " "), lambda w: w != "and")
    zero = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("part"), F.lit(0.0).alias("digit"))

    def step(acc: Column, w: Column) -> Column:
        n, scale = figures[w], scales[w]
        part = (
            F.when(w == "point", acc["part"])
            .when(n.isNotNull() & (acc["digit"] > 0), acc["part"] + n * acc["digit"])
            .when(n.isNotNull(), acc["part"] + n)
            .when(scale <= 100, F.when(acc["part"] == 0, 1.0).otherwise(acc["part"]) * scale)
            .otherwise(F.lit(0.0))
        )
        total = acc["total"] + F.when(scale > 100, F.when(acc["part"] == 0, 1.0).otherwise(acc["part"]) * scale).otherwise(F.lit(0.0))
        digit = F.when(w == "point", F.lit(0.1)).when(n.isNotNull() & (acc["digit"] > 0), acc["digit"] / 10).when(scale.isNotNull(), F.lit(0.0)).otherwise(acc["digit"])
        return F.struct(total.alias("total"), part.alias("part"), digit.alias("digit"))

    return F.aggregate(words, zero, step, lambda acc: acc["total"] + acc["part"])


def number_words(text: Column) -> Column:
    """Phrases of number words as figures. ``and`` joins only after hundred or thousand."""
    more = rf"(?:[\s-]+(?:(?<=hundred\s)and\s+|(?<=thousand\s)and\s+)?{_NUMERAL})*"
    return replace_matches(text, rf"(?i)\b{_WORD}{more}\b", lambda m: plain(F.round(word_value(m), 8)))


def no_group_commas(text: Column) -> Column:
    return F.regexp_replace(text, r"(?<=\d),(?=\d{3})", "")


def _scaled(figure: Column, scale: Column) -> Column:
    return plain((figure.cast("decimal(24,8)") * _values(v.SCALES)[F.lower(scale)].cast("decimal(14,0)")).cast("double"))


def scales_out(text: Column) -> Column:
    """2 million as 2000000, (2) million as (2000000); the words around keep their spaces."""
    pattern = rf"(?i)\(\s*\d+(?:\.\d+)?\s*\)\s*(?:{_SCALE})\b|\b\d+(?:\.\d+)?\s+(?:{_SCALE})\b"

    def figure(m: Column) -> Column:
        n = _scaled(F.regexp_extract(m, r"(\d+(?:\.\d+)?)", 1), F.regexp_extract(m, r"([A-Za-z]+)$", 1))
        return F.when(m.startswith("("), F.concat(F.lit("("), n, F.lit(")"))).otherwise(n)

    return replace_matches(text, pattern, figure)


def symbol_scales_out(text: Column) -> Column:
    """42.7 € million as €42700000."""
    pattern = rf"(?i)(?:\d{{1,3}}(?:,\d{{3}})+(?:\.\d+)?|\d+(?:\.\d+)?)\s*{_SYMBOLS}\s*(?:{_SCALE})\b"

    def figure(m: Column) -> Column:
        n = F.regexp_replace(F.regexp_extract(m, r"^([\d,.]+)", 1), ",", "")
        return F.concat(F.regexp_extract(m, rf"({_SYMBOLS})", 1), _scaled(n, F.regexp_extract(m, r"([A-Za-z]+)$", 1)))

    return replace_matches(text, pattern, figure)


def said_twice(text: Column) -> Column:
    """15 (15) as 15, where both are the same number."""

    def once(m: Column) -> Column:
        both = F.regexp_extract_all(m, F.lit(r"\d+(?:\.\d+)?"), F.lit(0))
        return F.when(both[0].cast("double") == both[1].cast("double"), both[0]).otherwise(m)

    return replace_matches(text, r"\b\d+(?:\.\d+)?\s*\(\s*\d+(?:\.\d+)?\s*\)", once)


def percents(text: Column) -> Column:
    """per cent as %, no space before %, and ranges as a% to b%."""
    signs = F.regexp_replace(text, rf"(?i)\b{any_of(_PERCENT)}\b", "%")
    close = F.regexp_replace(signs, r"(?<=[\d)])\s+%", "%")
    return F.regexp_replace(close, rf"(?i)(?<![\w.])({FIGURE})%?\s*{UNTIL}\s*(?={FIGURE}%)", "$1% to ")


def normalized(text: Column) -> Column:
    """All of the above, in the order that gives each step what it needs."""
    for step in (symbol_scales_out, bracketed, fraction_words, loose_amounts, number_words, no_group_commas, scales_out, said_twice):
        text = step(text)
    return tidy(percents(F.regexp_replace(text, r"(?:^|(?<=\s))\.(\d+)\b", "0.$1")))


# ---------------------------------------------------------------- figures to words


def _below_thousand(n: Column) -> Column:
    ones, tens = F.array(*[F.lit(w) for w in v.ONES]), F.array(F.lit(""), F.lit("ten"), *[F.lit(w) for w in v.TENS])
    rest = n % 100
    tail = F.when(rest < 20, ones[rest]).when(rest % 10 == 0, tens[F.floor(rest / 10).cast("int")]).otherwise(F.concat(tens[F.floor(rest / 10).cast("int")], F.lit("-"), ones[rest % 10]))
    head = F.concat(ones[F.floor(n / 100).cast("int")], F.lit(" hundred"))
    return F.when(n < 100, tail).when(rest == 0, head).otherwise(F.concat(head, F.lit(" "), tail))


def in_words(number: Column) -> Column:
    """A whole number below a quadrillion in English words."""

    def words(n: Column) -> Column:
        groups = F.array(*[F.floor(n / 1000**k).cast("bigint") % 1000 for k in (4, 3, 2, 1, 0)])
        names = F.array(*map(F.lit, (" trillion", " billion", " million", " thousand", "")))
        parts = F.zip_with(groups, names, lambda g, name: F.when(g > 0, F.concat(_below_thousand(g.cast("int")), name)))
        return F.when(n == 0, "zero").otherwise(F.array_join(F.filter(parts, lambda p: p.isNotNull()), " "))

    whole = number.cast("bigint")
    return F.when(whole < 0, F.concat(F.lit("minus "), let(-whole, words))).otherwise(let(whole, words))


def with_commas(number: Column) -> Column:
    """Groups of three digits; decimals stay as they are."""
    return let(plain(number), lambda n: F.concat(F.regexp_replace(F.regexp_extract(n, r"^(-?\d+)", 1), r"(?<=\d)(?=(?:\d{3})+$)", ","), F.regexp_extract(n, r"(\.\d+)$", 1)))


_MAGNITUDES = ((1e12, " trillion", "T", "T"), (1e9, " billion", "B", "B"), (1e6, " million", "M", "MM"), (1e3, " thousand", "K", "M"))


def in_magnitude(number: Column, style: str = "long") -> Column:
    """2.5 million, 2.5M or 2.5MM: style long, short or financial."""
    return let(number, lambda n: _magnitude(n, style))


def _magnitude(number: Column, style: str) -> Column:
    which = {"long": 1, "short": 2, "financial": 3}[style]
    out = None
    for row in _MAGNITUDES:
        form = F.concat(plain(F.round(number / row[0], 2)), F.lit(row[which]))
        out = F.when(F.abs(number) >= row[0], form) if out is None else out.when(F.abs(number) >= row[0], form)
    return out.otherwise(plain(number))


def in_short_words(number: Column) -> Column:
    """In words where that takes two at most, else with commas."""
    return let(number, lambda n: let(in_words(n), lambda w: F.when((n == F.floor(n)) & (F.size(F.split(w, " ")) <= 2), w).otherwise(with_commas(n))))


def restyled(text: Column, style: str = "random") -> Column:
    """Whole numbers in a text as they are, with commas, or in words; random chooses by place and digits, always alike."""

    def form(m: Column, i: Column) -> Column:
        n = m.cast("decimal(20,0)").cast("double")
        choice = {"original": F.lit(0), "commas": F.lit(1), "words": F.lit(2)}.get(style, F.pmod(i + stable_hash(m), F.lit(3)))
        return F.when((choice == 0) | (F.length(m) > 15), m).when(choice == 1, with_commas(n)).otherwise(in_short_words(n))

    def of(t: Column) -> Column:
        def rebuilt(found: Column) -> Column:
            parts = F.concat(F.transform(found, form), F.array(F.lit("")))
            return F.array_join(F.zip_with(gaps(t, r"\b\d+\b"), parts, lambda g, m: F.concat(g, m)), "")

        return F.when(t.rlike(r"\d"), let(F.regexp_extract_all(t, F.lit(r"\b\d+\b"), F.lit(0)), rebuilt)).otherwise(t)

    return let(text, of)


def rounded(number: Column, digits: int) -> Column:
    """A number to so many significant digits."""
    scale = F.pow(F.lit(10.0), F.floor(F.log10(F.greatest(F.abs(number), F.lit(1e-12)))) - (digits - 1))
    return F.when(number == 0, F.lit(0.0)).otherwise(F.round(number / scale) * scale)
