"""Matches with their places, and what is done with lists of spans: claims, merges, distances."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def running(numbers: Column) -> Column:
    """For each int of an array the sum of those before it, by chunks: long arrays cost little more than their length."""

    def whole(own: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / CHUNK).cast("int")), lambda c: _sum(F.slice(own, c * CHUNK + 1, F.lit(CHUNK))))

        def offsets(sums: Column) -> Column:
            return let(F.transform(sums, lambda _, c: _sum(F.slice(sums, F.lit(1), c))), rows)

        def rows(starts: Column) -> Column:
            return F.transform(own, lambda _, i: starts[F.floor(i / CHUNK).cast("int")] + _sum(F.slice(own, F.floor(i / CHUNK).cast("int") * CHUNK + 1, i % CHUNK)))

        return let(chunks, offsets)

    return F.when(F.size(numbers) > 0, let(numbers, whole)).otherwise(F.array().cast("array<int>"))


#: Stands for a match while a text is cut at its matches.
MARK = "\uE00F"


def gaps(text: Column, pattern: str) -> Column:
    """What is before, between and behind the matches of a pattern that never matches nothing.

    ``split`` compiles its pattern anew for every text, ``regexp_replace`` once; so matches become a mark, and the text is
    cut there. Texts that hold the mark themselves are split.
    """
    return F.when(F.contains(text, F.lit(MARK)), F.split(text, pattern, -1)).otherwise(F.split(F.regexp_replace(text, pattern, MARK), MARK, -1))


def find_all(text: Column, pattern: str) -> Column:
    """array<struct<start, end, text>> of all matches of a pattern that never matches nothing; offsets in code points.

    Spark has no function that tells where matches are; the pieces between them do.
    """

    def of(t: Column) -> Column:
        def places(found: Column) -> Column:
            def cut(between: Column) -> Column:
                steps = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda g, m: F.length(g) + F.length(m))
                return let(running(steps), lambda sums: F.transform(found, lambda m, i: _span(sums[i] + F.length(between[i]), m)))

            return F.when(F.size(found) > 0, let(gaps(t, pattern), cut)).otherwise(F.array().cast("array<struct<start:int,end:int,text:string>>"))

        return let(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), places)

    return let(text, of)


#: Stands where a match begins and ends; a character of one byte, as texts of those are cut fastest.
EDGE = "\u0001"


def marked(text: Column, pattern: str) -> Column:
    """A text without ``EDGE``, cut at each match's start and end: what is before, the match, what is between, the next match and so on."""
    return F.split(F.regexp_replace(text, pattern, f"{EDGE}$0{EDGE}"), EDGE, -1)


def pieces(cut: Column, rule: int) -> Column:
    """array<struct<start, end, text, rule>> of the matches in what ``marked`` gives; null has none."""

    def span(sizes: Column, i: Column, start: Column) -> Column:
        return F.struct(start.alias("start"), (start + sizes[i]).alias("end"), cut[i].alias("text"), F.lit(rule).alias("rule"))

    def of(sizes: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(sizes) - 1, F.lit(2))
        few = F.transform(at, lambda i: let(_sum(F.slice(sizes, F.lit(1), i)), lambda start: span(sizes, i, start)))
        return F.when(F.size(sizes) <= CHUNK, few).otherwise(let(running(sizes), lambda starts: F.transform(at, lambda i: span(sizes, i, starts[i]))))

    none = F.array().cast("array<struct<start:int,end:int,text:string,rule:int>>")
    return F.when(F.size(cut) > 1, let(F.transform(cut, F.length), of)).otherwise(none)


def _span(start: Column, match: Column) -> Column:
    return F.struct(start.alias("start"), (start + F.length(match)).alias("end"), match.alias("text"))


def overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def claim(spans: Column, kind: str) -> Column:
    """Of spans in order of precedence, those that overlap none kept before."""
    return F.aggregate(spans, F.array().cast(f"array<{kind}>"), lambda kept, s: F.when(F.exists(kept, lambda k: overlap(k, s)), kept).otherwise(F.concat(kept, F.array(s))))


def longest_first(spans: Column) -> Column:
    """Spans by length, longest first, then by start."""
    return F.array_sort(spans, lambda a, b: F.when(a["end"] - a["start"] != b["end"] - b["start"], (b["end"] - b["start"]) - (a["end"] - a["start"])).otherwise(a["start"] - b["start"]))


def merge_near(text: Column, spans: Column, gap: int, connector: str) -> Column:
    """Spans (struct<start, end>, sorted) joined where at most ``gap`` characters that fit ``connector`` part them."""

    def step(kept: Column, s: Column) -> Column:
        last = F.element_at(kept, -1)
        between = F.substring(text, last["end"] + 1, s["start"] - last["end"])
        near = (F.size(kept) > 0) & (s["start"] - last["end"] <= gap) & between.rlike(connector)
        joined = F.concat(F.slice(kept, F.lit(1), F.size(kept) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when(near, joined).otherwise(F.concat(kept, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))))

    return F.aggregate(spans, F.array().cast("array<struct<start:int,end:int>>"), step)


def distance(a: Column, b: Column) -> Column:
    """How many characters part two spans; 0 if they touch or overlap."""
    return F.greatest(F.lit(0), b["start"] - a["end"], a["start"] - b["end"])


def replace_matches(text: Column, pattern: str, make: Callable[[Column], Column]) -> Column:
    """The text with every match m of a pattern (never empty) replaced by ``make(m)``, which may compute."""

    def of(t: Column) -> Column:
        def rebuilt(found: Column) -> Column:
            parts = F.concat(F.transform(found, make), F.array(F.lit("")))
            return F.array_join(F.zip_with(gaps(t, pattern), parts, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")

        return F.when(t.rlike(pattern), let(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), rebuilt)).otherwise(t)

    return let(text, of)


def replace_spans(text: Column, spans: Column, make: Callable[[Column], Column]) -> Column:
    """The text with every span (sorted, disjoint) replaced by ``make(span)``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    joined = F.aggregate(
        spans,
        start,
        lambda acc, s: F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), make(s)).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) == 0, text).otherwise(joined)
