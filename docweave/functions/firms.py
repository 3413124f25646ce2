"""Firms' names in text: hidden while numbers are normalised, and replaced by a token."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions import numbers as nm
from docweave.functions.find import let, replace_matches
from docweave.functions.patterns import any_of

# What a firm's name may end with.
SUFFIXES = ("Inc", "Incorporated", "Corp", "Corporation", "Co", "Company", "Ltd", "Limited", "LLC", "L.L.C", "LP", "L.P", "PLC", "SA", "S.A", "AG", "NV", "N.V", "SE", "Holdings", "Holding", "Group", "Trust")
_SUFFIX = rf"(?:[\s,]+(?:{any_of(SUFFIXES)})\b\.?)"
#: The same in a text, where a full stop at the end is the sentence's.
_SUFFIX_INSIDE = rf"(?:[\s,]+(?:{any_of(SUFFIXES)})\b(?:\.(?!\s*$))?)"
#: Stands for a hidden name.
HIDDEN = ""


def core_name(name: Column) -> Column:
    """A firm's name without what such names end with (as often as it ends so), unless nothing would be left."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.trim(name), r"(?i)^the\s+", ""), rf"(?i){_SUFFIX}+$", ""))
    return F.when(bare == "", F.trim(name)).otherwise(F.regexp_replace(bare, r"[\s,.]+$", ""))


def _quoted(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(name, r"([^\w\s])", r"\\$1"), r"\s+", r"\\s+")


def replaced(text: Column, name: Column, token: str = "the Company") -> Column:
    """A text in which a row's own firm, by its core name and with any endings, is a token. Null and empty names replace nothing."""
    core = core_name(name)
    pattern = F.concat(F.lit(r"(?i)\b(?:the\s+)?"), _quoted(core), F.lit(rf"(?!\w){_SUFFIX_INSIDE}*"))
    return F.when(F.coalesce(F.length(core) > 0, F.lit(False)), F.regexp_replace(text, pattern, F.lit(token))).otherwise(text)


def with_hidden(text: Column, names: Iterable[str], change: Callable[[Column], Column]) -> Column:
    """``change`` applied to a text whose names (any case, whole words) are hidden from it and stand in it again afterwards."""
    pattern = rf"(?<!\w)(?i:{any_of(names)})(?!\w)"
    clean = F.regexp_replace(text, HIDDEN, "")

    def again(found: Column) -> Column:
        parts = F.split(change(replace_matches(clean, pattern, lambda _: F.lit(HIDDEN))), HIDDEN)
        return F.array_join(F.zip_with(parts, found, lambda p, n: F.concat(p, F.coalesce(n, F.lit("")))), "")

    return F.when(clean.rlike(pattern), let(F.regexp_extract_all(clean, F.lit(pattern), F.lit(0)), again)).otherwise(change(clean))


def normalized(text: Column, names: Iterable[str]) -> Column:
    """Numbers normalised, but for those in firms' names."""
    return with_hidden(text, names, nm.normalized)
