"""Phone numbers by the formats of countries: every format's matches, with the country; formats may overlap."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.find import find_all

_SEP = r"[\s.-]"
# Country, its code, and how the rest is grouped: numbers of digits, parted by separators ((n) in brackets).
FORMATS = (
    ("US", None, "(3)3 4"), ("US", "1", "3 3 4"), ("US", "1", "(3)3 4"), ("GB", "44", "2 4 4"), ("GB", "44", "3 3 4"), ("FR", "33", "1 2 2 2 2"),
    ("DE", "49", "2 7"), ("DE", "49", "3 8"), ("JP", "81", "1 4 4"), ("CN", "86", "3 4 4"), ("IN", "91", "5 5"), ("AU", "61", "1 4 4"),
    ("CH", "41", "2 3 2 2"), ("IT", "39", "2 4 4"), ("ES", "34", "3 3 3"),
)


def _pattern(code: str | None, groups: str) -> str:
    parts, out = groups.replace(")", ") ").split(), ""
    for i, g in enumerate(parts):
        part = rf"\(\d{{{g[1:-1]}}}\)\s?" if g.startswith("(") else rf"\d{{{g}}}"
        out += ("" if i == 0 or parts[i - 1].startswith("(") else _SEP) + part
    return rf"(?<![\w+])(?:{'' if code is None else rf'\+{code}{_SEP}?'}{out})(?!\w)"


def found(text: Column) -> Column:
    """array<struct<start, end, text, country>>, by start and then format. Null texts give null."""
    each = [F.transform(find_all(text, _pattern(code, groups)), _with(country)) for country, code, groups in FORMATS]
    return F.array_sort(F.concat(*each))


def _with(country: str):
    return lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["text"].alias("text"), F.lit(country).alias("country"))
