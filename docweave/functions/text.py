"""Text expressions: cleaning, keys, ratios, tokens and sentences. All of them run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.find import find_all, let, replace_matches
from docweave.functions.patterns import any_of

# What counts as an abbreviation before a full stop, contracted endings, endings of host names.
ABBREVIATIONS = ("Inc", "Corp", "Ltd", "Llc", "No", "Nos", "Vol", "vs", "p", "pp", "etc", "Etc", "St", "e.g", "i.e")
CONTRACTED = ("s", "re", "ve", "t", "m", "ll", "d")
HOST_ENDINGS = ("com", "org", "net", "io", "co", "uk", "edu", "gov", "me", "dev", "ai", "app")


def strip(text: Column) -> Column:
    """Without white space at the ends (of any kind; ``trim`` takes spaces only)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def is_blank(text: Column) -> Column:
    """Whether nothing is left of a text without white space: what ``strip(text) == ""`` says, at the first other character."""
    return ~text.rlike(r"\S")


def collapse(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", " ")


#: A line that is drawn with dashes or equals signs, and a blank to fill in.
_DRAWN = "[=\u2013\u2014-]{2,}+"
_BLANK = "_(?: _|_)_*+"


def clean_block(text: Column) -> Column:
    """Drawn lines (two dashes or equals signs or more, underscores or blanks to fill in) become one spaced em dash; white space collapses."""
    return F.trim(collapse(F.regexp_replace(text, f"{_DRAWN}|{_BLANK}", " — ")))


def dedupe_key(text: Column) -> Column:
    """What two blocks must share to be the same: lower case, one space, no punctuation at the end."""
    return strip(collapse(F.regexp_replace(F.lower(text), r"[\s.,;:!?]+$", "")))


def count_of(text: Column, characters: str) -> Column:
    """How many characters are in a regular-expression class; each run of them is one match."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]++", ""))


def ratio(text: Column, characters: str, of: str | None = None) -> Column:
    """The share of characters in a class, of all or of those in another class; 0 where there are none."""
    whole = F.length(text) if of is None else count_of(text, of)
    return count_of(text, characters) / F.greatest(whole, F.lit(1))


def alpha_ratio(text: Column) -> Column:
    return ratio(text, "A-Za-z")


def digit_ratio(text: Column) -> Column:
    return ratio(text, "0-9")


def upper_ratio(text: Column) -> Column:
    return ratio(text, r"\p{Lu}", r"\p{L}")


def average_line(text: Column) -> Column:
    """The mean length of the lines that aren't blank; 999 if all are."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"\S"))
    total = F.aggregate(lines, F.lit(0), lambda n, x: n + F.length(x))
    return F.when(F.size(lines) == 0, F.lit(999.0)).otherwise(total / F.size(lines))


#: Marks that stand at the word before them; those that part what follows are _PARTING, a full stop parts unless it ends an initial.
_MARKS = r"[,.;:!?#*=~_-]"
_PARTING = "[,;:!?]"


def tidy(text: Column) -> Column:
    """White space and punctuation in order: none before marks, marks not doubled, one space after them."""

    def squeezed(group: Column) -> Column:
        marks = F.split(F.regexp_replace(group, r"\s", ""), "")
        return F.array_join(F.filter(marks, lambda m, i: (i == 0) | (m != F.get(marks, i - 1))), "")

    even = replace_matches(F.trim(collapse(text)), rf"\s{_MARKS}(?:\s?{_MARKS})*+|{_MARKS}(?:\s?{_MARKS})++", squeezed)
    apart = F.regexp_replace(even, rf"(?<={_PARTING})(?=[A-Za-z])|(?<=\.)(?<!\b[A-Z]\.)(?=[A-Za-z])", " ")
    return F.regexp_replace(apart, rf"\s+(?='(?i:{any_of(CONTRACTED)})\b)", "")


#: A host is labels and an ending that hosts have; an address is one with its path, or what a scheme or ``www.`` begins. No
#: punctuation ends it, as that is the sentence's.
HOST = rf"\b(?:[a-z0-9-]+\.)+{any_of(HOST_ENDINGS)}\b"
ADDRESS = rf"(?i)(?:\bhttps?:\S+|\bwww\.\S+|{HOST}(?:/\S*)?)(?<![\p{{Punct}}&&[^/]])"
# What frames a page's number or begins a bulleted line.
BULLETS = "|*•_#"
FRAMES = "-–—" + BULLETS
_PAGE_DIGITS = 3


def _short(number: Column) -> Column:
    return F.length(number) <= _PAGE_DIGITS


def without_page_tags(text: Column) -> Column:
    """Page tags go, and a page's number (a whole number of three digits at most) beside one with them."""

    def left(m: Column) -> Column:
        numbers = F.filter(F.split(m, r"(?i)\s*<page>\s*"), lambda n: (n != "") & ~_short(n))
        return F.array_join(numbers, " ")

    return replace_matches(text, r"(?i)(?:(?<![\w.,])\d+\s*)?<page>(?:\s*\d+(?![\w.,]))?", left)


def without_framed_numbers(text: Column) -> Column:
    """Page numbers between two runs of dashes, bars, bullets or underscores go with their frame."""
    frame = f"[{FRAMES}]"
    return replace_matches(text, rf"{frame}+\s*\d+\s*{frame}+(?!\d)", lambda m: F.when(_short(F.regexp_extract(m, r"\d+", 0)), "").otherwise(m))


def without_leaders(text: Column) -> Column:
    """Four leader dots or more (dots or underscores, spaced or not) go with the page number behind them."""

    def left(m: Column) -> Column:
        drawn = F.length(F.translate(m, "0123456789 \t\n\r", ""))
        return F.when((drawn >= 4) & _short(F.regexp_extract(m, r"\d+", 0)), "").otherwise(m)

    return replace_matches(text, r"[._][._\s]*\d+\b(?!,)", left)


#: How a list's number looks at a text's start: digits closed by a mark, or a section's dotted numbers before a capital.
LISTED = (r"^\d++[\s.)\]:–—-]*[.)\]:–—-]\s++", r"^\d{1,3}+(?:\.\d{1,3}+)+\s++(?=\p{Lu})")


def clean_document_text(text: Column, starts_with_money: Column | None = None, company: str = "the Company") -> Column:
    """Page tags, page numbers, links, bullets, dot leaders and list numbers go; then ``tidy``.

    List numbers stay where ``starts_with_money`` holds, so an amount at the start survives.
    """
    out = without_framed_numbers(without_page_tags(strip(text)))
    out = F.ltrim(F.regexp_replace(out, ADDRESS, ""), F.lit(f"{BULLETS} \t\r\n"))
    out = strip(without_leaders(out))
    unlisted = rewritten(out, [(p, "") for p in LISTED])
    out = unlisted if starts_with_money is None else F.when(starts_with_money, out).otherwise(unlisted)
    return tidy(F.regexp_replace(out, r"\b[Uu]s\b", company))


def ascii_text(text: Column) -> Column:
    """Dashes, quotes and fixed spaces as ASCII, then compatibility decomposition without what is left beyond ASCII."""

    def of(own: Column) -> Column:
        plain = F.translate(own, "‐‑‒–—―‘’‚“”„   ", "------'''\"\"\"   ")
        return F.when(own.rlike(r"[^\x00-\x7F]"), let(plain, beyond)).otherwise(own)

    def beyond(plain: Column) -> Column:
        parts = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), plain, F.lit(True))
        return F.when(plain.rlike(r"[^\x00-\x7F]"), F.regexp_replace(parts, r"[^\x00-\x7F]", "")).otherwise(plain)

    return let(text, of)


def match_key(text: Column) -> Column:
    """Lower-case letters and digits, other runs one space."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def without_markup_noise(text: Column) -> Column:
    """Page tags, ``- 12 -`` page numbers, header tags and links go."""
    out = F.regexp_replace(text, r"(?i)</?PAGE>", "")
    out = F.regexp_replace(out, r"(?m)^\s*-\s*\d{1,3}\s*-\s*$", "")
    out = F.regexp_replace(out, r"(?im)^<(?:TYPE|SEQUENCE|FILENAME|DESCRIPTION|TEXT)>.*$", "")
    return F.regexp_replace(out, ADDRESS, "")


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text, wrapped lines joined; tables (``<TABLE>`` to ``</TABLE>``) are paragraphs of their own, as they are."""

    def cut(marked: Column) -> Column:
        # without a table in it no blank line of a text is inside one, and nothing need be looked for behind each
        plain = ~F.contains(marked, F.lit("\u0001")) & ~F.contains(marked, F.lit("</TABLE>"))
        return F.when(plain, F.split(marked, r"\n\s*\n")).otherwise(F.split(marked, r"\n\s*\n(?=[^\u0001]*(?:\u0001|\z))(?![^\u0001]*</TABLE>)"))

    def joined(p: Column) -> Column:
        return F.when(p.startswith("\u0001"), F.substring(p, 2, 1 << 30)).when(F.contains(p, F.lit("\n")), F.regexp_replace(p, r"[ \t]*\n[ \t]*", " ")).otherwise(p)

    marked = F.regexp_replace(text, r"(?is)(<TABLE\b.*?</TABLE>)", "\n\n\u0001$1\n\n")
    return F.filter(F.transform(let(marked, cut), lambda p: strip(joined(p))), lambda p: p != "")


def tokens(text: Column) -> Column:
    """Words (with inner hyphens and apostrophes) and single other characters."""
    return F.regexp_extract_all(text, F.lit(r"(?U)\w+(?:[-']\w+)*|[^\w\s]"), F.lit(0))


#: White space at which a sentence may end, and the last characters before it that say it doesn't.
_MAY_END = r"(?<=[.!?])\s+(?=[A-Z0-9_<])"
_NO_END = rf"(?:^|\W)(?:[A-Z]|{any_of(ABBREVIATIONS)})\.$"
_LONGEST = 2 + max(map(len, ABBREVIATIONS))


def sentences(text: Column) -> Column:
    """array<struct<start, end, text>>: sentences with their places; abbreviations and initials end none."""

    def ends(m: Column) -> Column:
        back = F.least(m["start"], F.lit(_LONGEST))
        return ~F.substring(text, m["start"] - back + 1, back).rlike(_NO_END)

    def cut(found: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), F.transform(found, lambda m: m["end"]))
        stops = F.concat(F.transform(found, lambda m: m["start"]), F.array(F.length(text)))
        pieces = F.zip_with(starts, stops, lambda a, b: F.struct(a.alias("start"), b.alias("end"), F.substring(text, a + 1, b - a).alias("text")))
        return F.filter(pieces, lambda s: s["end"] > s["start"])

    return let(F.filter(find_all(text, _MAY_END), ends), cut)


# Words that part a sentence into clauses.
CLAUSE_WORDS = (
    "while", "although", "whereas", "but", "however", "except", "aside", "apart", "yet",
    "compare", "compared", "comparing", "comparison", "exclude", "excludes", "excluding", "other than",
)
#: So do commas, but not before "or", and colons and semicolons, but not inside a number or a time.
CLAUSE_END = rf"(?i)\b{any_of(CLAUSE_WORDS)}\b|,(?!\s+or)|[:;](?!(?<=\d[:;])\d)"


def clause(text: Column, start: Column, end: Column) -> Column:
    """struct<start, end>: the clause around a span."""

    def bounds(cuts: Column) -> Column:
        left = F.aggregate(cuts, F.lit(0), lambda n, m: F.when(m["end"] <= start, m["end"]).otherwise(n))
        right = F.array_min(F.transform(F.filter(cuts, lambda m: m["start"] >= end), lambda m: m["start"]))
        return F.struct(left.alias("start"), F.coalesce(right, F.length(text)).alias("end"))

    return let(find_all(text, CLAUSE_END), bounds)


def rewritten(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """A text after (pattern, replacement) rules, in order; groups are $1, $2, ..."""
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def unbracketed(text: Column) -> Column:
    return F.translate(text, "<>", "")


def unbracketed_at(text: Column, place: Column) -> Column:
    """Where a place in a text is once ``<`` and ``>`` are gone."""
    return place - count_of(F.substring(text, F.lit(1), place), "<>")


def decided(*parts: Column) -> Column:
    """A number below 2 ** 32 that the parts decide, alike in every run and every engine."""
    return stable_hash(F.concat_ws("|", *[p.cast("string") for p in parts]))


def stable_hash(text: Column) -> Column:
    """A number from the low 32 bits of the MD5 digest."""
    return F.conv(F.substring(F.md5(text), 25, 8), 16, 10).cast("bigint")
