"""Typed spans in text: what is an amount, a share of a hundred, a date, a reference, a head-count, an address.

An extractor is a list of rules; a rule is a label, a pattern and a condition on its match. Extractors claim in order:
what one has claimed is hidden from those after it (as ``~``), and of one extractor's matches the first in order of rule
and place wins. Everything is Catalyst expressions over one text column: no row leaves the JVM.

Texts may carry brackets around numbers of four or five digits (see ``numbers.bracketed``); rules read the text without
them, except for bare years and postal codes, which must have been bracketed. Offsets are those of the bracket-free text.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.functions import vocabulary as v
from docweave.functions.find import EDGE, find_all, let, marked, overlap, pieces
from docweave.functions.places import place_names
from docweave.functions.patterns import FIGURE, NUMBER, RANGE, UNTIL, any_of

KIND = "struct<start:int,end:int,label:string>"
_NONE = f"array<{KIND}>"
Gate = Callable[[Column, Column], Column]


@dataclass(frozen=True)
class Rule:
    """``label`` of what ``pattern`` matches where ``gate(text, match)`` holds; ``bracketed``: only bracketed numbers."""

    label: str | Callable[[Column, Column], Column]
    pattern: str
    gate: Gate | None = None
    bracketed: bool = False
    #: A pattern that a text must hold for the rule to be tried.
    needs: str = r"\d"
    #: Words of which any match (or what its condition asks for) holds one, in lower case; none: matches may be without any.
    words: frozenset[str] = frozenset()
    #: Characters that a match may hold in place of such a word, as a pattern.
    signs: str = ""


@dataclass(frozen=True)
class Extractor:
    name: str
    rules: list[Rule] = field(default_factory=list)


def words(*terms: Iterable[str]) -> frozenset[str]:
    """A run of letters of each term, alone or in the plural. Patterns that part a term from other letters match no text without one."""
    runs = [re.findall("[a-z]+", t.lower()) for own in terms for t in own]
    return frozenset(max(r, key=len) + end for r in runs for end in ("", "s", "es")) if all(runs) else frozenset()


# ---------------------------------------------------------------- context


def in_sentence(text: Column, span: Column, pattern: str) -> Column:
    """Whether the sentence around a span matches: up to the nearest full stops, exclamation or question marks that no digit follows."""
    marks = r"[.!?](?!\d)"
    head = F.element_at(F.split(F.substring(text, F.lit(1), span["start"]), marks), -1)
    tail = F.split(F.substring(text, span["start"] + 1, F.length(text)), marks, 2)[0]
    return F.concat(head, tail).rlike(pattern)


def around(text: Column, span: Column, before: int, after: int) -> Column:
    start = F.greatest(span["start"] - before, F.lit(0))
    return F.substring(text, start + 1, span["end"] - start + after)


def after(text: Column, span: Column, n: int) -> Column:
    return F.substring(text, span["end"] + 1, F.lit(n))


def ahead(text: Column, span: Column, n: int) -> Column:
    start = F.greatest(span["start"] - n, F.lit(0))
    return F.substring(text, start + 1, span["start"] - start)


def in_clause(text: Column, span: Column, pattern: str) -> Column:
    return let(tx.clause(text, span["start"], span["end"]), lambda c: F.substring(text, c["start"] + 1, c["end"] - c["start"]).rlike(pattern))


def value(span: Column) -> Column:
    """The first number of a match."""
    return F.regexp_replace(F.regexp_extract(span["text"], f"({NUMBER})", 1), ",", "").try_cast("double")


def year_like(span: Column, low: int = 1970, high: int = 2050) -> Column:
    return let(value(span), lambda n: (n == F.floor(n)) & n.between(low, high))


def _both(*gates: Gate) -> Gate:
    def gate(text: Column, span: Column) -> Column:
        held = gates[0](text, span)
        for g in gates[1:]:
            held = held & g(text, span)
        return held

    return gate


# ---------------------------------------------------------------- grammar

#: Characters written out, which Java tells by one look at a table; classes such as \w beside others are asked one by one.
_D, _LETTERS = string.digits, string.ascii_letters
_W = f"{_LETTERS}{_D}_"
#: What a number, a figure and an amount begin with: a look at one character before what stands behind the place is asked for.
_AT, _AT_FIGURE, _AT_AMOUNT = rf"(?=[{_D}.])", rf"(?=[{_D}.(-])", rf"(?=[{_D}.(])"
_SIGNS = [s for c in v.CURRENCIES for s in c[1] if not s[-1].isalpha() or len(s) > 2]
_SIGNS_AFTER = ["kr", "zł", "Kč", "Ft", "lei", "€"]
_SYMBOLS = any_of(_SIGNS)
#: ASCII characters that signs begin with; other signs begin with a character beyond ASCII.
_FIRST = "".join(sorted({s[0] for s in _SIGNS if s[0].isascii()})) + r"\x{80}-\x{10FFFF}"
_AFTER_SIGNS = any_of(_SIGNS_AFTER)
_CODES = "(?-i:" + "|".join(c[0] for c in v.CURRENCIES) + ")"
_NAMES = any_of(dict.fromkeys(c[3] for c in v.CURRENCIES if c[3] not in ("pound", "real", "won", "sol", "lira")), plural=True)
_ADJECTIVES = any_of(c[2] for c in v.CURRENCIES)
_LOOSE_NAMES = any_of(["pound", "real", "won", "sol", "lira", "peso", "dollar", "franc", "dinar"], plural=True)
_SCALED = rf"{NUMBER}(?:\s*(?:k|mm|m|bn|b|thousand|million|billion|trillion)\b)?"
_AMOUNT = rf"(?:\(\s*{_SCALED}\s*\)|{_SCALED})"
#: What may stand at a place is told by its character, so most places are left after a look at one. No currency can begin
#: within what an amount takes, so amounts before one give nothing back.
MONEY = (
    rf"(?i)-\s*(?:(?<![\w/]){_SYMBOLS}\s*{_AMOUNT}|\b{_CODES}\s*{_AMOUNT})"
    rf"|(?<![{_W}])(?:(?=[{_FIRST}])(?<!/){_SYMBOLS}\s*{_AMOUNT}|(?-i:(?=[{string.ascii_uppercase}]))\b{_CODES}\s*{_AMOUNT}|(?=[{_LETTERS}])\b{_ADJECTIVES}\s+{_LOOSE_NAMES}\s+{_AMOUNT})"
    rf"|{_AT_AMOUNT}(?:\(\s*{_SYMBOLS}\s*{_SCALED}\s*\)|(?<![{_W}.,])(?>{_AMOUNT})(?:\s*{_CODES}\b|\s*{_AFTER_SIGNS}(?![\w/])|\s+(?:{_ADJECTIVES}\s+{_LOOSE_NAMES}|{_NAMES})\b))"
)
_RATE_WORDS = r"(?i)\b(?:exchange|currency|forward|spot|cross)\s+(?:rates?|prices?|points?|benchmarks?)\b"


def _no_rate_year(text: Column, span: Column) -> Column:
    """Not a year that stands beside a currency code, a currency pair or a rate."""
    near = around(text, span, 32, 48)
    return ~(year_like(span, 1900, 2099) & (near.rlike(rf"\b{_CODES.replace('(?-i:', '(?:')}") | near.rlike(r"\b[A-Z]{3}\s*/\s*[A-Z]{3}\b") | near.rlike(_RATE_WORDS)))


def _no_instrument(text: Column, span: Column) -> Column:
    return ~after(text, span, 48).rlike(rf"(?i)^[-\s,]*{any_of(v.INSTRUMENTS)}s?\b")


_PCT_WORD = r"per[- ]?cent(?:age)?(?:\s+points?)?"
_PCT = rf"{FIGURE}\s*(?:%|{_PCT_WORD})"
_PCT_RANGE = rf"{FIGURE}(?:\s*%)?\s*{UNTIL}\s*{_PCT}"
_PCT_ANY = rf"(?:{_PCT_RANGE}|{_PCT})"
_LINK = r"(?:(?:of|at|is|was|were|are|by|to|an|a|the|for|in)\s+){0,3}"
_DETERMINERS = ("the", "a", "an", "each", "all", "any", "our", "its", "their")
_CHANGE = rf"{any_of(v.CHANGES)}s?"
_RATE = rf"(?:[a-z-]+\s+){{0,2}}{any_of(v.RATE_HEADS)}s?"


def _pct_label(text: Column, span: Column) -> Column:
    changed = in_clause(text, span, rf"(?i)\b(?:{_CHANGE}|{any_of(v.CHANGES_AFTER)})\b")
    rated = in_clause(text, span, rf"(?i)\b{any_of(v.RATE_HEADS)}s?\b")
    return F.when(changed, "PCT_CHANGE").when(rated, "PCT_RATE").otherwise("PCT_OTHER")


_SPACED_UNITS = [u[0] for u in v.UNITS if len(u[0]) > 3 or u[3]]
_TOUCHING_UNITS = [u[0] for u in v.UNITS if u[3]]
_UNIT = any_of(_SPACED_UNITS, plural=True)
_TOUCHING = any_of(_TOUCHING_UNITS)
QUANTITY = rf"{_AT}(?<![{_W}.,$€£]){NUMBER}{RANGE}(?:\s+|-)(?i:{_UNIT})\b"
QUANTITY_TOUCHING = rf"{_AT}(?<![{_W}.,$€£]){NUMBER}{_TOUCHING}\b"

_MONTH = rf"(?i:{any_of([*v.MONTHS, *v.MONTHS_SHORT])})\.?"
_DAY = r"\d{1,2}(?:st|nd|rd|th)?"
_YEAR = r"(?:19|20)\d{2}"
_AT_MONTH = "(?=[" + "".join(sorted({x for m in v.MONTHS for x in m[0] + m[0].lower()})) + "])"
DATE = rf"{_AT_MONTH}\b{_MONTH}\s+{_DAY},?\s+{_YEAR}\b|(?=\d)(?:\b{_DAY}\s+(?:of\s+)?{_MONTH},?\s+{_YEAR}\b|\b\d{{1,2}}/\d{{1,2}}/(?:\d{{4}}|\d{{2}})\b|\b\d{{1,2}}/\d{{4}}\b)"
CLOCK = rf"(?=\d)(?:\b(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d)?\s*(?i:[AP]\.?M\b\.?(?:\s+{any_of(v.ZONES)}\b)?|{any_of(v.ZONES)}\b)|\b\d{{1,2}}\s+(?i:o'?clock)\b)"
PERIOD = rf"(?=\d)\b{_YEAR}-(?:{_YEAR}|\d{{2}})\b|(?i)\bQ[1-4]\s*(?:FY\s*)?(?:{_YEAR}|\d{{2}})\b|\b(?:fiscal|fy)\s*(?:year\s*)?(?:{_YEAR}|\d{{2}})\b"
MONTH_DAY = rf"{_AT_MONTH}\b{_MONTH}\s+{_DAY}(?!\d)|(?=\d)(?<!\d){_DAY}\s+(?:of\s+)?{_MONTH}\b"
DURATION = rf"(?i){_AT}(?<![{_W}.,$]){NUMBER}{RANGE}\s*(?:-|\s)\s*{any_of(v.TIME_UNITS)}s?\b"

_ID = r"(?:[A-Z]-)?\d+(?:[.-]\d+)*[A-Z]?(?:\s*\([A-Za-z0-9]{1,4}\))*"
_STANDARD = rf"(?:{any_of(v.STANDARDS)}|{any_of(v.GUIDANCE)})"
REFERENCE = (
    rf"(?i)(?<![{_W}])\b(?:(?:refer\s+to|see)\s+(?:[a-z][\w-]*\s+){{1,2}}{_ID}"
    rf"|{_STANDARD}(?:\s+{_STANDARD})*(?:\s+Issue)?(?:\s+No\.?)?\s+{_ID}"
    rf"|{any_of(v.EXHIBITS)}(?:\s*No\.?)?\s+{_ID}(?:\s*(?:,?\s*(?:and|or|&)|,|to|through)\s*{_ID})*"
    r"|EX-\d+(?:\.(?:\d+|[a-z]{1,5}))?|\d+[a-z]?\([a-z0-9]{1,4}\)(?:\([a-z0-9]{1,4}\))*)"
)
PROPER = rf"(?i)\b(?:(?:{any_of(v.INDEXES)})[-\s]\d+(?:\s+(?:Composite|Value|Growth|Total\s+Return))?(?:\s+index)?\b|COVID[-\s]?\d+\b|40[13]\([kb]\)|(?:10|8|6)-?[KQ](?:SB|405)?\b|[24]0-F\b)"
TITLED = rf"\b(?:Locals?|Propositions?|Branch(?:es)?|Chapters?)\s+{NUMBER}{RANGE}"

_FEW = r"(?:[A-Za-z][\w'-]*+\s+){0,3}"
_WORKER = rf"{any_of(v.WORKERS)}s?"
LABOR = rf"(?i){_AT}(?<![{_W}.,$]){NUMBER}\s+{_FEW}{_WORKER}\b|\b{_WORKER}\s+(?:of|total(?:ed|ing)?|number(?:ed|ing)?)\s+{NUMBER}"
LABOR_EVENT = rf"(?i)\b{any_of(v.WORK_EVENTS)}\s+(?:approximately\s+|about\s+|over\s+)?{NUMBER}(?![\w%])"
_ABOUT = r"(?:approximately\s+|about\s+|over\s+|nearly\s+|roughly\s+)?"
#: Counts of people without a noun behind them: after a form of to be, of whom, in a department, in a place.
LABOR_IS = rf"(?i)\b(?:{_WORKER}|head\s?count|workforce)\s+(?:is|are|was|were|stood\s+at|reached|totals?|totall?ed)\s+{_ABOUT}{NUMBER}(?![\w%])"
LABOR_OF_WHOM = rf"(?i)\bof\s+(?:whom|these|those)\s*,?\s+{_ABOUT}{NUMBER}(?![\w%])"
LABOR_IN_DEPARTMENT = rf"(?i){_AT}(?<![{_W}.,$]){NUMBER}\s+(?:are\s+|were\s+|work\s+)?in\s+(?:our\s+|the\s+)?{any_of(v.DEPARTMENTS)}\b"
LABOR_IN_PLACE = rf"{_AT}(?<![{_W}.,$]){NUMBER}\s+(?:are\s+|were\s+|work\s+)?(?:located\s+)?in\s+(?:the\s+)?{any_of([n[0] for n in v.NATIONS])}\b"
#: The same where the sentence says what is counted: places of every kind, sites or workers.
IN_PLACE = rf"{_AT}(?<![{_W}.,$]){NUMBER}\s+(?:(?:are|were|is|was|located|based)\s+)*in\s+(?:the\s+)?{any_of(place_names())}\b"
#: Units that bargain count as entities, though workers are named.
BARGAINING = rf"(?i){_AT}(?<![{_W}.,$]){NUMBER}\s+(?:{_FEW}{_WORKER}\s+)?(?:collective\s+)?bargaining\s+units?\b"
#: Large numbers by themselves, in sentences about workers and unions.
ALONE = rf"{_AT}(?<![\w.,$€£¥-]){NUMBER}(?![\w%.,-]|\s*(?:%|per\s?cent))"
HEADS = 1000
_LABOR_SENTENCE = rf"(?i)\b(?:{any_of(v.UNIONS)}|{_WORKER})\b"
SITE = rf"(?i){_AT}(?<![{_W}.,$]){NUMBER}\s+{_FEW}{any_of(v.SITES)}s?\b"
ENTITY = rf"(?i){_AT}(?<![{_W}.,$]){NUMBER}\s+{_FEW}{any_of(v.ENTITIES)}s?\b"
SHARE = rf"(?i){_AT}(?<![{_W}.,$]){NUMBER}\s+{_FEW}{any_of(v.SHARES)}s?\b(?:\s+of\s+(?:common|preferred|ordinary|class\s+\w)\s+(?:stock|shares?))?"
_PHONE = r"(?=[\d+(])(?<![\w+])(?:\+\d{1,3}[\s.-]?)?(?:\(\d{3}\)\s?|\d{3}[\s.-])\d{3}[\s.-]\d{4}(?!\w)"
STREET = rf"(?=\d)\b\d{{1,5}}\s+(?:[A-Z][\w.'-]*\s+){{1,4}}(?:(?:{'|'.join(v.STREETS_SHORT)})\b\.?|(?:{'|'.join(v.STREETS)})\b)(?:,?\s+(?i:Suite|Unit|Floor|Apt|Room)\.?\s+[\w-]+)?"


def _is_state(text: Column, span: Column) -> Column:
    return ahead(text, span, 60).rlike(rf"\b(?:{'|'.join(v.STATES)})\s*$|\b(?:{'|'.join(v.STREETS)})\b")


_EQUITY = rf"(?i)\b{any_of(v.EQUITY)}s?\b"


def _paragraph(text: Column, span: Column) -> Column:
    """The paragraph (between blank lines) around a span."""
    blank = r"\n\s*\n"
    head = F.element_at(F.split(F.substring(text, F.lit(1), span["start"]), blank), -1)
    tail = F.get(F.split(F.substring(text, span["start"] + 1, F.length(text)), blank), F.lit(0))
    return F.concat(head, tail)


def _equity(text: Column, span: Column) -> Column:
    """The paragraph speaks of equity; what may be a unit or an option of another kind also needs it in its clause."""
    plain = span["text"].rlike(rf"(?i)\b{any_of(v.SURE_SHARES)}s?\b")
    around_it = F.when(text.rlike(r"\n\s*\n"), _paragraph(text, span).rlike(_EQUITY)).otherwise(text.rlike(_EQUITY))
    return around_it & (plain | in_clause(text, span, _EQUITY))


#: Words right before a number that make it a count, verbs that do within the five words before, and words that do in the match.
_COUNTED = r"(?i)\b(?:have|has|had|having|is|are|was|were|of|approximately|about)\s+$"
_COUNTING = rf"(?i)\b{any_of(v.COUNT_VERBS)}\s+(?:\S+\s+){{0,5}}$"
_COUNTS = rf"(?i)\b{any_of(v.COUNT_ADJECTIVES)}\b"


def _no_bare_year(text: Column, span: Column) -> Column:
    """A number that looks like a year counts only after have, is, was and the like, after a verb such as issued, or as shares outstanding and the like."""
    before = ahead(text, span, 90)
    return ~year_like(span) | before.rlike(_COUNTED) | before.rlike(_COUNTING) | span["text"].rlike(_COUNTS)


def _of_workers(text: Column, span: Column) -> Column:
    """What is around a number speaks of people at work; in the text as it came, as what is claimed already is hidden by now."""
    return around(F.col("_plain"), span, 200, 60).rlike(rf"(?i)\b(?:{_WORKER}|head\s?count|workforce)s?\b")


def _not_before_workers(text: Column, span: Column) -> Column:
    return ~after(text, span, 32).rlike(rf"(?i)^\s+{_WORKER}\b")


def labor_label(limit: int | None) -> Callable[[Column, Column], Column] | str:
    """LABOR, or ENTITY_COUNT where a number is far above the most employees there can be."""
    return "LABOR" if limit is None else lambda text, span: F.when(value(span) > (limit + 1) * 1.1, "ENTITY_COUNT").otherwise("LABOR")


_PERCENT = "%|(?i)cent"
_WORKER_WORDS = words(v.WORKERS, ["head count", "workforce"])
_MONTH_WORDS = words(v.MONTHS, v.MONTHS_SHORT)
_MONEY_WORDS = words([s for s in _SIGNS if re.search("[A-Za-z]", s)], [s for s in _SIGNS_AFTER if re.search("[A-Za-z]", s)], *[(c[0], c[2], c[3]) for c in v.CURRENCIES])
_MONEY_SIGNS = r"[$\x{80}-\x{10FFFF}]"
_REFERENCE_WORDS = words(("refer", "see", "EX"), v.STANDARDS, v.GUIDANCE, v.EXHIBITS, (re.sub(r"\W", "", e) + "no" for e in v.EXHIBITS))
_PROPER_WORDS = words(v.INDEXES, ("COVID", "k", "b", "q", "KSB", "QSB", "f"))
_PERIOD_WORDS = words(("q", "fiscal", "fy", "fiscalyear", "fyyear"))


def extractors(most_employees: int | None = None, firms: list[str] | None = None) -> list[Extractor]:
    """The extractors in order of precedence. ``firms``: names that hold numbers, which are no numbers then."""
    labor = labor_label(most_employees)
    named = [Rule("PROPER_NUM", rf"(?<!\w)(?i:{any_of(firms)})(?!\w)", words=words(firms))] if firms else []
    return [
        Extractor("proper", [*named, Rule("PROPER_NUM", PROPER, words=_PROPER_WORDS), Rule("PROPER_NUM", TITLED, words=words(("Local", "Proposition", "Branch", "Chapter")))]),
        Extractor("reference", [Rule("REFERENCE", REFERENCE, words=_REFERENCE_WORDS, signs=r"\(")]),
        Extractor("money", [Rule("MONEY", MONEY, _both(_no_rate_year, _no_instrument), words=_MONEY_WORDS, signs=_MONEY_SIGNS)]),
        Extractor(
            "percent",
            [
                Rule("PCT_RATE", rf"(?i){_AT_FIGURE}(?<![{_W}.]){_PCT_ANY}\s+{_LINK}{_RATE}\b", needs=_PERCENT, words=words(v.RATE_HEADS)),
                Rule("PCT_RATE", rf"(?i)\b{_RATE}\s+{_LINK}{_PCT_ANY}(?!\w)", needs=_PERCENT, words=words(v.RATE_HEADS)),
                Rule("PCT_CHANGE", rf"(?i){_AT_FIGURE}(?<![{_W}.]){_PCT_ANY}\s+{_LINK}{_CHANGE}\b", needs=_PERCENT, words=words(v.CHANGES)),
                Rule("PCT_CHANGE", rf"(?i)\b{_CHANGE}\s+{_LINK}{_PCT_ANY}(?!\w)", needs=_PERCENT, words=words(v.CHANGES)),
                Rule("PCT_CHANGE", rf"(?i){_AT_FIGURE}(?<![{_W}.]){_PCT_ANY}\s+{any_of(v.CHANGES_AFTER)}(?!\w)", needs=_PERCENT, words=words(v.CHANGES_AFTER)),
                Rule(_pct_label, rf"(?i){_AT_FIGURE}(?<![{_W}.]){_PCT_RANGE}(?!\w)", needs=_PERCENT, words=words(("to",)), signs="[-–—]"),
                Rule(_pct_label, rf"(?i){_AT_FIGURE}(?<![{_W}.]){_PCT}\s+(?:of\s+)?(?:(?:{'|'.join(_DETERMINERS)})\s+){{1,4}}(?:[a-z][\w-]*\s+){{0,3}}?[a-z][\w-]+(?!\w)", needs=_PERCENT, words=words(_DETERMINERS)),
                Rule(_pct_label, rf"(?i){_AT_FIGURE}(?<![{_W}.]){_PCT}(?!\w)", needs=_PERCENT),
            ],
        ),
        Extractor("quantity", [Rule("QUANTITY", QUANTITY, words=words(_SPACED_UNITS)), Rule("QUANTITY", QUANTITY_TOUCHING, words=words(_TOUCHING_UNITS))]),
        Extractor(
            "location",
            [
                Rule(_worker_or("LOCATION_COUNT"), SITE, _both(_no_bare_year, lambda t, s: ~s["text"].rlike(rf"(?i)\b{_WORKER}\b")), words=words(v.SITES)),
                Rule(_workers_there, IN_PLACE, _both(_no_bare_year, lambda t, s: in_sentence(t, s, rf"(?i)\b{any_of(v.SITES)}s?\b")), words=words(v.SITES)),
            ],
        ),
        Extractor(
            "entity",
            [
                Rule("ENTITY_COUNT", BARGAINING, _no_bare_year, words=words(("bargaining",))),
                Rule("ENTITY_COUNT", ENTITY, _both(_no_bare_year, _not_before_workers, lambda t, s: ~s["text"].rlike(rf"(?i)\b(?:{_WORKER}|{any_of(v.SHARES)}s?)\b")), words=words(v.ENTITIES)),
            ],
        ),
        Extractor("shares", [Rule(_contract_or_share, SHARE, _both(_equity, _no_bare_year), words=words(v.SHARES))]),
        Extractor("labor", [Rule(labor, LABOR, _no_bare_year, words=words(v.WORKERS))]),
        Extractor("dates", [Rule("TIME", DATE, words=_MONTH_WORDS, signs="/"), Rule("TIME", CLOCK, words=words(("clock", "oclock")), signs=":")]),
        Extractor("address", [Rule("ADDRESS", STREET, words=words(v.STREETS)), Rule("ADDRESS", r"\d{5}(?:-\d{4})?", _is_state, bracketed=True), Rule("ADDRESS", _PHONE)]),
        Extractor(
            "time",
            [Rule("TIME", PERIOD, words=_PERIOD_WORDS, signs="-"), Rule("TIME", MONTH_DAY, words=_MONTH_WORDS), Rule("TIME", DURATION, words=words(v.TIME_UNITS)), Rule("TIME", _YEAR, bracketed=True)],
        ),
        Extractor(
            "labor_event",
            [
                Rule(labor, LABOR_EVENT, lambda t, s: in_clause(t, s, rf"(?i)\b(?:{_WORKER}|workforce|job|position)s?\b") | (value(s) >= 1000), words=words(v.WORK_EVENTS)),
                Rule(labor, LABOR_IS, _no_bare_year, words=_WORKER_WORDS | words(("head", "headcount"))),
                *[
                    Rule(labor, p, _both(_no_bare_year, _of_workers), words=w)
                    for p, w in ((LABOR_OF_WHOM, words(("whom", "these", "those"))), (LABOR_IN_DEPARTMENT, words(v.DEPARTMENTS)), (LABOR_IN_PLACE, words(n[0] for n in v.NATIONS)))
                ],
                Rule(labor, ALONE, _both(_no_bare_year, lambda t, s: value(s) >= HEADS, lambda t, s: in_sentence(t, s, _LABOR_SENTENCE)), words=words(v.UNIONS, v.WORKERS)),
            ],
        ),
    ]


def _workers_there(text: Column, span: Column) -> Column:
    return F.when(in_sentence(text, span, rf"(?i)\b{_WORKER}\b"), "LABOR").otherwise("LOCATION_COUNT")


def _worker_or(label: str):
    return lambda text, span: F.when(after(text, span, 24).rlike(rf"(?i)^\s+{_WORKER}\b"), "LABOR").otherwise(label)


def _contract_or_share(text: Column, span: Column) -> Column:
    return F.when(after(text, span, 24).rlike(r"(?i)^\s+(?:contract|agreement|plan)s?\b"), "ENTITY_COUNT").otherwise("SHARE")


# ---------------------------------------------------------------- application


def tried(text: Column, rule: Rule, held: Column) -> Column:
    """Whether a text can hold a match of a rule; ``held``: the words of it that rules ask for."""
    hints = [F.exists(held, lambda w: w.isin(sorted(rule.words)))] if rule.words else []
    hints += [text.rlike(rule.signs)] if rule.signs else []
    return reduce(lambda a, b: a | b, hints) & text.rlike(rule.needs) if hints else text.rlike(rule.needs)


def words_held(text: Column, chain: list[Extractor]) -> Column:
    """The words of a text that rules of a chain ask for, in lower case."""
    asked = sorted(frozenset().union(*[r.words for e in chain for r in e.rules]))
    found = F.split(F.lower(F.regexp_replace(text, "[^A-Za-z]+", " ")), " ")
    return F.array_distinct(F.filter(found, lambda w: w.isin(asked)))


def claims(seen: Column, claimed: Column, extractor: Extractor, cuts: list[Column], marks: Column) -> Column:
    """array<struct<start, end, label>>: what an extractor claims of a text, of which ``cuts`` are the pieces by each rule.

    A rule's condition and label are worked out for those matches only that overlap nothing claimed.
    """

    def found(rule: Rule, n: int) -> Column:
        if not rule.bracketed:
            return pieces(cuts[n], n)
        clear = F.filter(marks, lambda m: m["text"].rlike(f"^(?:{rule.pattern})$") & ~F.contains(F.substring(seen, m["start"] + 1, m["end"] - m["start"]), F.lit("~")))
        return F.transform(clear, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["text"].alias("text"), F.lit(n).alias("rule")))

    def gated(m: Column) -> Column:
        held = F.lit(True)
        for n, rule in enumerate(extractor.rules):
            held = held if rule.gate is None else F.when(m["rule"] == n, F.coalesce(rule.gate(seen, m), F.lit(False))).otherwise(held)
        return held

    def label(m: Column) -> Column:
        of: dict = {}
        for n, rule in enumerate(extractor.rules):
            of.setdefault(rule.label, []).append(n)
        made = [(F.lit(made) if isinstance(made, str) else made(seen, m), own) for made, own in of.items()]
        return reduce(lambda rest, x: F.when(m["rule"].isin(x[1]), x[0]).otherwise(rest), made[1:], made[0][0])

    def step(kept: Column, m: Column) -> Column:
        taken = F.exists(claimed, lambda k: overlap(k, m)) | F.exists(kept, lambda k: overlap(k, m))
        own = F.array(F.struct(m["start"].alias("start"), m["end"].alias("end"), label(m).alias("label")))
        return F.when(taken, kept).when(gated(m), F.concat(kept, own)).otherwise(kept)

    every = F.concat(*[found(rule, n) for n, rule in enumerate(extractor.rules)])
    return F.when(reduce(lambda a, b: a | b, [F.size(c) > (0 if r.bracketed else 1) for c, r in zip(cuts, extractor.rules)]), F.aggregate(every, F.array().cast(_NONE), step))


def hidden(text: Column, spans: Column) -> Column:
    """The text with every span's characters as ``~``."""
    return F.aggregate(spans, text, lambda t, s: F.overlay(t, F.repeat(F.lit("~"), s["end"] - s["start"]), s["start"] + 1, s["end"] - s["start"]))


def extract(df: DataFrame, text: str, to: str = "spans", chain: list[Extractor] | None = None) -> DataFrame:
    """Adds ``to``: array<struct<start, end, label, text>> over the bracket-free text, sorted and disjoint. Null texts have none."""
    source = F.coalesce(F.col(text), F.lit(""))
    marks = F.transform(find_all(source, r"<\d[\d.-]*>"), lambda m: _unbracketed(source, m))
    own, steps = _steps(chain)
    out = df.withColumns({"_plain": tx.unbracketed(source), "_marks": marks})
    # what stands for cuts must not be in a text that is cut: patterns tell it from no other character of its kind
    out = out.withColumns({"_claimed": F.array().cast(_NONE), "_seen": F.when(F.contains(F.col("_plain"), F.lit(EDGE)), F.translate("_plain", EDGE, _OTHER)).otherwise(F.col("_plain")), "_held": words_held(F.col("_plain"), own)})
    for cuts, new, after in steps:
        out = out.withColumns(cuts).withColumn("_new", new).withColumns(after).drop(*cuts, "_new")
    spans = F.transform(F.array_sort("_claimed"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["label"].alias("label"), F.substring(F.col("_plain"), s["start"] + 1, s["end"] - s["start"]).alias("text")))
    return out.withColumn(to, _merged(F.col("_plain"), spans)).drop("_plain", "_marks", "_claimed", "_seen", "_held")


#: A character of the kind of ``EDGE``, which no pattern names either.
_OTHER = "\u0002"
#: Expressions of chains, by the session's context and the chain: thirteen extractors are thousands of calls to the JVM.
_MADE: dict[tuple, tuple[list[Extractor], list[tuple]]] = {}


def _steps(chain: list[Extractor] | None) -> tuple[list[Extractor], list[tuple]]:
    """For each extractor a text's pieces by each rule, what it claims of them, and what is seen and claimed after it; made
    once per session and chain. Pieces are columns of their own, so that patterns run in compiled code, once a text."""
    key = (SparkContext._active_spark_context.applicationId, None if chain is None else id(chain))
    if key not in _MADE:
        own, seen, claimed, new = chain or extractors(), F.col("_seen"), F.col("_claimed"), F.col("_new")
        steps = []
        for e in own:
            cuts = {f"_cut{n}": F.when(tried(seen, r, F.col("_held")), marked(seen, r.pattern)) for n, r in enumerate(e.rules) if not r.bracketed}
            of = [F.col("_marks" if r.bracketed else f"_cut{n}") for n, r in enumerate(e.rules)]
            some = F.size(new) > 0
            after = {"_claimed": F.when(some, F.concat(claimed, new)).otherwise(claimed), "_seen": F.when(some, hidden(seen, new)).otherwise(seen)}
            steps.append((cuts, claims(seen, claimed, e, of, F.col("_marks")), after))
        _MADE[key] = own, steps
    return _MADE[key]


def _unbracketed(source: Column, m: Column) -> Column:
    start = tx.unbracketed_at(source, m["start"])
    inner = F.translate(m["text"], "<>", "")
    return F.struct(start.alias("start"), (start + F.length(inner)).alias("end"), inner.alias("text"))


def _merged(plain: Column, spans: Column) -> Column:
    """Neighbours of one kind joined: times up to ten characters of connectors apart, addresses up to fifteen."""

    def step(kept: Column, s: Column) -> Column:
        last = F.element_at(kept, -1)
        between = F.substring(plain, last["end"] + 1, s["start"] - last["end"])
        size = s["start"] - last["end"]
        time = (s["label"] == "TIME") & (size <= 10) & between.rlike(r"^(?:[\s,.;()-]|\bat\b)*$")
        place = (s["label"] == "ADDRESS") & ((size <= 15) | ((size <= 40) & between.rlike(r"^[\s,]*(?:[A-Z][a-z]+[\s,]+)*(?:[A-Z]{2}\s*)?$"))) & ~last["text"].rlike(_PHONE) & ~s["text"].rlike(_PHONE)
        near = (F.size(kept) > 0) & (last["label"] == s["label"]) & (time | place)
        joined = F.struct(last["start"].alias("start"), s["end"].alias("end"), last["label"].alias("label"), F.substring(plain, last["start"] + 1, s["end"] - last["start"]).alias("text"))
        return F.when(near, F.concat(F.slice(kept, F.lit(1), F.size(kept) - 1), F.array(joined))).otherwise(F.concat(kept, F.array(s)))

    return F.aggregate(spans, F.array().cast("array<struct<start:int,end:int,label:string,text:string>>"), step)


def exploded(df: DataFrame, keys: list[str], spans: str = "spans") -> DataFrame:
    """A row per span: the keys, start, end, label, text.

    An inner ``explode`` would make the optimizer derive a filter on the array and push it, with the whole grammar
    written out anew at each reference, below the columns that build it; the outer one with a filter on its rows doesn't.
    """
    return df.select(*keys, F.explode_outer(spans).alias("_s")).where("_s is not null").select(*keys, "_s.*")
