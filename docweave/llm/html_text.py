"""Main-text extraction from HTML by the maximum-scoring subsequence.

A page is read as a sequence of words and tags. Every word scores by its context, every tag by its name, and one linear
scan finds the contiguous stretch of the largest sum: the content region. Where an ``article`` or ``main`` element and the
stretch hold most of each other's words, the region is that whole element too, so that a list at its end is not cut off. The
text is that of the region: the blocks it touches, whole, where a block's own words sum to more than zero. Words in an
element that is no content by its nature (nav, form, what is not shown, ...) go by themselves, if they score below zero.

Contexts. A word's context is the innermost of: an element that is no content by its nature (nav, footer, form, ...; a
header outside article, main and section), by its name; a container whose class, id or role is a name of ``NAMES``, by that
name; else the block it stands in (p, li, div, ...), whether in a link, and whether that block itself has such a name. All
parts of a name must be in the list or say nothing by themselves (box, bar, links, ...), so ``sharing-economy`` is none. The list
says no more than how likely such a context's words are content before any page is seen (``prior``); labelled pages decide. A
name is no context of its own where it names a part that the element has or lacks (has-sidebar, no-comments) or a text's
heading (post-header), nor for a container that holds the page's body: a ``main``, the ``article`` of the most words, or over
half of the words of that, or of a page without either.

Weights come from labelled pages: pages whose author marked the content with one ``article`` or ``main`` element. On a
bounded sample of them (``fit_pages``, by a hash of the key) Spark counts how many words of each context, and how many
tags of each name, stand inside and outside the marked element, whatever the context. A word's weight is 2 P - 1, with P the
share inside, and a tag's is minus ``TAG_LOW`` to minus ``TAG_HIGH`` by its share outside; both start from a prior worth
``PRIOR`` words. ``article`` and ``main`` themselves are tags without a weight of their own. Without labelled pages the
priors hold.

Character references are decoded, white space inside a block becomes one space, blocks are joined by two newlines. Null,
empty and text-less pages give ''. Pages are read whole in linear time: every element is opened and closed once, and
what is open is counted by name, never searched. Broken markup is read as far as it goes: what is never closed ends with
the page. Equal rows get equal texts.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import text_of

FIT_PAGES = 2000
PRIOR = 30.0
TAG_LOW, TAG_HIGH = 0.01, 0.3

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)|([^<]++|<)""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*+(?:=\s*+("[^"]*+"?|'[^']*+'?|[^\s"'>]++))?""")
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_INLINE = {"a", "button", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "ruby", "rt", "rp"}
#: Elements that are no content by their nature.
_ASIDE = {"nav", "footer", "aside", "form", "select", "option", "dialog", "menu", "svg", "canvas", "object", "audio", "video", "head", "fieldset"}
_SCOPES = ("article", "main", "section")
#: Blocks that hold sentences, other blocks that words may stand in, and blocks that leave their words to the block around them.
_SENTENCES = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figcaption", "dd"}
_BLOCKS = _SENTENCES | {"li", "dt", "td", "th", "div", "section", "caption", "address", "details", "summary", "center"}
_CLEAR = {"html", "body", "article", "main", "ul", "ol", "dl", "table", "thead", "tbody", "tfoot", "tr", "header", "hgroup", "figure"}
# Names that adverts, notices, comments and the like go by, and parts of names that say nothing by themselves.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "menu nav navbar navigation breadcrumb breadcrumbs sidebar aside widget widgets footer header masthead comment comments disqus reply replies respond "
    "share sharing social related recommended recommendations newsletter subscribe subscription signup login search pagination pager skip copyright legal toolbar "
    "complementary contentinfo hidden".split()
)
_PLAIN = frozenset("area bar bottom box block body button buttons col column container content group inner item items left link links list main middle outer pane panel post posts right row section site tools top wrap wrapper".split())
_BLOCK_ENDS_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
#: Elements that a paragraph around them stays open behind.
_P_SCOPES = {"table", "td", "th", "caption", "button", "object", "template"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Parts of a name that say that an element has or lacks what the name's hint says, and parts that say that a heading is a text's.
_FEATURES = frozenset("has have with without no not enabled disabled open closed".split())
_TEXTS = frozenset("post entry article story content title headline".split())
#: Names that mean no more than a heading where they stand inside the article.
_HEADINGS = frozenset(("header", "masthead", "banner"))

HINT = "hint"
Steps = list[tuple[str, int]]


def _named(value: str, inner: bool) -> str | None:
    """Of a class, id or role the first part that is a name of what is no content; none where the rest says something else."""
    for name in value.lower().strip("\"'").split():
        parts = [p for p in re.split(r"[^a-z]+", name) if p]
        known = [p for p in parts if p in NAMES and not (p in _HEADINGS and (inner or _TEXTS.intersection(parts)))]
        if known and all(p in NAMES or p in _PLAIN for p in parts):
            return known[0]
    return None


def _nature(tag: str, attributes: str, inner: bool) -> tuple[bool, str | None]:
    """Whether an element is no content by its nature (or not shown), and the name that hints so."""
    if tag in _ASIDE or (tag == "header" and not inner):
        return True, None
    named = None
    if attributes and tag not in ("html", "body", "article", "main"):
        for name, value in _ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name == "hidden" or (name == "aria-hidden" and "true" in value) or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
                return True, None
            if name in ("class", "id", "role"):
                named = named or _named(value, inner)
    return False, named


def is_tag(kind: str) -> bool:
    return kind[0] == "<"


def is_beside(kind: str) -> bool:
    """Whether a context is that of an element which is no content by nature or name."""
    return kind.startswith((HINT, "aside"))


def _held(steps: Steps, hints: list[tuple[int, int, str]], regions: dict[str, list[list[int]]]) -> list[tuple[int, int, str]]:
    """Of the containers with a hint, as (first step, last step + 1, name): those for which it holds, as the page's body isn't in them."""
    if not hints:
        return []
    words = [0]
    for kind, n in steps:
        words.append(words[-1] + (0 if is_tag(kind) or is_beside(kind) or " link" in kind else n))
    count = lambda r: words[r[1]] - words[r[0]]
    body = max(regions["main"] or regions["article"], key=count, default=[0, len(steps)])
    story = max(regions["article"], key=count, default=body)
    story = story if 2 * count(story) > count(body) else body

    def holds(h: tuple[int, int, str]) -> bool:
        around = any(h[0] <= r[0] and r[1] <= h[1] for r in (body, story))
        within = any(r[0] <= h[0] and h[1] <= r[1] and 2 * count(h) > count(r) for r in (body, story))
        return not (around or within)

    return [h for h in hints if holds(h)]


class _Reader:
    """The open elements of a page, each counted where it matters, and what was read so far."""

    def __init__(self) -> None:
        self.steps: Steps = []
        #: (step of a run of words, or -1 for white space; text); '' parts blocks.
        self.pieces: list[tuple[int, str]] = []
        self.stack: list[tuple[str, bool, tuple[int, str] | None, bool]] = []  # name, no content by nature, step and name of its hint, a block of its own
        self.open: Counter[str] = Counter()
        self.asides: list[str] = []
        self.blocks: list[str] = []
        self.paragraphs = [0]  # open in each scope
        self.hints: list[tuple[int, int, str]] = []
        self.regions: dict[str, list[list[int]]] = {"article": [], "main": []}
        self.unclosed: dict[str, list[int]] = {"article": [], "main": []}

    def close(self) -> None:
        """The innermost element ends."""
        tag, hidden, hint, block = self.stack.pop()
        self.open[tag] -= 1
        if hidden:
            self.asides.pop()
        if hint:
            self.hints.append((hint[0], len(self.steps), hint[1]))
        if block:
            self.blocks.pop()
        if tag == "p":
            self.paragraphs[-1] -= 1
        elif tag in _P_SCOPES:
            self.paragraphs.pop()
        if tag in self.regions:
            self.regions[tag][self.unclosed[tag].pop()].append(len(self.steps))

    def close_to(self, tag: str) -> None:
        while self.stack[-1][0] != tag:
            self.close()
        self.close()

    def words(self, value: str) -> None:
        n = len(value.split())
        if not n:
            if value and self.pieces:
                self.pieces.append((-1, value))
            return
        if self.asides:
            kind = f"aside {self.asides[-1]}"
        else:
            name, _, named = (self.blocks[-1] if self.blocks else "page").partition(" ")
            kind = name + (" link" if self.open["a"] else "") + (" named" if named else "")
        self.steps.append((kind, n))
        self.pieces.append((len(self.steps) - 1, value))

    def begin(self, tag: str, attributes: str) -> None:
        """An element that isn't empty begins; it may end others first."""
        if tag in _BLOCK_ENDS_P:
            while self.paragraphs[-1]:
                self.close_to("p")
        while self.stack and self.stack[-1][0] in _CLOSES.get(tag, ()):
            self.close()
        hidden, named = _nature(tag, attributes, any(self.open[s] for s in _SCOPES))
        block = tag not in _INLINE and tag not in _CLEAR
        if block:
            self.blocks.append((tag if tag in _BLOCKS else "other") + (" named" if named and tag in _SENTENCES else ""))
        if hidden:
            self.asides.append(tag if tag in _ASIDE or tag == "header" else "hidden")
        if tag == "p":
            self.paragraphs[-1] += 1
        elif tag in _P_SCOPES:
            self.paragraphs.append(0)
        if tag in self.regions:
            self.unclosed[tag].append(len(self.regions[tag]))
            self.regions[tag].append([len(self.steps) - 1])
        self.open[tag] += 1
        self.stack.append((tag, hidden, (len(self.steps) - 1, named) if named and tag not in _SENTENCES else None, block))


def read(page: str) -> tuple[Steps, list[tuple[int, str]], dict[str, list[tuple[int, int]]]]:
    """A page as (kind, number) steps, its pieces of text (step, text) with '' between blocks, and its article and main elements.

    A step is a run of words of one context, or one tag. An element is (first step, last step + 1).
    """
    r = _Reader()
    at, skip = 0, None
    while at < len(page):
        if skip:
            end = re.compile(rf"</{skip}[\s/>]", re.I).search(page, at)
            at, skip = (end.start() if end else len(page)), None
            continue
        m = _TOKEN.match(page, at)
        at = m.end()
        close, tag, attributes, text = m[1], m[2], m[3], m[4]
        if text is not None:
            r.words(html.unescape(text))
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in _INLINE:
            r.pieces.append((-1, ""))
        elif tag == "br":
            r.pieces.append((-1, " "))
        known = tag in _BLOCKS or tag in _CLEAR or tag in _INLINE or tag in _ASIDE or tag in _VOID
        r.steps.append((f"<{tag}>" if known else "<other>", 1))
        if close:
            if r.open[tag]:
                r.close_to(tag)
        elif tag in _RAW:
            skip = None if attributes.rstrip().endswith("/") and tag != "script" else tag
        elif tag not in _VOID and not attributes.rstrip().endswith("/"):
            r.begin(tag, attributes)
    while r.stack:
        r.close()
    # the outermost hint names a word's context: inside it nothing is looked at twice
    upto = 0
    for first, last, name in sorted(_held(r.steps, r.hints, r.regions), key=lambda h: (h[0], -h[1])):
        for i in range(max(first, upto), last):
            kind, n = r.steps[i]
            if not is_tag(kind) and not is_beside(kind):
                r.steps[i] = (f"{HINT} {name}", n)
        upto = max(upto, last)
    return r.steps, r.pieces, {t: [(a, b) for a, b in own] for t, own in r.regions.items()}


def marked(regions: dict[str, list[tuple[int, int]]]) -> tuple[int, int] | None:
    """What a page's author marked: the only ``article``, or else the only ``main``."""
    return next((regions[t][0] for t in ("article", "main") if len(regions[t]) == 1), None)


# ---------------------------------------------------------------- weights


def prior(kind: str) -> float:
    """How likely a word of a context is content, or a tag stands in content, before any labelled page is seen."""
    if is_tag(kind):
        return 0.5
    if is_beside(kind):
        return 0.03
    name, *more = kind.split()
    if "named" in more:
        return 0.55
    if "link" in more:
        return 0.8 if name in _SENTENCES else 0.55 if name == "li" else 0.35
    return 0.95 if name in _SENTENCES else 0.8


class Weights(dict):
    """The score of a word of each context and of each tag, from (inside, outside) counts."""

    def __init__(self, counts: dict[str, tuple[int, int]] | None = None):
        super().__init__()
        for kind, (inside, outside) in (counts or {}).items():
            self[kind] = self._score(kind, inside, outside)

    @staticmethod
    def _score(kind: str, inside: int, outside: int) -> float:
        share = (inside + PRIOR * prior(kind)) / (inside + outside + PRIOR)
        if kind in ("<article>", "<main>"):
            return -TAG_LOW
        return -(TAG_LOW + (TAG_HIGH - TAG_LOW) * (1 - share)) if is_tag(kind) else 2 * share - 1

    def __missing__(self, kind: str) -> float:
        own = self[kind] = self._score(kind, 0, 0)
        return own


def counted(page: str) -> dict[str, list[int]]:
    """For each context and tag of a page: how many stand inside and outside what its author marked; empty without a mark."""
    steps, _, regions = read(page)
    found: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    own = marked(regions)
    if own:
        for i, (kind, n) in enumerate(steps):
            found[kind][not own[0] <= i < own[1]] += n
    return found


def fit(pages: DataFrame, key: str = "page_id", page: str = "html", fit_pages: int = FIT_PAGES) -> Weights:
    """The weights that labelled pages give.

    About ``fit_pages`` pages are read, whole; a row per context or tag (the names are a fixed set) comes back summed.
    """
    many = max(1, pages.count())
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(8)), F.lit(1 << 20)) / float(1 << 20)
    sample = pages.where(F.col(page).isNotNull() & (draw < min(1.0, fit_pages / many))).select(F.col(page).alias("_page"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for frame in frames:
            for value in frame["_page"]:
                for kind, (inside, outside) in counted(value).items():
                    sums[kind][0] += inside
                    sums[kind][1] += outside
        yield pd.DataFrame([(k, a, b) for k, (a, b) in sums.items()], columns=["kind", "inside", "outside"])

    summed = sample.mapInPandas(count, "kind string, inside long, outside long").groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    return Weights({r["kind"]: (r["inside"], r["outside"]) for r in summed.collect()})


# ---------------------------------------------------------------- extraction


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """The first place and last place + 1 of the contiguous scores of the largest sum; the first such, (0, 0) if none is positive."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, found = total, (start, i + 1)
    return found


def content_region(steps: Steps, scores: list[float], regions: dict[str, list[tuple[int, int]]]) -> tuple[int, int]:
    """The best stretch, and the whole of an element with which it shares most words of both."""
    first, last = best_stretch(scores)
    words = [0]
    for (kind, n), score in zip(steps, scores, strict=True):
        words.append(words[-1] + (n if score > 0 and not is_tag(kind) else 0))
    count = lambda a, b: words[b] - words[a] if b > a else 0
    for a, b in (r for t in ("article", "main") for r in regions[t]):
        shared = count(max(a, first), min(b, last))
        if 2 * shared > count(first, last) and 2 * shared > count(a, b):
            return min(a, first), max(b, last)
    return first, last


def main_text(page: str | None, weights: Weights | None = None) -> str:
    """The text of a page's content region."""
    if not page:
        return ""
    weights = Weights() if weights is None else weights
    steps, pieces, regions = read(page)
    scores = [weights[kind] * n for kind, n in steps]
    first, last = content_region(steps, scores, regions)
    blocks, block, total, touched = [], [], 0.0, False
    for step, text in [*pieces, (-1, "")]:
        if step < 0 and not text:
            if touched and total > 0:
                blocks.append(" ".join("".join(block).split()))
            block, total, touched = [], 0.0, False
        elif step < 0:
            block.append(text)
        elif scores[step] > 0 or not steps[step][0].startswith("aside"):
            block.append(text)
            total += scores[step]
            touched |= first <= step < last
        else:
            block.append(" ")
    return "\n\n".join(filter(None, blocks))


def extract(pages: DataFrame, weights: Weights, page: str = "html", to: str = "text") -> DataFrame:
    """Adds each page's main text."""
    plain = dict(weights)

    @F.pandas_udf("string")
    def text(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Weights()
        own.update(plain)
        for s in values:
            yield pd.Series([main_text(v, own) for v in s], dtype=object)

    return pages.withColumn(to, text(F.col(page)))


def op8_html(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = extract(pages.select("page_id", "url", "html"), fit(pages))
    return found.select("page_id", "url", "text", F.length(text_of("text")).cast("long").alias("n_chars"))
