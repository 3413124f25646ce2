"""The content region of pages: what the scan decides, what names may do, and a plain version of the text."""

from __future__ import annotations

import random

import pytest

from docweave.llm import html_text
from docweave.llm.html_text import main_text

STORY = [f"Paragraph {i} of the story tells more than a few words to its readers." for i in range(4)]
BODY = "<h1>The story</h1>" + "".join(f"<p>{p}</p>" for p in STORY)


def test_the_scan_decides(monkeypatch):
    """A block that would count by itself lies beyond a menu: the best stretch leaves it out, the whole page doesn't."""
    menu = "<nav>" + "<a href=x>One of many pages</a>" * 30 + "</nav>"
    page = f"<body><div>A teaser of another story.</div>{menu}<div>{BODY}</div>{menu}<div>And one more teaser.</div></body>"
    assert main_text(page).split("\n\n") == ["The story", *STORY]
    monkeypatch.setattr(html_text, "best_stretch", lambda scores: (0, len(scores)))
    assert "A teaser of another story." in main_text(page) and "And one more teaser." in main_text(page)


@pytest.mark.parametrize("part", ["<div class='sharing-economy'><p>{}</p></div>", "<ul><li><a href=x>{}</a></li></ul>", "<section id='comment-on-the-law'>{}</section>", "<p class=notice>{}</p>"])
def test_parts_of_an_article_stay(part):
    own = "The sources of this text, all of them"
    page = f"<body><nav><a href=1>Home</a></nav><article>{BODY}{part.format(own)}</article><footer>All rights</footer></body>"
    assert main_text(page).split("\n\n") == ["The story", *STORY, own]


def test_buttons_inside_sentences_stay():
    page = f"<body><article>{BODY}<p>Press <button>OK</button> now</p><form><button>Send</button> me mail</form></article></body>"
    assert main_text(page).split("\n\n") == ["The story", *STORY, "Press OK now"]


def test_labelled_pages_outvote_names(spark):
    """A name says how likely its words are content until labelled pages say otherwise."""
    inside = f"<body><nav>Some menu words</nav><article>{BODY}<div class=sidebar><p>What stands beside the story belongs to it here.</p></div></article></body>"
    outside = f"<body><article>{BODY}</article><div class=sidebar><p>What stands beside the story is something else.</p></div></body>"
    for page, positive in ((inside, True), (outside, False)):
        weights = html_text.fit(spark.createDataFrame([(i, page) for i in range(40)], "page_id long, html string"))
        assert (weights["hint sidebar"] > 0) is positive and ("beside" in main_text(page, weights)) is positive


def plain_text(page: list[tuple[str, int, str]]) -> str:
    """Blocks as (tag, score per word, text): of all contiguous runs of blocks, whole, the one of the largest sum, without blocks below zero."""
    sums = [w * len(t.split()) - 2 * html_text.TAG_LOW for _, w, t in page]
    best = max(((sum(sums[a:b]), -a, -b) for a in range(len(page)) for b in range(a + 1, len(page) + 1)), default=(0, 0, 0))
    return "\n\n".join(t for _, w, t in page[-best[1] : -best[2]] if w > 0) if best[0] > 0 else ""


def test_text_against_all_runs_of_blocks():
    rng = random.Random(11)
    weights = html_text.Weights()
    weights.update({"<p>": -html_text.TAG_LOW, "<div>": -html_text.TAG_LOW, "p": 0.9, "div": -0.45})
    for _ in range(200):
        page = [(tag, weights[tag], " ".join(rng.choice(["ab", "cde", "f"]) for _ in range(rng.randint(1, 12)))) for tag in (rng.choice(["p", "div"]) for _ in range(rng.randint(1, 9)))]
        assert main_text("".join(f"<{t}>{x}</{t}>" for t, _, x in page), weights) == plain_text(page)
