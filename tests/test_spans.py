"""Spans: rules are tried where their words are, and what they ask is asked of what nothing has claimed."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from docweave.functions.find import EDGE, find_all, marked, pieces
from docweave.operators import spans

#: A text for each rule that has words or signs, in the order of the extractors.
TEXTS = (
    "The S&P 500 index", "Covid19 and 10KSB and 401(k)", "Locals 12", "see the rules 7", "Note 7", "NotesNo. 7", "rule 10b(5)", "EX-10.1", "-€5", "US$ 5", "5 Kč", "5 zł", "5 lei", "S/ 5", "Rs.5", "KSh 5", "RMB5", "5MXN", "EUR5",
    "(₹ 5 million)", "5 Mexican pesos", "Hong Kong dollars 5", "5 euros", "5% of the tax rate", "interest-rate is 5%", "5% increases", "grew by 5 per cent", "5percent less", "5to6%", "5%–6%", "5% of all goods", "7 %", "5 metric tons", "5-square feet",
    "5kWh", "9 retail stores", "9 in Spain of our 4 branches", "9 collective bargaining units", "9 option contracts", "9 shares of common stock", "9 team members", "Staff of 9", "May 3, 2001", "3/4/2001", "9:30 PM EST", "9 o'clock", "9 oClock",
    "12 Main Street, Suite 4", "2001-2002", "Q3 2001", "FY01", "fiscalyear2001", "3 of sept", "Jan. 3", "5 yrs", "5-6-minutes", "laid off 1,200", "Our headcount stood at 900", "employees, of whom 900", "of these 900 employees", "900 in sales, employees",
    "900 in the United States, employees", "1,900 by the unions",
)


def test_every_match_holds_words_or_signs_of_its_rule(spark):
    """A text in which a rule's pattern matches is one in which the rule is tried, whatever the letters' case."""
    chain = spans.extractors(firms=["3M Company", "Studio 54"])
    texts = [x for t in (*TEXTS, "the 3M Company", "studio 54") for x in (t, t.upper(), t.lower(), f"K {t}K", f"é{t}")]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("held", spans.words_held(F.col("t"), chain)).cache()
    rules = [(f"{e.name}_{n}", r) for e in chain for n, r in enumerate(e.rules) if r.words or r.signs]
    lost = [F.col("t").rlike(r.pattern) & ~F.coalesce(spans.tried(F.col("t"), r, F.col("held")), F.lit(False)) for _, r in rules]
    met = [F.col("t").rlike(r.pattern) for _, r in rules]
    got = rows.agg(*[F.max(F.when(c, F.col("t"))) for c in (*lost, *met)]).first()
    asked = {name for name, _ in rules} - {"location_1", "labor_event_5"}  # their conditions ask for the words
    assert [(n, t) for (n, _), t in zip(rules, got) if t is not None and n in asked] == []
    assert [n for (n, _), t in zip(rules, got[len(rules) :]) if t is None] == []


def test_patterns_run_in_columns_of_their_own(spark):
    """A rule's pattern stands in the plan once, outside the functions that are walked node by node for each text."""
    df = spark.createDataFrame([("It owes 5 yen.",)], "t string")
    plan = spans.extract(df, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"regexp_replace\(_seen#", plan)) == sum(not r.bracketed for e in spans.extractors() for r in e.rules)


def test_texts_with_the_edge_itself(spark):
    t = f"{EDGE}5 yen{EDGE} and 7 kg{EDGE}"
    got = spans.extract(spark.createDataFrame([(t,), (None,), ("",)], "t string"), "t").select("spans").collect()
    assert [[(s["label"], s["text"], s["start"]) for s in r[0]] for r in got] == [[("MONEY", "5 yen", 1), ("QUANTITY", "7 kg", 12)], [], []]


def test_pieces_are_all_matches(spark):
    """Few and many matches, at both ends, and of characters of several bytes."""
    texts = ["", "x", "7", "7 x 88 é 9", "é7", *["".join(f"é{n} " for n in range(m)) for m in (31, 32, 33, 200)]]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", find_all(F.col("t"), r"\d+").alias("a"), marked(F.col("t"), r"\d+").alias("c"))
    for r in rows.select("t", "a", pieces(F.col("c"), 3).alias("b")).collect():
        assert [tuple(x) + (3,) for x in r["a"]] == [tuple(x) for x in r["b"]]
        assert [r["t"][x["start"] : x["end"]] for x in r["b"]] == re.findall(r"\d+", r["t"])
