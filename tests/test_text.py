"""Text expressions on small strings, each against what a reader would write."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.operators import documents, spans


def of(spark, column, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("t"))).collect()]


def test_clean_block(spark):
    assert of(spark, tx.clean_block, "a ---- b", "a--b", "Name _ ___ date", "a - b", "  x\t\ty ", "====", None) == ["a — b", "a — b", "Name — date", "a - b", "x y", "—", None]


def test_tidy(spark):
    given = ["a , b ;c", "wait .. what ! !", "U.S.A. and end.Next", "it 's , they 're", "one: two,three", "", "x - y", None]
    assert of(spark, tx.tidy, *given) == ["a, b; c", "wait. what!", "U.S.A. and end. Next", "it's, they're", "one: two, three", "", "x- y", None]


def test_clean_document_text(spark):
    given = ["12 <PAGE> 13 Sales rose", "- 14 - Sales", "See https://a.example/x?y=1. More", "• | Sales", "Risks . . . . . . 12", "3) Sales rose", "1.2 Sales", "for Us and us in US", "visit acme.com/path now"]
    want = ["Sales rose", "Sales", "See. More", "Sales", "Risks", "Sales rose", "Sales", "for the Company and the Company in US", "visit now"]
    assert of(spark, tx.clean_document_text, *given) == want


def test_sentences(spark):
    text = "Mr. Smith of Acme Inc. Delaware met J. Doe. He said no! Was U.S. Steel there? Yes, e.g. Monday. See No. 5. End"
    got = of(spark, tx.sentences, text)[0]
    assert [r["text"] for r in got] == ["Mr.", "Smith of Acme Inc. Delaware met J. Doe.", "He said no!", "Was U.S. Steel there?", "Yes, e.g. Monday.", "See No. 5.", "End"]
    assert all(text[r["start"] : r["end"]] == r["text"] for r in got)


def test_average_line_of_several_lines(spark):
    assert of(spark, tx.average_line, "abcd\n\nef", "\n \n", "abc") == [3.0, 999.0, 3.0]


def test_forward_boundary_and_figures(spark):
    rows = spark.createDataFrame([(1, 0, "Contents"), (1, 1, "Special note on FORWARD-LOOKING STATEMENTS"), (1, 2, "safe harbor"), (2, 130, "Cautionary statement"), (3, 4, "a cautionary statement")], "k int, pos int, block string")
    assert {r["k"]: r["boundary"] for r in documents.forward_boundary(rows, "k").collect()} == {1: 1, 3: 4}
    table = "Item          2001      2000\n----------------------------\nSales      $ 1,200     (34.5)\nCosts          900        110%"
    prose = "Sales were 1,200 in 2001 and\n900 in 2000, which is less\nthan what we had hoped for"
    assert of(spark, documents.is_table, table, prose, "---- \n  1   2   3", None) == [True, False, False, False]


@pytest.fixture(scope="module")
def found(spark):
    """The spans of one sentence per label and rule."""
    texts = [
        "We issued 1999 shares of common stock.", "In 1999 shares rose.", "There were 2001 shares outstanding in the class of common stock.",
        "We granted our directors a total of 1985 shares in 1990.", "It has 12 stores and 3 restaurants.", "We own 25 subsidiaries and 14 patents.",
        "The dividend was paid.\n\nThe drum has 12 units left.", "Call (212) 555-0199 for details.", "Visit 12 Main Street, Suite 400 today.", "Due on March 3, 2001 at 10:30 AM EST.",
        "We laid off approximately 1,200 workers.", "Under Rule 10b(5) and Note 7.", "COVID-19 and the S&P 500 index.", "The tax rate was 35% in all.", "It was 7% of the total.",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return {r["i"]: [(s["label"], s["text"]) for s in r["spans"]] for r in spans.extract(df, "t").select("i", "spans").collect()}


def test_labels(found):
    assert ("SHARE", "1999 shares of common stock") in found[0]
    assert all(label != "SHARE" for label, _ in found[1])
    assert any(label == "SHARE" and text.startswith("2001 shares") for label, text in found[2])
    assert ("SHARE", "1985 shares") in found[3]
    assert [t for label, t in found[4] if label == "LOCATION_COUNT"] == ["12 stores", "3 restaurants"]
    assert [t for label, t in found[5] if label == "ENTITY_COUNT"] == ["25 subsidiaries", "14 patents"]
    assert all(label != "SHARE" for label, _ in found[6])
    assert ("ADDRESS", "(212) 555-0199") in found[7]
    assert any(label == "ADDRESS" and text.startswith("12 Main Street") for label, text in found[8])
    assert any(label == "TIME" and text.startswith("March 3, 2001") for label, text in found[9])
    assert any(label == "LABOR" for label, _ in found[10])
    assert any(label == "REFERENCE" for label, _ in found[11])
    assert [label for label, _ in found[12]] == ["PROPER_NUM", "PROPER_NUM"]
    assert any(label == "PCT_RATE" for label, _ in found[13]) and any(label == "PCT_OTHER" for label, _ in found[14])


def test_new_database(spark, tmp_path):
    from docweave import schema

    assert sorted(schema.create(spark, str(tmp_path))) == sorted(schema.TABLES)
    spark.createDataFrame([(1, "Acme")], schema.NAMES).write.mode("append").parquet(f"{tmp_path}/names")
    assert schema.create(spark, str(tmp_path)) == []
    assert spark.read.parquet(f"{tmp_path}/names").count() == 1


def test_strata_smaller_than_their_quota(spark):
    from docweave.operators import corpus

    df = spark.range(100).selectExpr("id", "case when id < 3 then null when id < 10 then 'a' else 'b' end as s")
    got = corpus.stratify(df, F.col("s"), 60, 1, "id").groupBy("s").count().collect()
    assert {r["s"]: r["count"] for r in got} == {None: 3, "a": 7, "b": 50}
    assert corpus.stratify(df, F.col("s"), 500, 1, "id").count() == 100 and corpus.stratify(df.limit(0), F.col("s"), 5, 1, "id").count() == 0


def test_alternations_share_beginnings():
    import re

    from docweave.functions import vocabulary as v
    from docweave.functions.patterns import any_of, ordered

    assert any_of(["abd", "abc"]) == "(?:ab(?:d|c))"
    for terms in (["Ab", "a", "Abd", "ab", "A b", "A  b c", "AB"], ["a", "ab", "abc", "abd", "b"], v.STANDARDS, v.WORKERS, [n[0] for n in v.NATIONS]):
        plain = "|".join(re.sub(r"(?:\\?\s)+", r"\\s+", re.escape(t)) for t in ordered(terms))
        text = " ".join(f"{t} {t.lower()}s {t.upper()} {t[:3]} {t}x" for t in terms)
        for flags in ("", "(?i)"):
            assert [m.span() for m in re.finditer(f"{flags}{any_of(terms)}", text)] == [m.span() for m in re.finditer(f"{flags}(?:{plain})", text)]
