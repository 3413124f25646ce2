"""Near names against all pairs, progress of streams, HTML details, and the parsing of pages."""

from __future__ import annotations

import difflib
import random
import time

import pytest
from pyspark.sql import functions as F

from docweave.operators import dictionary, html
from docweave.streaming import ingest
from docweave.streaming.progress import ProgressLog


@pytest.mark.parametrize("least", [0.7, 0.85, 0.95])
def test_fuzzy_misses_no_pair(spark, least):
    rng = random.Random(int(100 * least))
    base = ["".join(rng.choice("abcde ") for _ in range(rng.randrange(0, 25))) for _ in range(40)] + ["", "a", "ab", "ba", "abc", "abcd", "Acme Corp", "ACME corp"]
    edited = []
    for b in base * 2:
        own = list(b)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(own) + 1)
            own[at : at + rng.randrange(2)] = rng.choice(["", "x", "a", "e"])
        edited.append("".join(own))
    want = set()
    for a in set(edited):
        for b in set(base):
            ratio = difflib.SequenceMatcher(None, a.lower(), b.lower()).ratio()
            if ratio >= least:
                want.add((a, b, round(ratio, 9)))
    left, right = (spark.createDataFrame([(x,) for x in xs], f"{c} string") for c, xs in (("candidate", [*edited, None]), ("name", [*base, None])))
    got = [(r["candidate"], r["name"], round(r["ratio"], 9)) for r in dictionary.fuzzy(left, right, "candidate", "name", least).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_fuzzy_names_against_all_pairs(spark, small):
    """The registered query, whole: every pair of the small table's names."""
    from docweave.plans import storage

    got = {(r["candidate"], r["name"], round(r["ratio"], 9)) for r in storage.fuzzy_names(spark, small).collect()}
    p = spark.read.parquet(f"{small}/part.parquet").select(F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("name")).distinct()
    typed = p.select(F.regexp_replace(F.regexp_replace("name", "e", ""), "Brand", "brnd").alias("candidate")).where(F.xxhash64("candidate") % 2 == 0)
    want = set()
    for a in {r["candidate"] for r in typed.collect()}:
        for b in {r["name"] for r in p.collect()}:
            ratio = difflib.SequenceMatcher(None, a.lower(), b.lower()).ratio()
            if ratio >= 0.9:
                want.add((a, b, round(ratio, 9)))
    assert got == want and len(want) > 100


def test_progress(spark, tmp_path):
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        spark.range(10).select("id", F.repeat(F.lit("word "), 60).alias("raw")).repartition(4).write.parquet(f"{tmp_path}/in")
        query = ingest.ingest(ingest.pages(spark, f"{tmp_path}/in", "id bigint, raw string", 1), "id", "raw", f"{tmp_path}/out", f"{tmp_path}/at")
        query.awaitTermination()
        until = time.monotonic() + 20
        while not log.ended(query.id) and time.monotonic() < until:
            time.sleep(0.1)
        assert sum(rows for _, rows, _ in log.batches(query.id)) == 10 and len(log.batches(query.id)) >= 4
        assert log.ended(query.id) and log.stalled(0) == []
        log._touch("another")
        time.sleep(0.01)
        assert log.stalled(0) == ["another"] and log.stalled(60) == []
    finally:
        spark.streams.removeListener(log)


def texts(spark, *pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, page string").withColumn("p", html.parts("page"))
    return [r["t"] for r in df.orderBy("i").select(html.text_of(F.col("p")).alias("t")).collect()]


def test_odd_pages(spark):
    nested = "<table><tr><td>Left<table><tr><td>a</td><td>1</td></tr><tr><td>b</td><td>2</td></tr></table></td><td>Right</td></tr></table>"
    got = texts(spark, None, "", "plain &amp; text", "<p>one<p>two<script>no", "<div style='visibility:hidden'>no</div>yes", nested, "<td>stray</td> cell", "<table><tr><td colspan=2>Sum</td></tr><tr><td>a</td><td>1</td></tr></table>")
    assert got[:5] == [None, "", "plain & text", "one\n\ntwo", "yes"]
    assert "Left" in got[5] and "Right" in got[5] and "<TABLE>" in got[5] and got[5].count("<TABLE>") == 1
    assert got[6] == "stray cell"
    assert "Sum" in got[7] and "<TABLE>" in got[7]
