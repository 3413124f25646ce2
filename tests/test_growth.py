"""What must not be worked out again for each row, cell or block, and what must run on all cores."""

from __future__ import annotations

import glob
import re
import time

import pytest
from pyspark.sql import functions as F

from docweave import plans
from docweave.functions import filings
from docweave.functions.find import find_all
from docweave.operators import dictionary, filing, html, repair
from docweave.sources import tables as sources
from docweave.streaming import ingest


def times(column, part: str) -> int:
    """How often a plan holds an expression."""
    return column._jc.toString().count(part)


@pytest.mark.parametrize(("name", "key"), [("contents_and_boundary", "o_orderkey"), ("sparse_columns", "o_orderkey"), ("home_country", "c_custkey")])
def test_rows_are_dealt_to_all_cores(spark, small, name, key):
    """One small file is one task, however much work its rows are."""
    cores = 4 * spark.sparkContext.defaultParallelism
    assert re.search(rf"Exchange hashpartitioning\({key}#\d+L?, {cores}\), REPARTITION_BY_NUM",  plans.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString())


def test_match_keys_of_a_contents_table_are_made_once(spark):
    assert times(filing.without_contents(F.col("b")), "[^a-z0-9]+") == 2


def test_columns_of_a_sparse_table_are_judged_once(spark):
    assert times(repair.merged_sparse(F.col("r")), r"^[$") == 1


def test_a_sparse_table_keeps_the_order_of_signs_and_figures(spark):
    table = [["Sales", "$", "1", ")", "(", "2"], *[[f"Row {n}", "", "3", "", "", "4"] for n in range(5)]]
    made = spark.createDataFrame([(table,), (None,), ([],)], "r array<array<string>>").select(repair.merged_sparse(F.col("r"))).collect()
    assert [made[0][0][0], made[0][0][1]] == [["Sales", "$1)", "(2"], ["Row 0", "3", "4"]]
    assert (made[1][0], made[2][0]) == (None, [])


def test_widths_of_a_wide_table_are_worked_out_once(spark):
    """Time by a table's cells, not by their square: 2,400 of them."""
    page = "<table>" + "".join("<tr>" + "".join(f"<td>{i}.{j}</td>" for j in range(40)) + "</tr>" for i in range(60)) + "</table>"
    d = spark.createDataFrame([(page,)], "page string").withColumn("parts", html.parts("page"))
    d.limit(0).collect()
    began = time.time()
    lines = d.select(html.text_of(F.col("parts"))).first()[0].split("\n")
    assert len(lines) == 65 and lines[-2].split() == [f"59.{j}" for j in range(40)]
    assert time.time() - began < 20


def test_pages_become_the_same_parts_whatever_tags_have(spark):
    """Tags with and without attributes, in any case, raw text, and null and empty pages between others."""
    pages = [None, "", "<P>one<TABLE><TR><TH>a</TH><td>b</td></TR><tr><td>c</td><td class=x>d</td></tr></TABLE>", "<script>if (a<b>c) x</script><p >two</p ><textarea><p>t</textarea>"]
    found = html.read(pages).to_pylist()
    cell = lambda text, th=False: {"text": text, "th": th, "above": False, "below": False, "bold": False, "underlined": False}
    assert found[:2] == [None, []]
    assert found[2] == [{"text": "one", "caption": None, "rows": None}, {"text": None, "caption": None, "rows": [[cell("a", True), cell("b")], [cell("c"), cell("d")]]}]
    assert found[3][0] == {"text": "two", "caption": None, "rows": None}


def test_pages_of_a_micro_batch_are_dealt_to_all_cores(spark, tmp_path):
    """One landed file is parsed by as many tasks as there are cores, each of which writes a file."""
    pages = spark.range(400).select("id", F.repeat(F.lit("It tells at length what it did. "), 10).alias("raw"))
    pages.coalesce(1).write.parquet(f"{tmp_path}/landed")
    ingest.ingest(ingest.pages(spark, f"{tmp_path}/landed", "id bigint, raw string"), "id", "raw", f"{tmp_path}/to", f"{tmp_path}/at").awaitTermination()
    assert len(glob.glob(f"{tmp_path}/to/batch=0/*.parquet")) == spark.sparkContext.defaultParallelism
    assert spark.read.parquet(f"{tmp_path}/to").count() == 400


@pytest.mark.parametrize("n", [0, 1, 999, 1000, 4321, 70_000])
def test_merged_chunks_are_full_files_written_by_a_few_tasks(spark, tmp_path, n):
    """All files but one have the rows asked for, and the writers are bounded by the cores, not by the files."""
    sources.write_chunks(spark.range(n, numPartitions=3), f"{tmp_path}/chunks", 300)
    sources.merge_chunks(spark, f"{tmp_path}/chunks", f"{tmp_path}/to", (), 1000)
    merged = spark.read.parquet(f"{tmp_path}/to")
    assert (merged.count(), merged.distinct().count()) == (n, n)
    sizes = sorted(r["count"] for r in merged.groupBy(F.input_file_name()).count().collect())
    assert len(sizes) == -(-n // 1000) and all(s == 1000 for s in sizes[1:])
    writers = {f.rsplit("/part-", 1)[1].split("-")[0] for f in glob.glob(f"{tmp_path}/to/*.parquet")}
    assert len(writers) <= 2 * spark.sparkContext.defaultParallelism


def test_each_cue_of_a_country_holds_one_of_its_words(spark):
    """A cue's words stand for its pattern, whatever the case, so no match is lost."""
    said = ("Jurisdiction of incorporation or organization", "home  country", "Headquartered in", "incorporated in", "DOMICILE", "domiciled", "principal place of business", "corporate headquarters", "reporting currency",
            "Address of principal executive offices", "executive office", "registered office", "Companies Act 2006", "laws of England and Wales", "company law", "Company laws")
    place = lambda n: F.array(F.struct((n + 1).alias("start"), (n + 7).alias("end"), F.lit("FR").alias("code")))
    rows = spark.createDataFrame([(f"{s} France",) for s in said], "t string").withColumn("at", F.length("t") - 7)
    got = rows.select("t", F.size(filings.country_scores(F.col("t"), place(F.col("at")))).alias("n")).collect()
    assert all(r["n"] >= 1 for r in got), [r["t"] for r in got if r["n"] < 1]
    plan = rows.select(filings.country_scores(F.col("t"), place(F.col("at"))))._jdf.queryExecution().optimizedPlan().toString()
    assert all(f", {w})" in plan for _, _, words in filings.COUNTRY_CUES for w in words)


def test_the_year_of_a_report_is_searched_for_once(spark):
    """A head's dates are found once, whatever is asked of the first; before, once for each question."""
    for pattern, part in ((filings.ANNUAL_REPORT, "ANNUAL"), (filings.YEAR_ENDED, "(?i)year")):
        once = times(find_all(F.col("t"), pattern), part)
        assert 0 < once == times(filings.report_year(F.col("t"), F.col("n")), part)


def test_near_names_are_read_and_keyed_once(spark):
    """Rows of the input are made distinct before anything is made of them: 20 names in 200,000 rows are the work of 20 names."""
    rows = spark.range(200_000).select(F.concat(F.lit("Consolidated Steel Company of Town "), F.col("id") % 20).alias("name"))
    began = time.time()
    found = dictionary.fuzzy(rows.select(F.regexp_replace("name", "Town", "Tow").alias("candidate")), rows, "candidate", "name", 0.95)
    got = {(r["candidate"], r["name"]) for r in found.collect()}
    assert {(f"Consolidated Steel Company of Tow {n}", f"Consolidated Steel Company of Town {n}") for n in range(20)} <= got
    assert time.time() - began < 40
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Range (" not in plan and plan.count("ArrowEvalPython") == plan.count("Initial Plan") + 1
