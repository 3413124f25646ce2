"""The state machine of retries: repeats, late outcomes, time-outs, and a stop between rounds."""

from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from docweave.streaming import retries

START = dt.datetime(2024, 1, 1)


def at(seconds: int) -> dt.datetime:
    return START + dt.timedelta(seconds=seconds)


def land(spark, folder, rows):
    spark.createDataFrame(rows, f"k string, {retries.OUTCOME}").coalesce(1).write.mode("append").parquet(f"{folder}/outcomes")
    retries.take_in(spark, folder, "k", "string", pause=10, patience=100, late="0 seconds")
    return {(r["k"], r["kind"], r["address"], r["attempt"], r["reason"] or r["body"]) for r in retries.answers(spark, folder, "k", "string").collect()}


def test_repeats_late_outcomes_and_time_outs(spark, tmp_path):
    folder = str(tmp_path)
    got = land(spark, folder, [("a", 0, 0, None, None, at(0)), ("b", 0, 0, None, None, at(1)), (None, 0, 0, None, None, at(1)), ("c", 0, 1, 200, "not asked for", at(1))])
    asked = {("a", "request", 0, 1, None), ("b", "request", 0, 1, None)}
    assert got == asked
    # a's answer comes twice, the second time with another body; b's first is limited
    got = land(spark, folder, [("a", 0, 1, 200, "text", at(2)), ("a", 0, 1, 200, "other", at(3)), ("b", 0, 1, 429, None, at(4))])
    asked |= {("a", "done", 0, 1, "text"), ("b", "request", 0, 2, None)}
    assert got == asked
    # b's first answer again, and a's page again: nothing; then time passes b's second and third request, and its second address
    got = land(spark, folder, [("b", 0, 1, 200, "late", at(5)), ("a", 0, 0, None, None, at(6)), ("z", 0, 1, 200, "clock", at(4000))])
    asked |= {("b", "request", 0, 3, None)}
    assert got >= asked
    for n in range(1, 7):
        got = land(spark, folder, [("z", 0, 1, 200, "clock", at(4000 + 1000 * n))])
    assert ("b", "dead", 1, 3, "exhausted") in got and len([g for g in got if g[0] == "b" and g[1] == "request"]) == 6
    assert len([g for g in got if g[1] in ("done", "dead")]) == 2
    due = {(r["address"], r["attempt"]): r["due"] for r in retries.answers(spark, folder, "k", "string").where("k = 'b' and kind = 'request'").collect()}
    assert due[0, 2] == at(14) and due[1, 1] - due[0, 3] == dt.timedelta(seconds=100)


def test_a_stopped_crawl_goes_on(spark, tmp_path, monkeypatch):
    wanted = spark.createDataFrame([(i, at(i)) for i in range(12)], "k long, at timestamp")
    tried = wanted.select("k", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("address")).select("*", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("attempt"))
    status = F.when(F.col("attempt") + 3 * F.col("address") == F.col("k") % 7 + 1, 200).otherwise(503).cast("int")
    responses = tried.select("k", "address", "attempt", status.alias("status"), F.concat(F.lit("page "), F.col("k")).alias("body"))
    whole = sorted(map(tuple, retries.crawl(spark, wanted, responses, "k", f"{tmp_path}/whole").collect()), key=str)
    calls, run = [], retries.take_in

    def stops(*args, **limits):
        calls.append(1)
        run(*args, **limits)
        if len(calls) == 3:
            raise RuntimeError("stopped")

    monkeypatch.setattr(retries, "take_in", stops)
    with pytest.raises(RuntimeError):
        retries.crawl(spark, wanted, responses, "k", f"{tmp_path}/parts")
    again = sorted(map(tuple, retries.crawl(spark, wanted, responses, "k", f"{tmp_path}/parts").collect()), key=str)
    assert again == whole and {r[1] for r in whole} == {"request", "done", "dead"}


class Handle:
    """A handle of state for one key after the other, without Spark."""

    def __init__(self):
        self.kept, self.key, self.timers = {}, None, set()

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.kept.get(self.key)

    def exists(self):
        return self.key in self.kept

    def update(self, value):
        self.kept[self.key] = value

    def registerTimer(self, at):
        self.timers.add((self.key, at))

    def deleteTimer(self, at):
        self.timers.remove((self.key, at))


def test_an_outcome_is_little_work(spark):
    """The machine takes and gives rows: 20,000 outcomes take far less than the minute that a table for each of them took."""
    handle, made = Handle(), retries.Retries("k")
    made.init(handle)
    began, found = time.time(), []
    for key in range(10_000):
        handle.key = key
        for attempt, status, body in ((0, None, None), (1, 200, "text")):
            found += made.handleInputRows((key,), iter([Row(k=key, address=0, attempt=attempt, status=status, body=body, now=1000 + attempt)]), None)
    assert time.time() - began < 10
    assert len(found) == 20_000 and [tuple(r) for r in found[:2]] == [(0, "request", 0, 1, 1000, None, None), (0, "done", 0, 1, None, "text", None)]
    assert handle.timers == set() and all(closed for *_, closed in handle.kept.values())


def test_a_round_reads_only_what_was_answered_where_it_asks(spark, tmp_path):
    """Every page fails everywhere, so each of six rounds asks at one place: a response's text is made once, not in every round."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(key):
        made.add(1)
        return f"page {key}"

    wanted = spark.createDataFrame([(i, at(i)) for i in range(12)], "k long, at timestamp")
    tried = wanted.select("k", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("address")).select("*", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("attempt"))
    responses = tried.select("k", "address", "attempt", F.lit(503).alias("status"), text("k").alias("body"))
    said = retries.crawl(spark, wanted, responses, "k", str(tmp_path)).collect()
    assert len([r for r in said if r["kind"] == "request"]) == 72 and len([r for r in said if r["kind"] == "dead" and r["reason"] == "exhausted"]) == 12
    assert made.value == 72
