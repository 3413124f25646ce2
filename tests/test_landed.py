"""Landed responses: odd bodies, empty and half-written folders, failed attempts, commits as offsets."""

from __future__ import annotations

import pytest

from docweave.sources import landed


def test_round_trip(spark, tmp_path):
    landed.register(spark)
    at = str(tmp_path / "pages")
    rows = [("a", 200, "line\n{\"size\": 3}\nend"), ("b", 200, "é" * 400_000), ("c", 200, None), ("d", 404, "gone"), ("e", 429, "slow"), ("f", None, None), ("g", 500, "x"), ("h", 301, "x"), ("i", 200, "")]
    df = spark.createDataFrame(rows, "url string, status int, body string")
    df.repartition(3).write.format("landed").mode("append").save(at)
    (tmp_path / "pages" / "_half").write_bytes(b'{"url": "z", "status": 200, "size": 99}\nshort')
    (tmp_path / "pages" / "notes.txt").write_text("no responses")
    got = {r["url"]: (r["status"], r["text"], r["outcome"]) for r in spark.read.format("landed").load(at).collect()}
    assert got == {
        "a": (200, rows[0][2], "found"), "b": (200, rows[1][2], "found"), "c": (200, "", "found"), "d": (404, "", "missing"), "e": (429, None, "retry"),
        "f": (None, None, "retry"), "g": (500, None, "retry"), "h": (301, None, "failed"), "i": (200, "", "found"),
    }


def test_nothing_landed(spark, tmp_path):
    landed.register(spark)
    assert spark.read.format("landed").load(str(tmp_path / "none")).collect() == []


def test_a_cut_file_is_an_error(spark, tmp_path):
    landed.register(spark)
    (tmp_path / f"{1:012d}-ab.responses").write_bytes(b'{"url": "z", "status": 200, "size": 99}\nshort')
    with pytest.raises(Exception, match="ends inside a body"):
        spark.read.format("landed").load(str(tmp_path)).collect()


def test_commits_are_offsets(tmp_path):
    writer, stream = landed.Writer(str(tmp_path)), landed.Stream(str(tmp_path))
    row = {"url": "u", "status": 200, "body": "text"}
    assert stream.latestOffset() == {"commit": 0}
    writer.commit([writer.write(iter([row])), None])
    failed = writer.write(iter([row]))
    writer.abort([failed, None])
    writer.commit([writer.write(iter([row, row])), writer.write(iter([row]))])
    assert stream.latestOffset() == {"commit": 2}
    assert len(stream.partitions({"commit": 0}, {"commit": 1})) == 1 and len(stream.partitions({"commit": 1}, {"commit": 2})) == 2
    assert sum(len(list(stream.read(p))) for p in stream.partitions({"commit": 1}, {"commit": 2})) == 3
