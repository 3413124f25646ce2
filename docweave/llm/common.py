"""Shared pieces of the training-data operators: tables in the shared folder, and column plumbing."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, wherever an operator counts or shingles words: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Whether the files of a query's shuffles go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_OWN: dict[str, str] = {}
#: How many tables are being written, and what the setting was before the first of them.
_WRITING = {"now": 0, "before": "false"}
_LOCK = threading.Lock()
#: For each thread the tables that its open steps have written, in order; the innermost step is last.
_STEPS = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, inside ``spark.checkpoint.dir``, which all executors share.

    Only where that setting is absent and all runs on this machine (tests) a temporary folder is made and used instead.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir")
    key = sc.applicationId
    if key not in _OWN:
        if not root and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = root or tempfile.mkdtemp(prefix="docweave-")
        _OWN[key] = f"{root.rstrip('/')}/docweave-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, _OWN[key])
    return _OWN[key]


def _remove(spark: SparkSession, folder: str) -> None:
    """At exit the application's intermediate tables go; a session that has ended already leaves them to the cluster."""
    sc = spark.sparkContext
    if sc._jsc is None:
        return
    try:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the JVM may have gone first
        return


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back: its lineage ends there.

    A lost executor then costs a re-read, never a recomputation, and values such as row ids stay as they were written.
    What was shuffled for the table is removed as soon as it is written; the session's setting for that is as it was once
    no table is being written any more.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    with _LOCK:
        if not _WRITING["now"]:
            _WRITING["before"] = spark.conf.get(CLEANUP)
            spark.conf.set(CLEANUP, "true")
        _WRITING["now"] += 1
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        with _LOCK:
            _WRITING["now"] -= 1
            if not _WRITING["now"]:
                spark.conf.set(CLEANUP, _WRITING["before"])
    if getattr(_STEPS, "open", None):
        _STEPS.open[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def only_last(spark: SparkSession) -> Iterator[None]:
    """Of the tables that this thread settles inside, all but the last go at the end, and the last too if the step fails: for a
    step whose result is the last one. Steps may hold steps; other threads' tables are theirs."""
    steps = _STEPS.__dict__.setdefault("open", [])
    steps.append([])
    kept = 0
    try:
        yield
        kept = 1
    finally:
        tables = steps.pop()
        for path in tables[: len(tables) - kept]:
            _remove(spark, path)
        if steps:
            steps[-1].extend(tables[len(tables) - kept :])


def fresh(df: DataFrame, name: str) -> str:
    """A name like ``name`` that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(column: str | Column) -> Column:
    """A text column whose nulls are empty strings."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
