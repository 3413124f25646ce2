"""A keyed table that streams write to and that is merged by key: rows of the last batch win.

A store is a folder of data folders and of versions. A version is one small file, ``versions/<number>``, that names the data
folders that are live: a base, whose rows are one per key, and the batches since. Everything else in the folder is
no part of the table. A version's file is written under another name and then renamed, which fails if that version is
there already (where a store's rename overwrites, let one process write); so an append or a compaction is there whole or not
at all, and one that was stopped half-way changes no reader's rows.

* ``append`` adds a batch by its number. The batch of a number that is there already is passed over, so a stream's batch that runs
  again after a failure is in the table once.
* ``compact`` merges base and batches by key into a new base. Rows lie in buckets of their key (a folder each), so merging and
  reading join within buckets, and looking keys up reads their buckets only.
* ``current`` reads a version: the base as it is, with nothing shuffled, where no batch came since; else the base's rows without
  newer ones, and the batches' last.
* ``vacuum`` removes data folders that no version names any more, and all versions but the last ones.

A null key is a key like any other. Of rows of one key in one batch one stays (the greatest). A table without rows is one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64
BUCKET, BATCH = "_bucket", "_batch"


class Store:
    """``key`` names the key's column; ``schema`` is that of the rows. The number of buckets is fixed when the store is made."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: StructType | str, buckets: int = BUCKETS):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._file = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))
        self._fs = self._file().getFileSystem(conf)
        self._jvm = jvm
        if not self._numbers():
            self._publish(0, {"base": None, "batches": [], "merged": [], "buckets": buckets})
        self.buckets = self.version()["buckets"]

    # ------------------------------------------------------------ versions

    def _numbers(self) -> list[int]:
        folder = self._file("versions")
        if not self._fs.exists(folder):
            return []
        return sorted(int(s.getPath().getName()) for s in self._fs.listStatus(folder) if s.getPath().getName().isdigit())

    def version(self, number: int | None = None) -> dict:
        """What a version names; the newest by default."""
        number = self._numbers()[-1] if number is None else number
        stream = self._fs.open(self._file("versions", f"{number:012d}"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {**json.loads(text), "number": number}

    def _publish(self, number: int, content: dict) -> bool:
        """Make a version unless there is one of that number: whole, as it gets its name when it is written."""
        own = self._file("versions", f"_{uuid.uuid4().hex}")
        stream = self._fs.create(own, False)
        stream.write(json.dumps({k: v for k, v in content.items() if k != "number"}).encode())
        stream.close()
        to = self._file("versions", f"{number:012d}")
        made = not self._fs.exists(to) and self._fs.rename(own, to)
        if not made:
            self._fs.delete(own, False)
        return made

    # ------------------------------------------------------------ writing

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, folder: str) -> None:
        """Rows by bucket; a bucket's rows come together first, so it gets a few files and not one of every task."""
        rows.withColumn(BUCKET, self._bucket()).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")

    def append(self, batch: DataFrame, number: int) -> bool:
        """Add a batch; false if the table has it already. Of two writers of one number one adds it."""
        folder = None
        while True:
            live = self.version()
            if number in live["merged"] or any(n == number for n, _ in live["batches"]):
                return False
            if folder is None:
                folder = f"batch-{number}-{uuid.uuid4().hex[:12]}"
                columns = self.schema.names
                one = batch.select(columns).groupBy(self.key).agg(F.max(F.struct(*[c for c in columns if c != self.key])).alias("_row"))
                self._write(one.select(*[self.key if c == self.key else F.col(f"_row.{c}") for c in columns]), folder)
            if self._publish(live["number"] + 1, {**live, "batches": sorted([*live["batches"], [number, folder]])}):
                return True

    def compact(self) -> bool:
        """Merge the live batches into a new base; false if there are none. Batches that come meanwhile stay live."""
        start = self.version()
        if not start["batches"]:
            return False
        folder = f"base-{uuid.uuid4().hex[:12]}"
        self._write(self._rows(start, None), folder)
        while True:
            live = self.version()
            if live["base"] != start["base"]:
                return False  # another compaction was first; this one's folder is named by no version
            rest = [b for b in live["batches"] if b not in start["batches"]]
            merged = sorted({*live["merged"], *(n for n, _ in start["batches"])})
            if self._publish(live["number"] + 1, {**live, "base": folder, "batches": rest, "merged": merged}):
                return True

    def vacuum(self, keep: int = 2) -> int:
        """Remove all versions but the last ``keep`` and the data folders that these don't name; how many folders went.

        Nothing may be writing: the folder of an append that has not been published looks like one that nobody names.
        """
        numbers = self._numbers()
        for n in numbers[:-keep]:
            self._fs.delete(self._file("versions", f"{n:012d}"), False)
        named = set()
        for n in numbers[-keep:]:
            v = self.version(n)
            named |= {v["base"], *(folder for _, folder in v["batches"])}
        gone = [s.getPath() for s in self._fs.listStatus(self._file()) if s.getPath().getName().startswith(("base-", "batch-")) and s.getPath().getName() not in named]
        for path in gone:
            self._fs.delete(path, True)
        return len(gone)

    # ------------------------------------------------------------ reading

    def _folder(self, folder: str) -> DataFrame:
        schema = StructType([*self.schema.fields, *StructType.fromDDL(f"{BUCKET} int").fields])
        return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")

    def _rows(self, live: dict, keys: list | None) -> DataFrame:
        def of(folder: str) -> DataFrame:
            rows = self._folder(folder)
            if keys is None:
                return rows
            found = self.spark.createDataFrame([(k,) for k in keys], StructType([self.schema[self.key]])).select(self._bucket().alias("b"))
            own = sorted(r["b"] for r in found.distinct().collect())  # of the keys asked for
            return rows.where(F.col(BUCKET).isin(own) & (F.col(self.key).isin([k for k in keys if k is not None]) | (F.col(self.key).isNull() if None in keys else F.lit(False))))

        columns = self.schema.names
        base = of(live["base"]) if live["base"] else None
        if not live["batches"]:
            return base.select(columns) if base is not None else self.spark.createDataFrame([], self.schema)
        new = None
        for number, folder in live["batches"]:
            own = of(folder).withColumn(BATCH, F.lit(number))
            new = own if new is None else new.unionByName(own)
        last = Window.partitionBy(BUCKET, self.key).orderBy(F.desc(BATCH))
        new = new.withColumn("_n", F.row_number().over(last)).where("_n = 1").select(*columns, BUCKET)
        if base is None:
            return new.select(columns)
        told = new.select(F.col(BUCKET).alias("_b"), F.col(self.key).alias("_k"))
        old = base.join(told, (F.col(BUCKET) == F.col("_b")) & F.col(self.key).eqNullSafe(F.col("_k")), "left_anti")
        return old.select(columns).unionByName(new.select(columns))

    def current(self, keys: list | None = None, version: int | None = None) -> DataFrame:
        """The table's rows, or those of a few keys, in its newest or another version."""
        return self._rows(self.version(version), keys)
