"""Landed responses as a source and a sink: ``spark.read.format("landed")``, ``readStream`` and ``write``, after ``register(spark)``.

A folder of files, each with any number of responses: a head line (JSON: url, status or null, the body's bytes) and the body as
it came. A commit's files carry its number, so a stream's offset is a commit, whatever came when: a batch reads the files
between two commits, and reads the same ones again after a failure. Every file is one partition, so commits should write
files of some 100 MB. Files are opened with ``pyarrow.fs``, so the folder may be in any store that it reaches; all executors
must reach it too.

A response keeps its status apart from its text:

| status | text | outcome |
|---|---|---|
| 200 | the body | ``found`` |
| 404 | empty | ``missing`` |
| 429, 5xx | null | ``retry`` |
| none (no answer in time) | null | ``retry`` |
| any other | null | ``failed`` |
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "url string, status int, text string, outcome string"
#: A file of a commit: its number, and a name of its own.
_FILE = re.compile(r"^(\d{12})-[0-9a-f]+\.responses$")
FOUND, MISSING, LIMITED = 200, 404, 429


def outcome(status: int | None) -> str:
    if status == FOUND:
        return "found"
    if status == MISSING:
        return "missing"
    return "retry" if status is None or status == LIMITED or status >= 500 else "failed"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))


def _files(path: str) -> list[tuple[int, str]]:
    """(commit, file), sorted; what isn't a committed file of responses is passed over."""
    store, root = _store(path)
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted((int(m.group(1)), f.path) for f in found if f.type == fs.FileType.File and (m := _FILE.match(f.base_name)))


@dataclass
class Landed(InputPartition):
    file: str


def _responses(path: str, file: str) -> Iterator[tuple]:
    store, _ = _store(path)
    with store.open_input_stream(file) as stream:
        rest = b""
        while True:
            end = rest.find(b"\n")
            while end < 0:
                more = stream.read(1 << 20)
                if not more:
                    if rest.strip():
                        raise ValueError(f"{file} ends inside a head")
                    return
                rest += more
                end = rest.find(b"\n")
            head = json.loads(rest[:end])
            rest, size = rest[end + 1 :], head["size"]
            if len(rest) < size:
                rest += stream.read(size - len(rest))
                if len(rest) < size:
                    raise ValueError(f"{file} ends inside a body")
            body, rest = rest[:size], rest[size:]
            kind = outcome(head["status"])
            text = body.decode("utf-8", "replace") if kind == "found" else "" if kind == "missing" else None
            yield head["url"], head["status"], text, kind


class Batch(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        return [Landed(file) for _, file in _files(self.path)]

    def read(self, partition: Landed) -> Iterator[tuple]:
        return _responses(self.path, partition.file) if isinstance(partition, Landed) else iter(())


class Stream(DataSourceStreamReader):
    """Offsets are numbers of commits: a batch takes what was committed since the one before it."""

    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {"commit": 0}

    def latestOffset(self) -> dict:
        return {"commit": max((n for n, _ in _files(self.path)), default=0)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [Landed(file) for n, file in _files(self.path) if start["commit"] < n <= end["commit"]]

    def read(self, partition: Landed) -> Iterator[tuple]:
        return _responses(self.path, partition.file)

    def commit(self, end: dict) -> None:
        pass


@dataclass
class Written(WriterCommitMessage):
    file: str


class Writer(DataSourceWriter):
    """Tasks write files under other names; the commit gives them the next number. A file of an attempt that failed is never seen."""

    def __init__(self, path: str):
        self.path = path

    def write(self, rows: Iterator) -> Written:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        file = f"{root}/_{uuid.uuid4().hex}"
        with store.open_output_stream(file) as out:
            for row in rows:
                body = (row["body"] or "").encode()
                out.write(json.dumps({"url": row["url"], "status": row["status"], "size": len(body)}).encode() + b"\n" + body)
        return Written(file)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        number = max((n for n, _ in _files(self.path)), default=0) + 1
        for m in messages:
            if m is not None:
                store.move(m.file, f"{root}/{number:012d}-{m.file.rsplit('_', 1)[1]}.responses")

    def abort(self, messages: list[Written | None]) -> None:
        store, _ = _store(self.path)
        for m in messages:
            if m is not None:
                store.delete_file(m.file)


class LandedResponses(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> Batch:
        return Batch(self.options["path"])

    def streamReader(self, schema: StructType) -> Stream:
        return Stream(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("landed responses are only appended")
        return Writer(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LandedResponses)
