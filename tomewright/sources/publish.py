"""Publishing of JSON lines after verification: readers see the state before or the state after, nothing between.

Tasks write their part to a folder of the run. When all are done, every part is read back and compared with what its task
says of it; then the manifest of the new state is put in the place of the old one, which is one rename. A task that fails,
or a part that isn't what was written, leaves the published state as it was.

Paths are those of any file system that Arrow opens (a mounted folder, or a URI of a store)."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

MANIFEST = "manifest.json"
REPLACEMENT = "�"


class NotVerified(RuntimeError):
    """A part that was read back isn't what was to be published."""


@dataclass
class Part(WriterCommitMessage):
    file: str
    rows: int
    sha256: str


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def verified(content: bytes, part: Part) -> None:
    """Raises unless the bytes are those of the part, strict UTF-8 without a byte-order mark or a replacement character, and a
    JSON document in each line."""
    if hashlib.sha256(content).hexdigest() != part.sha256:
        raise NotVerified(f"{part.file}: not what was written")
    try:
        text = content.decode("utf-8", "strict")
        lines = [json.loads(line) for line in text.split("\n")[:-1]]
    except ValueError as e:
        raise NotVerified(f"{part.file}: {e}") from e
    if text.startswith("﻿") or REPLACEMENT in text:
        raise NotVerified(f"{part.file}: a byte-order mark or a replacement character")
    if len(lines) != part.rows:
        raise NotVerified(f"{part.file}: {len(lines)} of {part.rows} rows")


class _Writer(DataSourceWriter):
    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns, self.run = path, columns, uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> Part:
        store, root = _open(self.path)
        context = TaskContext.get()
        name = f"{self.run}/part-{context.partitionId():05d}-{context.taskAttemptId()}.jsonl"  # attempts don't share a file
        store.create_dir(f"{root}/{self.run}", recursive=True)
        digest, rows = hashlib.sha256(), 0
        with store.open_output_stream(f"{root}/{name}") as out:
            for row in iterator:
                own = row.asDict(recursive=True)
                line = json.dumps({c: own[c] for c in self.columns}, ensure_ascii=False, separators=(",", ":"), default=str).encode() + b"\n"
                digest.update(line)
                out.write(line)
                rows += 1
        return Part(name, rows, digest.hexdigest())

    def commit(self, messages: list[Part | None]) -> None:
        store, root = _open(self.path)
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.file)
        try:
            for part in parts:  # a part at a time, so the driver holds one
                with store.open_input_stream(f"{root}/{part.file}") as f:
                    verified(f.read(), part)
        except NotVerified:
            self.abort(messages)
            raise
        manifest = {"run": self.run, "rows": sum(p.rows for p in parts), "parts": [[p.file, p.rows, p.sha256] for p in parts]}
        store.create_dir(root, recursive=True)
        fresh = f"{root}/.{self.run}.json"
        with store.open_output_stream(fresh) as out:
            out.write(json.dumps(manifest).encode())
        store.move(fresh, f"{root}/{MANIFEST}")

    def abort(self, messages: list[Part | None]) -> None:
        store, root = _open(self.path)
        if store.get_file_info(f"{root}/{self.run}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/{self.run}")


class Published(DataSource):
    @classmethod
    def name(cls) -> str:
        return "published"

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], schema.fieldNames())


def publish(rows: DataFrame, path: str, key: str) -> None:
    """Publishes rows in order of the key as the new state of the folder."""
    rows.sparkSession.dataSource.register(Published)
    rows.orderBy(key).write.format("published").mode("append").save(path)


def manifest(path: str) -> dict | None:
    """What is published now: run, rows and parts (file, rows, sha256); None before the first time."""
    store, root = _open(path)
    if store.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.NotFound:
        return None
    with store.open_input_stream(f"{root}/{MANIFEST}") as f:
        return json.loads(f.read())


def published(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The published rows. A reader that has the state keeps it while a newer one is published."""
    now = manifest(path)
    if not now or not now["parts"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json([f"{path}/{p[0]}" for p in now["parts"]], mode="FAILFAST")


def superseded(path: str) -> list[str]:
    """Folders of runs that aren't the published one: what may be deleted once no reader is left."""
    store, root = _open(path)
    now = manifest(path)
    found = store.get_file_info(fs.FileSelector(root))
    return sorted(f.path for f in found if f.type == fs.FileType.Directory and (not now or f.base_name != now["run"]))
