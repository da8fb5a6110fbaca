"""Keyed JSON documents as single files: a data source whose tasks write ordered parts, and a join of the parts, file by file, on executors.

A document is one object, ``{"key":value,...}``, in the order of its keys. Rows (file, key, value; value is JSON text) are sorted by file and key over all tasks; each
task appends to a part for each file it sees. Nothing of a document passes through the driver but the names of its parts. Paths are those that Arrow's
file systems open, in a store that all executors reach.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

SCHEMA = "file string, key string, value string"
#: Bytes that a join holds of a part.
BUFFER = 1 << 20


def opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or URI, and the path inside it."""
    if path.startswith("file:"):  # as Spark writes them, blanks and all
        return pyarrow.fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)


def quoted(key: str) -> str:
    return json.dumps(key, ensure_ascii=False)


@dataclass
class Parts(WriterCommitMessage):
    """A task's parts: (file, task's number, path)."""

    parts: list[tuple[str, int, str]]


class KeyedParts(DataSourceArrowWriter):
    """Writes parts below ``path``; their list, parts.json, stands there only once all tasks have succeeded."""

    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        fs, folder = opened(self.path)
        task = TaskContext.get()
        number, attempt = (task.partitionId() if task else 0), uuid.uuid4().hex
        parts: list[tuple[str, int, str]] = []
        out, current = None, None
        try:
            for batch in iterator:
                for file, key, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    if out is None or file != current:
                        if out is not None:
                            out.close()
                        current = file
                        path = f"{folder}/{number}-{len(parts)}-{attempt}"
                        out = fs.open_output_stream(path)
                        parts.append((file, number, path))
                        comma = ""
                    out.write(f"{comma}{quoted(key)}:{'null' if value is None else value}".encode())
                    comma = ","
        finally:
            if out is not None:
                out.close()
        return Parts(parts)

    def commit(self, messages: list[Parts]) -> None:
        fs, folder = opened(self.path)
        with fs.open_output_stream(f"{folder}/parts.json") as f:
            f.write("\n".join(json.dumps(p) for m in messages if m for p in m.parts).encode())

    def abort(self, messages: list[Parts]) -> None:
        fs, folder = opened(self.path)
        fs.delete_dir_contents(folder, missing_dir_ok=True)


class KeyedDocuments(DataSource):
    """Format ``keyed_parts``, for writing only."""

    @classmethod
    def name(cls) -> str:
        return "keyed_parts"

    def writer(self, schema, overwrite: bool) -> KeyedParts:
        return KeyedParts(self.options["path"])


def write_documents(df: DataFrame, file: str, key: str, value: str, path: str) -> int:
    """Write one document a file into the folder ``path``, over documents of the same names; the number of documents.

    Cases: rows with a null file or key are left out; a null value is written as null; a key that repeats in a file is written as often; of no rows
    nothing is written. A run that fails leaves the folder's documents as they were: parts lie in a hidden folder, which is removed, and a document takes its place whole.
    """
    spark = df.sparkSession
    spark.dataSource.register(KeyedDocuments)
    fs, folder = opened(path)
    fs.create_dir(folder, recursive=True)
    hidden = f"{path}/.parts-{uuid.uuid4().hex}"
    scratch = opened(hidden)[1]
    fs.create_dir(scratch)
    rows = df.select(F.col(file).alias("file"), F.col(key).cast("string").alias("key"), F.col(value).alias("value")).where("file is not null and key is not null")
    try:
        rows.repartitionByRange("file", "key").sortWithinPartitions("file", "key").write.format("keyed_parts").mode("append").save(hidden)
        listed = f"{scratch}/parts.json"
        if fs.get_file_info(listed).type == pyarrow.fs.FileType.NotFound:
            return 0
        return _joined(spark, path, hidden)
    finally:
        fs.delete_dir(scratch)


def _joined(spark: SparkSession, path: str, hidden: str) -> int:
    """Join the listed parts, a task a document, in order of their tasks."""
    fs, scratch = opened(hidden)
    with fs.open_input_stream(f"{scratch}/parts.json") as f:
        parts = [json.loads(line) for line in f.read().decode().splitlines()]
    if not parts:
        return 0
    by_file: dict[str, list[tuple[int, str]]] = {}
    for file, number, part in parts:
        by_file.setdefault(file, []).append((number, part))
    rows = spark.createDataFrame([(file, [p for _, p in sorted(own)]) for file, own in by_file.items()], "file string, parts array<string>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, folder = opened(path)
                whole = f"{opened(hidden)[1]}/whole-{uuid.uuid4().hex}"
                with fs.open_output_stream(whole) as out:
                    out.write(b"{")
                    for i, part in enumerate(own):
                        out.write(b"," if i else b"")
                        with fs.open_input_stream(part) as f:
                            while data := f.read(BUFFER):
                                out.write(data)
                    out.write(b"}")
                fs.move(whole, f"{folder}/{file}")
                yield pa.record_batch([pa.array([file])], names=["file"])

    return rows.repartition(len(by_file), "file").mapInArrow(run, "file string").count()
