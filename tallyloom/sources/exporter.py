"""All-or-nothing JSONL exports: a data source whose tasks fingerprint what they write, and the publishing of a whole folder.

A task writes its rows as they come, ready lines from the JVM, and returns for every file its name, bytes, rows, SHA-256 and
multiset digest. The commit lists them beside the folder and removes files no committed task names (of killed or repeated
attempts); a failed write removes the folder. Nothing is read back. Paths are those that Arrow's file systems know (local
or mounted folders, hdfs, s3, gs), the same from the driver and from executors.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "tallyloom_export"
RECEIPT = ".receipt.json"
_HALF = 30  # row hashes have 60 bits; halves of them can be summed over any number of rows of a file


def resolved(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a local path or an URI."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def exists(path: str) -> bool:
    system, own = resolved(path)
    return system.get_file_info(own).type != fs.FileType.NotFound


def remove(path: str) -> None:
    system, own = resolved(path)
    kind = system.get_file_info(own).type
    if kind == fs.FileType.Directory:
        system.delete_dir(own)
    elif kind != fs.FileType.NotFound:
        system.delete_file(own)


def write_file(path: str, content: str, mode: str = "errorifexists") -> None:
    """A small document as one file."""
    if mode == "errorifexists" and exists(path):
        raise AnalysisException(message=f"{path} is there already")
    remove(path)
    system, own = resolved(path)
    system.create_dir(own.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(own) as out:
        out.write(content.encode())


def read_file(path: str) -> str:
    system, own = resolved(path)
    with system.open_input_stream(own) as source:
        return source.read().decode()


@dataclass(frozen=True)
class File:
    file: str
    bytes: int
    rows: int
    sha256: str
    digest: str  # sum of the row hashes


@dataclass
class Receipt(WriterCommitMessage):
    part: int
    files: list[File]


class _Part:
    """One file in the making."""

    def __init__(self, system: fs.FileSystem, folder: str, name: str):
        self.name, self.rows, self.bytes, self.low, self.high = name, 0, 0, 0, 0
        self.hash, self.out = hashlib.sha256(), system.open_output_stream(f"{folder}/{name}")

    def add(self, lines: pa.Array, hashes: np.ndarray) -> None:
        _, offsets, data = lines.buffers()
        ends = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(lines.type) else np.int32)[lines.offset : lines.offset + len(lines) + 1]
        content = memoryview(data)[int(ends[0]) : int(ends[-1])] if data is not None else b""
        self.out.write(content)
        self.hash.update(content)
        self.rows += len(lines)
        self.bytes += len(content)
        self.low += int((hashes & ((1 << _HALF) - 1)).sum())
        self.high += int((hashes >> _HALF).sum())

    def close(self) -> File:
        self.out.close()
        return File(self.name, self.bytes, self.rows, self.hash.hexdigest(), str((self.high << _HALF) + self.low))


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, rows_per_file: int):
        self.path, self.rows_per_file = path, rows_per_file

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Receipt:
        task = TaskContext.get()
        system, folder = resolved(self.path)
        files, part = [], None
        try:
            for batch in iterator:
                at = 0
                while at < batch.num_rows:
                    if part is None:
                        system.create_dir(folder, recursive=True)
                        part = _Part(system, folder, f"part-{task.partitionId():05d}-{len(files):05d}-{task.taskAttemptId()}.jsonl")
                    piece = batch.slice(at, self.rows_per_file - part.rows)
                    part.add(piece.column(0), piece.column(1).to_numpy())
                    at += piece.num_rows
                    if part.rows == self.rows_per_file:
                        files.append(part.close())
                        part = None
        except BaseException:
            if part is not None:
                part.out.close()
            for name in [f.file for f in files] + ([part.name] if part is not None else []):
                remove(f"{self.path}/{name}")
            raise
        if part is not None:
            files.append(part.close())
        return Receipt(task.partitionId(), files)

    def commit(self, messages: list[Receipt | None]) -> None:
        files = [f for m in sorted((m for m in messages if m), key=lambda m: m.part) for f in m.files]
        system, folder = resolved(self.path)
        system.create_dir(folder, recursive=True)
        known = {f.file for f in files}
        for found in system.get_file_info(fs.FileSelector(folder)):
            if found.base_name not in known:
                system.delete_file(found.path)
        write_file(self.path + RECEIPT, json.dumps([asdict(f) for f in files]), "overwrite")

    def abort(self, messages: list[Receipt | None]) -> None:
        remove(self.path)


class JsonLines(DataSource):
    """Sink for ``(line STRING, hash BIGINT)``: lines with their line end, and the row hashes to add up."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], int(self.options["rows_per_file"]))


def write_lines(df: DataFrame, path: str, hashed: Column, *, columns: list[str], order_by: str | None = "pos", rows_per_file: int = 50_000) -> list[File]:
    """Writes ``columns`` of ``df`` as JSONL to a new folder, in one pass, and returns its files in order.

    Missing values are explicit nulls. With ``order_by``, files in name order hold the rows in order. A folder that is there
    already is an error; after a failure there is none.
    """
    if exists(path):
        raise AnalysisException(message=f"{path} is there already")
    spark = df.sparkSession
    spark.dataSource.register(JsonLines)
    line = F.concat(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), F.lit("\n"))
    ordered = df if order_by is None else df.orderBy(order_by)
    lines = ordered.select(line.alias("line"), hashed.alias("hash"))
    try:
        lines.write.format(FORMAT).mode("append").option("path", path).option("rows_per_file", str(rows_per_file)).save()
        return [File(**f) for f in json.loads(read_file(path + RECEIPT))]
    except BaseException:
        remove(path)
        raise
    finally:
        remove(path + RECEIPT)


@contextmanager
def published(out: str, overwrite: bool = False):
    """A staging folder beside ``out`` that takes its place when the block ends well and is removed when it doesn't.

    Readers of ``out`` see all of an export or nothing of it. With ``overwrite`` an earlier folder is moved away first and
    removed last; without it, one that is there is an error before any work is done.
    """
    out = out.rstrip("/")
    if not overwrite and exists(out):
        raise AnalysisException(message=f"{out} is there already")
    mark = uuid.uuid4().hex
    stage, old = f"{out}.staging-{mark}", f"{out}.replaced-{mark}"
    try:
        yield stage
        system, target = resolved(out)
        if exists(out):
            system.move(target, resolved(old)[1])
        try:
            system.move(resolved(stage)[1], target)
        except BaseException:
            if exists(old):
                system.move(resolved(old)[1], target)
            raise
    finally:
        remove(stage)
    remove(old)

