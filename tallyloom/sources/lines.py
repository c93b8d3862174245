"""Lines of text files with their place in the source: a data source over byte ranges.

A file is cut into ranges of ``split_bytes``; a range holds the lines that begin in it. A line's position is its file's number
(files in path order) and its byte offset, so it is the same for every split size, order of tasks and retry. Lines leave a task as
Arrow buffers, without work per line.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tallyloom.sources.exporter import resolved

FORMAT = "tallyloom_lines"
SPLIT_BYTES = 64 << 20
READ_BYTES = 4 << 20
OFFSET_BITS = 40  # a file of a terabyte; 8 million files
SCHEMA = "pos BIGINT, file STRING, offset BIGINT, line STRING"
_BROKEN = "_broken_line"


def listed(paths: list[str]) -> list[tuple[str, int]]:
    """Files at or below the paths with their sizes, in path order; names that begin with ``_`` or ``.`` are left out."""
    found = []
    for path in paths:
        system, own = resolved(path)
        info = system.get_file_info(own)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        if info.type == fs.FileType.File:
            found.append((path, info.size))
            continue
        for f in system.get_file_info(fs.FileSelector(own, recursive=True)):
            inside = f.path.removeprefix(own).strip("/").split("/")
            if f.type == fs.FileType.File and not any(part.startswith(("_", ".")) for part in inside):
                found.append((f"{path.rstrip('/')}/{'/'.join(inside)}", f.size))
    return sorted(found)


@dataclass
class Range(InputPartition):
    file: str
    number: int
    start: int
    end: int


def _batch(part: Range, at: int, content: bytes) -> pa.RecordBatch:
    """The lines of ``content``, which begins at byte ``at`` of the file and ends with a line end."""
    ends = np.flatnonzero(np.frombuffer(content, np.uint8) == 10) + 1
    starts = np.concatenate(([0], ends[:-1]))
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    lines = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(content)]).cast(pa.string())
    places = at + starts
    return pa.RecordBatch.from_arrays(
        [pa.array((part.number << OFFSET_BITS) + places), pa.array([part.file] * len(ends)), pa.array(places), lines], ["pos", "file", "offset", "line"]
    )


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], split_bytes: int):
        self.paths, self.split_bytes = paths, split_bytes

    def partitions(self) -> list[Range]:
        return [
            Range(file, number, start, min(start + self.split_bytes, size))
            for number, (file, size) in enumerate(listed(self.paths))
            for start in range(0, size, self.split_bytes)
        ]

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a source without files
            return
        system, own = resolved(partition.file)
        with system.open_input_file(own) as source:
            at = max(0, partition.start - 1)
            source.seek(at)
            rest, skipping = b"", partition.start > 0  # up to the end of the line that began before
            while at + len(rest) < partition.end or rest:
                more = source.read(READ_BYTES)
                content = rest + more
                if skipping:
                    end = content.find(b"\n")
                    if end < 0 and more:
                        at, rest = at + len(content), b""
                        if at >= partition.end:
                            return
                        continue
                    at, content, skipping = at + end + 1, content[end + 1 :] if end >= 0 else b"", False
                if at >= partition.end:
                    return
                cut = content.rfind(b"\n") + 1 if more else len(content)
                if at + cut > partition.end:  # the last line is the one that begins before the end of the range
                    last = content.find(b"\n", partition.end - at - 1)
                    cut = last + 1 if last >= 0 else 0 if more else len(content)
                whole, rest = content[:cut], content[cut:]
                if whole:
                    yield _batch(partition, at, whole if whole.endswith(b"\n") else whole + b"\n")
                at += cut
                if not more or at >= partition.end:
                    return


class Lines(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> _Reader:
        return _Reader(json.loads(self.options["paths"]), int(self.options["split_bytes"]))


def read_lines(spark: SparkSession, path: str | list[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``(pos, file, offset, line)`` of every line, line ends included."""
    spark.dataSource.register(Lines)
    paths = json.dumps([path] if isinstance(path, str) else path)
    return spark.read.format(FORMAT).option("paths", paths).option("split_bytes", str(split_bytes)).load()


def read_json_lines(spark: SparkSession, path: str | list[str], schema: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The fields of ``schema`` from one JSON object per line, with ``pos``, the line's position, in place of any such field.

    Blank lines are skipped; a line that is no such object is an error naming its file and byte offset.
    """
    fields = [f for f in T._parse_datatype_string(schema).fields if f.name != "pos"]
    whole = T.StructType([*fields, T.StructField(_BROKEN, T.StringType())])
    filled = F.col("line").rlike(r"[^\s]")
    lines = read_lines(spark, path, split_bytes).filter(filled)
    parsed = lines.select("pos", "file", "offset", filled.alias("filled"), F.from_json("line", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}).alias("row"))
    broken = F.raise_error(F.concat(F.lit("malformed line in "), "file", F.lit(" at byte "), F.col("offset").cast("string"))).cast("bigint")
    # A condition on ``pos`` may be tested before the filter above, so the error asks for a filled line itself.
    bad = F.col("filled") & (F.col("row").isNull() | F.col(f"row.{_BROKEN}").isNotNull())
    return parsed.select(F.when(bad, broken).otherwise(F.col("pos")).alias("pos"), *[F.col(f"row.`{f.name}`") for f in fields])
