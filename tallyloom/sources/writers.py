"""Sinks: JSONL exports with their descriptor, and one-row documents."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources import exporter

# How the roles of an export map to its columns.
_INSTRUCTION_ROLES = {"prompt": "instruction", "query": "input"}
DESCRIPTORS = {
    "sft": ("alpaca", False, {**_INSTRUCTION_ROLES, "response": "output"}),
    "dpo": ("alpaca", True, {**_INSTRUCTION_ROLES, "chosen": "chosen", "rejected": "rejected"}),
    "cpt": (None, False, {"prompt": "text"}),
}


def write_jsonl(
    df: DataFrame,
    path: str,
    *,
    order_by: str | None = "pos",
    drop: tuple[str, ...] = ("pos",),
    max_rows_per_file: int = 50_000,
    mode: str = "errorifexists",
) -> None:
    """One JSON object per line, UTF-8 as it is, missing values as explicit nulls.

    With ``order_by`` the rows are range-partitioned, so part files in name order hold the source order; pass None to
    write without that shuffle where the order of an export does not matter.
    """
    if order_by is not None:
        df = df.orderBy(order_by)
    df.drop(*drop).write.mode(mode).option("ignoreNullFields", "false").option(
        "maxRecordsPerFile", max_rows_per_file
    ).json(path)


def export_descriptor(spark: SparkSession, exports: dict[str, tuple[str, str]]) -> DataFrame:
    """``(name, file, formatting, ranking, columns)`` of exports given as ``{name: (kind, file)}``."""
    rows = []
    for name, (kind, file) in exports.items():
        formatting, ranking, columns = DESCRIPTORS[kind]
        rows.append((name, file, formatting, ranking, columns))
    return spark.createDataFrame(
        rows, "name STRING, file STRING, formatting STRING, ranking BOOLEAN, columns MAP<STRING, STRING>"
    )


def write_descriptor(exports: dict[str, tuple[str, str]], path: str, mode: str = "errorifexists") -> None:
    """The descriptor as the JSON file trainers open: one entry per export, absent fields left out."""
    entries = {}
    for name, (kind, file) in exports.items():
        formatting, ranking, columns = DESCRIPTORS[kind]
        entries[name] = {"file_name": file}
        if formatting:
            entries[name]["formatting"] = formatting
        if ranking:
            entries[name]["ranking"] = True
        entries[name]["columns"] = columns
    exporter.write_file(path, json.dumps(entries, ensure_ascii=False) + "\n", mode)


def write_document(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A one-row document (report, manifest, snapshot, comparison) or a few records as a single JSON file."""
    df.coalesce(1).write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_document(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def newest_files(spark: SparkSession, path: str, stem: str) -> DataFrame:
    """``(stem, path, modified)``: the most recently modified file of every stem.

    ``stem`` is a regular expression over the whole path; its first group names the stem, and files it does not match are
    left out. Only the file listing is read. Equal times go to the later path.
    """
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "modificationTime")
    )
    named = listing.withColumn("stem", F.regexp_extract("path", stem, 1))
    newest = F.max_by(F.struct("path", "modificationTime"), F.struct("modificationTime", "path"))
    return (
        named.filter(F.col("stem") != "")
        .groupBy("stem")
        .agg(newest.alias("f"))
        .select("stem", F.col("f.path").alias("path"), F.col("f.modificationTime").alias("modified"))
    )
