"""Readers with fixed schemas.

Row order matters to a capped export, and Spark rows have none, so every source carries a BIGINT ``pos``. Take it from
the data where there is one (``order="field"``). JSON lines without one are numbered by file and byte offset (``order="lines"``),
Parquet rows by file and row number (``read_in_file_order``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources import lines

# The source and export schemas.
SFT_SOURCE = "pos BIGINT, instruction STRING, input STRING, output STRING"
PREFERENCE_SOURCE = "pos BIGINT, prompt STRING, chosen VARIANT, rejected VARIANT"
TEXT_SOURCE = "pos BIGINT, text STRING"
SFT_EXPORT = "instruction STRING, input STRING, output STRING"
DPO_EXPORT = "instruction STRING, input STRING, chosen STRING, rejected STRING"
CPT_EXPORT = "text STRING"
CORPUS = "doc_id STRING, title STRING, text STRING"
QUERIES = "qid STRING, text STRING"
QRELS = "qid STRING, doc_id STRING, rel INT"
VECTORS = "id STRING, embedding ARRAY<FLOAT>"
RERANK_SCORES = "qid STRING, doc_id STRING, score DOUBLE"

_ROWS_PER_FILE_BITS = 38
_FILES_PER_SCAN = 20_000
_SPREAD = 32


def _read(spark: SparkSession, path: str | list[str], schema: str, fmt: str, order: str = "field") -> DataFrame:
    if order == "lines":
        if fmt != "json":
            raise ValueError("only JSON lines are numbered by line")
        return lines.read_json_lines(spark, path, schema)
    reader = spark.read.schema(schema)
    if fmt == "json":
        reader = reader.option("mode", "FAILFAST")
    return reader.format(fmt).load(path)


def read_sft(spark: SparkSession, path: str | list[str], fmt: str = "json", order: str = "field") -> DataFrame:
    """Instruction examples."""
    return _read(spark, path, SFT_SOURCE, fmt, order)


def read_preferences(spark: SparkSession, path: str | list[str], fmt: str = "json", order: str = "field") -> DataFrame:
    """Preference rows. In JSON the message lists are read as VARIANT, so content may be text or a list of chunks."""
    if fmt == "json":
        return _read(spark, path, PREFERENCE_SOURCE, fmt, order)
    return spark.read.format(fmt).load(path).select("pos", "prompt", "chosen", "rejected")


def read_texts(spark: SparkSession, path: str | list[str], fmt: str = "json", config: str | None = None, order: str = "field") -> DataFrame:
    """Raw text documents; a source with named configurations keeps each in a folder of its name."""
    if config is not None:
        path = f"{path}/{config}" if isinstance(path, str) else [f"{p}/{config}" for p in path]
    return _read(spark, path, TEXT_SOURCE, fmt, order)


def read_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSONL export; blank lines are skipped and a malformed line is an error."""
    return _read(spark, path, schema, "json")


def read_retrieval(
    spark: SparkSession, corpus: str, queries: str, qrels: str, fmt: str = "parquet"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Corpus, queries and judgements as three long tables."""
    return _read(spark, corpus, CORPUS, fmt), _read(spark, queries, QUERIES, fmt), _read(spark, qrels, QRELS, fmt)


def spread(scan: DataFrame) -> DataFrame:
    """Split a scan with fewer partitions than the session has cores (few files, or files that cannot be split).

    For row-local work that costs far more than moving the rows once. A scan that is wide enough is left alone, so on
    large inputs this adds nothing; a small one is not cut finer than a few megabytes per task.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    partitions = scan.rdd.getNumPartitions()
    return scan.repartition(min(cores, _SPREAD * partitions)) if 0 < partitions < cores else scan


def read_in_file_order(spark: SparkSession, path: str | list[str], schema=None, name: str = "pos") -> DataFrame:
    """A Parquet source with a position: file by file in path order, row by row within a file.

    The position comes from the file's own row numbers, so it is the same whatever the splits and retries. File names
    are numbered in groups of bounded size, one scan per group, so the numbering is always a small broadcast join.
    """
    paths = [path] if isinstance(path, str) else path
    files = sorted(spark.read.parquet(*paths).inputFiles())
    position = F.shiftleft(F.col("_ordinal"), _ROWS_PER_FILE_BITS) + F.col("_row")
    scans = []
    for start in range(0, len(files), _FILES_PER_SCAN):
        group = files[start : start + _FILES_PER_SCAN]
        reader = spark.read if schema is None else spark.read.schema(schema)
        scan = reader.parquet(*group).select("*", F.input_file_name().alias("_file"), F.col("_metadata.row_index").alias("_row"))
        numbers = spark.createDataFrame(list(enumerate(group, start)), "_ordinal BIGINT, _file STRING")
        scans.append(scan.join(numbers, "_file").withColumn(name, position).drop("_file", "_row", "_ordinal"))
    return reduce(DataFrame.unionByName, scans)
