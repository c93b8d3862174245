"""Evaluation result files: nested JSON to a long table of metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import jsonvalues as J


def parse_run_arguments(items: list[str]) -> dict[str, str]:
    """``NAME=PATH`` arguments in order; split at the first ``=``; empty and repeated names are errors."""
    runs: dict[str, str] = {}
    for item in items:
        name, sign, path = item.partition("=")
        name, path = name.strip(), path.strip()
        if not sign or not name or not path:
            raise ValueError(f"expected NAME=PATH, got {item!r}")
        if name in runs:
            raise ValueError(f"run {name!r} is given twice")
        runs[name] = path
    return runs


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as a file listing names it: absolute, with its file system."""
    plain = spark._jvm.org.apache.hadoop.fs.Path(path)
    return plain.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(plain).toString()


def read_eval_documents(spark: SparkSession, runs: dict[str, str]) -> DataFrame:
    """``(run, document)``, one row per run, from one scan of all their files, however many runs there are.

    A missing file is an error, and so is a run whose path is no file (a folder, a pattern). Two runs may name one file.
    """
    places = {name: _qualified(spark, path) for name, path in runs.items()}
    files = spark.read.format("binaryFile").load(sorted(set(places.values())))
    named = spark.createDataFrame(list(places.items()), "run string, path string")
    found = named.join(files.select("path", F.col("content").cast("string").alias("document")), "path", "left")
    missing = F.raise_error(F.concat(F.lit("not a file: "), F.col("path"))).cast("string")
    return found.select("run", F.coalesce("document", missing).alias("document"))


def eval_metrics(documents: DataFrame) -> DataFrame:
    """``(run, model_args, task, pos, metric, number, text)``: every metric of every task, in document order.

    ``number`` is NULL for anything that is not a finite number; ``text`` is the plain form of the value. Result entries
    that are not objects are skipped; a document that is not JSON is an error. Keys are exploded, not addressed by path, because they contain commas.
    """
    document = F.from_json(
        J.quote_nonfinite(F.col("document")), "results MAP<STRING, STRING>, config STRING", {"mode": "FAILFAST"}
    )
    # The text keeps the order of a task's metrics; the variant tells an object from a string that looks like one.
    typed = F.from_json(J.quote_nonfinite(F.col("document")), "results MAP<STRING, VARIANT>")["results"]
    config = F.col("d.config")

    def field(name: str):
        return F.nullif(F.get_json_object(config, f"$.{name}"), F.lit(""))

    tasks = documents.select("run", "document", document.alias("d")).select(
        "run",
        F.coalesce(field("model_args_string"), field("model_args")).alias("model_args"),
        F.explode("d.results").alias("task", "entry"),
        typed.alias("typed"),
    ).withColumn("kind", F.col("typed")[F.col("task")])
    objects = tasks.filter(F.schema_of_variant(F.col("kind")).startswith("OBJECT"))
    value = F.col("value")
    return objects.select(
        "run",
        "model_args",
        "task",
        F.posexplode(F.from_json("entry", "MAP<STRING, VARIANT>")).alias("pos", "metric", "value"),
    ).select(
        "run",
        "model_args",
        "task",
        "pos",
        "metric",
        J.number(value).alias("number"),
        F.coalesce(J.display_text(value), F.lit("None")).alias("text"),
    )


def read_eval_runs(spark: SparkSession, runs: dict[str, str]) -> DataFrame:
    """All metrics of several named result files."""
    return eval_metrics(read_eval_documents(spark, runs))
