"""Evaluation runs: one metric per task, a summary, and the comparison of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.jsonvalues import format_metric

# The metric keys that are preferred, in this order.
PREFERRED = ["acc,none", "acc_norm,none", "exact_match,strict-match", "acc"]


def pick_metric(metrics: DataFrame, strict: bool = True) -> DataFrame:
    """``(run, task, metric, value, text)``: one metric per run and task.

    Strict: the first preferred key that holds a number, else the first number in document order, else no row.
    Lenient: a preferred key wins when it is present, whatever it holds.
    """
    rank = F.array_position(F.array(*[F.lit(k) for k in PREFERRED]), F.col("metric")).cast("int")
    preferred = rank > 0
    numeric = F.col("number").isNotNull()
    eligible = numeric if strict else (preferred | numeric)
    priority = F.struct(F.when(preferred, rank).otherwise(len(PREFERRED) + 1), F.col("pos"))
    picked = F.min_by(F.struct("metric", "number", "text"), priority)
    return (
        metrics.filter(eligible)
        .groupBy("run", "task")
        .agg(picked.alias("p"))
        .select("run", "task", F.col("p.metric").alias("metric"), F.col("p.number").alias("value"), F.col("p.text").alias("text"))
    )


def summarise_run(metrics: DataFrame) -> DataFrame:
    """``(run, task, metric, value, display)`` by lenient pick, ordered by task."""
    picked = pick_metric(metrics, strict=False)
    return picked.select(
        "run", "task", "metric", "value", format_metric(F.col("value"), F.col("text")).alias("display")
    ).orderBy("run", "task")


def model_labels(metrics: DataFrame) -> DataFrame:
    """``(run, model_args)``: the model description of each run, NULL where the file has none."""
    return metrics.groupBy("run").agg(F.max("model_args").alias("model_args"))


class NoTasksError(RuntimeError):
    """None of the runs holds a task with a metric."""

    exit_code = 2


def require_tasks(picked: DataFrame) -> None:
    if picked.isEmpty():
        raise NoTasksError("no tasks found in the inputs")


def compare_runs(picked: DataFrame, runs: list[str]) -> DataFrame:
    """One row per task: value and metric of each run, in the order given, and the last value minus the first.

    A task missing from a run is NULL there, and in the delta when that run is the first or the last. ``same_metric``
    tells whether the delta compares like with like.
    """
    if len(set(runs)) != len(runs):
        raise ValueError("run names must differ")
    first, last = runs[0], runs[-1]
    wide = picked.groupBy("task").pivot("run", runs).agg(F.first("value").alias("value"), F.first("metric").alias("metric"))
    return wide.withColumn(
        "delta_last_minus_first", F.col(f"`{last}_value`") - F.col(f"`{first}_value`")
    ).withColumn("same_metric", F.col(f"`{last}_metric`") == F.col(f"`{first}_metric`"))


def seed_statistics(picked: DataFrame) -> DataFrame:
    """``(id, task, n_seeds, mean, spread)`` over runs named ``<id>_seed<s>``: the mean and the sample standard deviation,
    which is NULL for one seed. Runs without a seed in their name are left out."""
    pattern = r"^(.+)_seed([0-9]+)$"
    seeds = picked.filter(F.col("run").rlike(pattern)).select(F.regexp_extract("run", pattern, 1).alias("id"), "task", "value")
    return seeds.groupBy("id", "task").agg(
        F.count("value").alias("n_seeds"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("spread")
    )
