"""Curating a corpus: deduplication by a normalised key, balancing of groups, comparison of two arms."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tallyloom.operators.selection import seeded_rank
from tallyloom.session import materialize

_BIN_BITS = 12


def _required(rows: DataFrame, name: str) -> Column:
    """The column, with an error in place of its NULLs: such a row would silently leave the result."""
    return F.coalesce(F.col(name), F.raise_error(F.lit(f"a row has no {name}")).cast(rows.schema[name].dataType))


def deduplicate(rows: DataFrame, key: Column, pos: str = "pos") -> DataFrame:
    """Of all rows with one key (NULL is a key like any other), the one at the lowest position.

    Positions alone are counted per key, inside the tasks first, so a copy group of any size is one row per task and
    position; the rows are then picked by key and position. A row without a position, and two rows of one key that share
    the lowest position, are errors.
    """
    places = rows.select(_required(rows, pos).alias("_pos"), key.alias("_key")).groupBy("_key", "_pos").agg(F.count("*").alias("_rows"))
    least = places.groupBy("_key").agg(F.min(F.struct("_pos", "_rows")).alias("_least"))
    shared = F.raise_error(F.concat(F.lit(f"rows of one key share {pos} "), F.col("_least._pos").cast("string"))).cast(rows.schema[pos].dataType)
    least = least.select(F.col("_key").alias("_of"), F.when(F.col("_least._rows") > 1, shared).otherwise(F.col("_least._pos")).alias("_at"))
    keyed = rows.withColumn("_key", key)
    return keyed.join(least, (F.col(pos) == F.col("_at")) & F.col("_key").eqNullSafe(F.col("_of")), "left_semi").drop("_key")


def first_of_groups(
    rows: DataFrame, groups: list[str], key: str, with_quota: Callable[[DataFrame], DataFrame], seed: int = 0
) -> DataFrame:
    """The first rows of each group in a seeded hash order of ``key``, as many as ``with_quota`` puts into ``_quota``.

    Rows are counted per group and hash bin; bins below the quota are taken whole, and only the bin in which it falls
    is put in order, so a group is never gathered. ``with_quota`` gets the table of bins, one line per group and bin. A
    NULL group is a group of its own; a row without a key is an error.
    """
    ranked = rows.withColumn("_rank", seeded_rank(_required(rows, key), seed))
    binned = ranked.withColumn("_bin", F.shiftright("_rank", 60 - _BIN_BITS))
    running = W.Window.partitionBy(*groups).orderBy("_bin")  # at most 4,096 lines a group
    bins = with_quota(binned.groupBy(*groups, "_bin").agg(F.count("*").alias("_rows")))
    left = F.col("_quota") - F.sum("_rows").over(running) + F.col("_rows")
    bins = bins.withColumn("_left", left).filter("_left > 0").drop("_quota")
    renamed = {g: f"_group{i}" for i, g in enumerate(groups)}
    bins = materialize(bins.withColumnsRenamed(renamed), "bins").withColumnRenamed("_bin", "_of")
    same = F.col("_bin") == F.col("_of")
    for group, name in renamed.items():
        same = same & F.col(group).eqNullSafe(F.col(name))
    joined = binned.join(bins, same)
    whole = joined.filter("_rows <= _left")
    order = W.Window.partitionBy(*groups, "_bin").orderBy("_rank", key)
    cut = joined.filter("_rows > _left").withColumn("_place", F.row_number().over(order)).filter("_place <= _left")
    return whole.select(rows.columns).unionByName(cut.select(rows.columns))


def balance(rows: DataFrame, group: str, key: str, quota: int, seed: int = 0) -> DataFrame:
    """At most ``quota`` rows of each group, the first in a seeded hash order of ``key``. A NULL group is a group of its own;
    a row without a key is an error."""
    return first_of_groups(rows, [group], key, lambda bins: bins.withColumn("_quota", F.lit(quota)), seed)


def compare_arms(findings: dict[str, DataFrame], by: tuple[str, ...] = ("metric", "stat")) -> DataFrame:
    """Long findings of two arms side by side, with the second minus the first as ``delta``."""
    first, second = findings
    long = reduce(DataFrame.unionByName, [f.select(*by, "value", F.lit(arm).alias("arm")) for arm, f in findings.items()])
    wide = long.groupBy(*by).pivot("arm", [first, second]).agg(F.first("value"))
    return wide.withColumn("delta", F.col(second) - F.col(first))
