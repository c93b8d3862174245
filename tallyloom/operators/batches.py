"""Deduplication against what earlier batches kept: a bucketed key table that is never shuffled again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.curate import deduplicate
from tallyloom.session import materialize

_COLUMNS = "kept_key BINARY, batch STRING"


def create_key_table(spark: SparkSession, table: str, path: str, buckets: int) -> None:
    """An empty key table ``table`` of the catalogue with its files below ``path``.

    ``buckets`` is fixed for the table's life: choose it so that the keys of one bucket, and a batch's rows for it, fit
    a task. A table that exists is an error.
    """
    empty = spark.createDataFrame([], _COLUMNS)
    empty.write.mode("errorifexists").bucketBy(buckets, "kept_key").sortBy("kept_key").option("path", path).saveAsTable(table)


def _stored(key: Column) -> Column:
    """The key as stored: NULL, a key like any other, becomes the empty value, so that the join is a plain equality."""
    return F.coalesce(F.concat(F.lit(b"k"), key.cast("binary")), F.lit(b""))


def _buckets(spark: SparkSession, table: str) -> int:
    described = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Num Buckets'").first()
    if described is None:
        raise ValueError(f"{table} is no key table")
    return int(described["data_type"])


def new_rows(batch: DataFrame, key: Column, table: str, name: str, pos: str = "pos") -> DataFrame:
    """The rows of a batch whose key no other batch has kept, of each key the one at the lowest position.

    Only the batch is shuffled; the key table is joined bucket by bucket where it lies. Keys are compared as binary values.
    """
    spark = batch.sparkSession
    own = deduplicate(batch, key, pos).withColumn("_key", _stored(key))
    earlier = spark.table(table).filter(F.col("batch") != name).select(F.col("kept_key").alias("_key"))
    return own.join(earlier, "_key", "left_anti").drop("_key")


def add_batch(batch: DataFrame, key: Column, table: str, name: str, pos: str = "pos") -> DataFrame:
    """``new_rows`` of a batch, written once to the shared folder, and their keys added to the table.

    Batches that come in the order of their positions keep the rows that one run over all of them would keep; a row once
    kept stays kept, whatever comes later. A batch has a name: running it again, after a failure at any point, gives the
    same rows, because it is not compared with its own keys. Two batches must not be added to one table at the same time.
    """
    spark = batch.sparkSession
    rows = materialize(new_rows(batch, key, table, name, pos), "kept-rows")
    fresh = rows.select(_stored(key).alias("kept_key"), F.lit(name).alias("batch"))
    buckets = _buckets(spark, table)
    # One file per bucket and batch: the keys are dealt by the table's own hash before writing.
    fresh.repartition(buckets, "kept_key").write.mode("append").bucketBy(buckets, "kept_key").sortBy("kept_key").saveAsTable(table)
    return rows
