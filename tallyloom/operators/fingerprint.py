"""Export fingerprints, the manifest and the metrics snapshot."""

from __future__ import annotations

import platform

import pyspark
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def row_hash(*cols: Column) -> Column:
    """60 bits of the SHA-256 over the length-prefixed columns; NULL and ``''`` differ."""
    parts = []
    for col in cols:
        text = col.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-1:")))
    return F.conv(F.substring(F.sha2(F.concat(*parts), 256), 1, 15), 16, 10).cast("bigint")


def content_digest(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(rows, digest)``: identity of the content, independent of row order, partitioning and file layout.

    A sum of row hashes combines on the map side, and as a multiset hash it also notices repeated rows.
    """
    hashed = row_hash(*[F.col(c) for c in cols]).cast("decimal(28,0)")
    return df.select(hashed.alias("h")).agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum("h").cast("string"), F.lit("0")).alias("digest"),
    )


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """``(path, bytes, rows, sha256)`` per written part file; one task handles one file at a time.

    A part file is read as one value, so the writer bounds part sizes (``max_rows_per_file``).
    """
    content = F.col("content")
    without_newlines = F.replace(content.cast("string"), F.lit("\n"), F.lit(""))
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(path)
        .select(
            "path",
            F.col("length").alias("bytes"),
            (F.col("length") - F.octet_length(without_newlines)).alias("rows"),
            F.sha2(content, 256).alias("sha256"),
        )
    )


def environment(git_commit: str | None = None) -> Column:
    return F.struct(
        F.lit(platform.python_version()).alias("python"),
        F.lit(pyspark.__version__).alias("spark"),
        F.lit(git_commit).cast("string").alias("git_commit"),
    )


def manifest(
    spark: SparkSession,
    sources: DataFrame,
    exports: DataFrame,
    *,
    recipe_id: str,
    min_chars: int,
    max_chars: int,
    policy_version: str = "v1",
    git_commit: str | None = None,
    created_at: Column | None = None,
    recipe_path: str | None = None,
) -> DataFrame:
    """The one-row export manifest.

    ``sources`` has one row per role (location, revisions, raw and exported rows), ``exports`` one row per written set
    (path, digest, bytes, rows, and its files with their SHA-256). Both have a handful of rows by construction: they are lists inside the document.
    """

    def as_list(df: DataFrame) -> Column:
        return df.agg(F.sort_array(F.collect_list(F.struct(*df.columns)))).scalar()

    return spark.range(1).select(
        F.lit(1).alias("schema_version"),
        (F.current_timestamp() if created_at is None else created_at).cast("string").alias("created_at"),
        F.lit(recipe_id).alias("recipe_id"),
        F.lit(recipe_path).cast("string").alias("recipe_path"),
        F.lit(policy_version).alias("filter_policy_version"),
        F.struct(F.lit(min_chars).cast("bigint").alias("min_chars"), F.lit(max_chars).cast("bigint").alias("max_chars")).alias(
            "filters"
        ),
        environment(git_commit).alias("environment"),
        as_list(sources).alias("sources"),
        as_list(exports).alias("exports"),
    )


def as_json(document: DataFrame) -> str:
    """A one-row document as JSON text, missing values as nulls."""
    return document.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).first()[0]


def quality_document(
    sft: DataFrame, dpo: DataFrame, paths: dict[str, str] | None = None, created_at: Column | None = None
) -> DataFrame:
    """The one-row QA document over both reports."""
    paths = paths or {}
    return sft.select(
        F.lit(1).alias("schema_version"),
        (F.current_timestamp() if created_at is None else created_at).cast("string").alias("created_at"),
        F.struct(F.lit(paths.get("sft")).alias("sft"), F.lit(paths.get("dpo")).alias("dpo")).alias("paths"),
        F.struct(*sft.columns).alias("sft"),
        dpo.select(F.struct(*dpo.columns)).scalar().alias("dpo"),
    )


def snapshot(quality: DataFrame, manifest_doc: DataFrame | None = None) -> DataFrame:
    """Aggregates-only snapshot: the QA document with the manifest's identity fields, which are NULL without one."""
    def identity(col: str) -> Column:
        return F.lit(None).cast("string") if manifest_doc is None else manifest_doc.select(col).scalar()

    return quality.select(
        F.lit(1).alias("schema_version"),
        "created_at",
        F.struct(
            identity("recipe_id").alias("recipe_id"),
            identity("environment.git_commit").alias("git_commit_at_export"),
            F.col("paths.sft").alias("sft_jsonl"),
            F.col("paths.dpo").alias("dpo_jsonl"),
            F.col("sft.rows").alias("sft_rows"),
            F.col("dpo.rows").alias("dpo_rows"),
        ).alias("export"),
        "sft",
        "dpo",
    )
