"""The corpus pipeline: from raw documents to a mix with target weights, one written table per stage.

Each stage is a function of (spark, docs, sf_dir) over everything that its predecessor kept. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decontam, langid, mixing, ngram_join, pii
from tallyloom.llm.queries import table
from tallyloom.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: SQL has no counterpart of the language model and the alignment; tests hold run() against a brute-force version.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language; null texts and texts without a letter go. ``lang`` is left as given."""
    model = langid.train(docs.filter(~langid.held_out()))
    return langid.predict(docs.select(COLUMNS), model).filter(F.col("lang_pred") != langid.UNDETERMINED).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar documents the one with the least id stays, and of repeated ids one row (the least text,
    language and source). Rows without an id are in no class; of equal ones, one stays."""
    classes = ngram_join.similar_classes(docs.select("doc_id", "text"))
    leaders = classes.filter("doc_id = component_id").select("doc_id").distinct()
    named = docs.filter("doc_id IS NOT NULL").select(COLUMNS)
    repeated = named.groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1").select("doc_id")
    once = named.join(leaders, "doc_id", "left_semi")
    rest = once.join(repeated, "doc_id", "left_anti")
    least = once.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("row"))
    return rest.select(COLUMNS).unionByName(least.select("doc_id", "row.*").select(COLUMNS)).unionByName(
        docs.filter("doc_id IS NULL").select(COLUMNS).distinct()
    )


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.without_matches(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; personal data in its text gives way to the kind's name, and ``n_chars`` follows."""
    changed = pii.redact_pii(docs.select(COLUMNS))
    return changed.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mixing.mix_by_source(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_copies),
    ("pii", redact_personal_data),
    ("source_mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
