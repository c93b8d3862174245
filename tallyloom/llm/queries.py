"""The registered queries of this package: each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import chat, chatrepair, decontam, embedding_dedup, htmltext, langid, lexsearch, mixing, ngram_join, pii, tokencount, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_classes(table(spark, folder, "documents"))


def of_kind(kind: str):
    return lambda span: span["kind"] == kind


@query
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_pii(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"] != "iban")
    counts = [F.size(F.filter("pii", of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    confidence = F.array_join(F.transform("pii", lambda s: s["confidence"].cast("string")), ",")
    return found.select(
        "doc_id", *counts, F.sha2(pii.span_text(base), 256).alias("base_sha256"), pii.span_text(F.col("pii")).alias("spans"), confidence.alias("confidence")
    )


@query
def op3_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


@query
def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(table(spark, folder, "pages"))


@query
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.filter(~langid.held_out()))
    predicted = langid.predict(docs.drop("lang"), model)
    return predicted.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "n_langs")


@query
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return tokencount.token_counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.benchmark_matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumn("score", F.round("score", 6))


@query
def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return htmltext.extract_text(table(spark, folder, "pages"), htmltext.train(spark))


@query
def op9_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_by_source(table(spark, folder, "documents"))


@query
def op10_chat_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    return chat.perspectives(table(spark, folder, "conversations"))


@query
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexsearch.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(*toxicity.sample(docs, table(spark, folder, "labels")))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns, found = chatrepair.repair(chatrepair.damage(table(spark, folder, "conversations")))
    digests = chatrepair.text_digests(turns).withColumnRenamed("conv_id", "own")
    joined = found.join(digests, F.col("conv_id").eqNullSafe(F.col("own")), "left").drop("own")
    return joined.select("*", F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")).drop("sha256")
