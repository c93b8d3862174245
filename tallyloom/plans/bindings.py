"""Operator inputs derived from the given tables, always from whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.readers import spread

TURN_BITS = 20


# The schemas of the given tables, so that no job is spent on reading them off a footer.
SCHEMAS = {
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Document texts, one task per core at least, for the queries that compute on every character."""
    return spread(table(spark, folder, "documents").select("doc_id", "text"))


def sft_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Each assistant turn with the user turn right before it.

    The join key is (conversation, turn), unique on both sides, so one huge conversation is spread like any other rows.
    """
    turns = table(spark, folder, "conversations")
    asked = turns.filter(F.col("role") == "user").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("instruction")
    )
    answered = turns.filter(F.col("role") == "assistant").select("conv_id", "turn", F.col("text").alias("output"))
    return answered.join(asked, ["conv_id", "turn"]).select(
        (F.shiftleft("conv_id", TURN_BITS) + F.col("turn")).alias("pos"),
        "instruction",
        F.lit(None).cast("string").alias("input"),
        "output",
    )


def prefs_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Per conversation: the first user turn as prompt, and two message lists ending in the last and the first
    assistant turn. The aggregates keep one turn each, so no conversation is gathered whole."""
    turns = table(spark, folder, "conversations")
    picked = turns.groupBy("conv_id").agg(
        F.expr("min_by(text, turn) FILTER (WHERE role = 'user')").alias("prompt"),
        F.expr("max_by(text, turn) FILTER (WHERE role = 'assistant')").alias("last"),
        F.expr("min_by(text, turn) FILTER (WHERE role = 'assistant')").alias("first"),
    )

    def messages(answer: str):
        said = [("user", F.col("prompt")), ("assistant", F.col(answer))]
        both = F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in said])
        return F.filter(both, lambda m: m["content"].isNotNull())

    return picked.select(
        F.col("conv_id").alias("pos"),
        "prompt",
        messages("last").alias("chosen"),
        messages("first").alias("rejected"),
    )


def cpt_raw(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select(F.col("doc_id").alias("pos"), "text")


def chunked_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as a message whose content is a JSON list with one text chunk per line."""
    chunks = F.transform(
        F.split("text", "\n"), lambda line: F.struct(F.lit("text").alias("type"), line.alias("text"))
    )
    message = F.struct(F.lit("assistant").alias("role"), chunks.alias("content"))
    return documents(spark, folder).select(
        "doc_id", F.parse_json(F.to_json(F.array(message))).alias("messages")
    )


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("source").alias("title"), "text"
    )


def vector_passages(spark: SparkSession, folder: str) -> DataFrame:
    """A document per vector: the one of its number, or one without title and text where the tables have none."""
    return doc_vectors(spark, folder).select("doc_id").join(corpus(spark, folder), "doc_id", "left")


def topic(label: str = "label"):
    return F.concat(F.lit("t"), F.col(label).cast("string"))


def doc_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(F.col("vec_id").cast("string").alias("doc_id"), "embedding")


def query_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """One query per label: the mean vector of its documents (combined per task, then one row per label)."""
    cells = table(spark, folder, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.sort_array(F.collect_list(F.struct("i", "x")))  # one entry per dimension
    return means.groupBy("label").agg(F.transform(ordered, lambda c: c["x"]).alias("embedding")).select(
        topic().alias("qid"), "embedding"
    )


def topic_queries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(topic().alias("qid")).distinct().withColumn("text", F.col("qid"))


def topic_qrels(spark: SparkSession, folder: str) -> DataFrame:
    """Judgements: every document judged for its own label, with grades 0, 1 and 2."""
    return table(spark, folder, "embeddings").select(
        topic().alias("qid"),
        F.col("vec_id").cast("string").alias("doc_id"),
        (F.col("vec_id") % 3).cast("int").alias("rel"),
    )


def rerank_scores(ranked: DataFrame) -> DataFrame:
    """A deterministic stand-in for a reranking model: a function of query and document id."""
    mixed = (F.col("doc_id").cast("bigint") * 7919 + F.substring("qid", 2, 20).cast("bigint") * 104729) % 1000
    return ranked.select("qid", "doc_id", (mixed / 100.0 - 5.0).alias("score"))


def label_queries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("qid"), "text")


def label_qrels(spark: SparkSession, folder: str) -> DataFrame:
    doc = F.col("doc_id").cast("string")
    return table(spark, folder, "labels").select(doc.alias("qid"), doc.alias("doc_id"), F.col("quality").alias("rel"))


EVAL_RUNS = ["click", "error", "purchase", "signup", "view"]


def eval_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One evaluation result file per event type, with one task per hour of the day (24 at most).

    The metric objects differ by hour so that every picking rule is met: NaN tokens, numbers as text, numbers in document
    order under unsorted keys, preferred keys, tasks without any number, and an entry that is not an object.
    """
    per_hour = (
        table(spark, folder, "events")
        .groupBy(F.col("event_type").alias("run"), F.hour("ts").alias("hour"))
        .agg(
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
            F.count("value").alias("n"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
    )
    mean, low, high = (c.cast("string") for c in (F.col("total") / F.col("n"), F.col("low"), F.col("high")))
    hour, n = F.col("hour"), F.col("n").cast("string")

    def text(template: str, *values):
        return F.format_string(template, *values)

    entry = (
        F.when(hour < 6, text('{"alias":"NaN, early","acc_norm,none":%s,"acc,none":NaN}', mean))
        .when(hour < 12, text('{"zeta":%s,"beta":%s,"flag":true}', high, n))
        .when(hour < 16, text('{"acc,none":"0.5","acc":%s}', mean))
        .when(hour < 18, text('{"acc":%s,"exact_match,strict-match":%s}', mean, low))
        .when(hour < 23, text('{"n":%s,"acc,none":%s}', n, low))
        .otherwise(F.lit('{"alias":"no number here"}'))
    )
    lines = per_hour.select("run", text('"h%02d":%s', hour, entry).alias("line"))
    body = F.array_join(F.sort_array(F.collect_list("line")), ",")
    return lines.groupBy("run").agg(body.alias("body")).select(
        "run",
        F.concat(
            F.lit('{"results":{"note":5,'),
            F.col("body"),
            F.lit('},"config":{"model_args_string":"","model_args":"type='),
            F.col("run"),
            F.lit('"}}'),
        ).alias("document"),
    )
