"""Generated preference pairs with a known margin, for checking a preference set-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The topics and the three texts of a generated pair.
TOPICS = ["algebra", "cooking", "git", "health"]
INSTRUCTION = "Give a concise, correct answer about %s (question #%d)."
CHOSEN = (
    "Answer: I'll give step-by-step reasoning, then the final result.\n"
    "1) Identify knowns.\n2) Apply the right rule.\n3) Double-check units.\n"
    "Final: [correct, specific solution]."
)
REJECTED = (
    "Answer: I can't help with that.\n"
    "(This response is intentionally evasive and does not address the question.)"
)


def synthetic_pairs(numbers: DataFrame, seed: int = 13) -> DataFrame:
    """One pair per question number ``i``; the topic is drawn from a hash of ``seed xor i``.

    The draw depends on the seed and the number alone, so the set is the same on any partitioning.
    """
    mixed = F.sha2(F.lit(seed).cast("bigint").bitwiseXOR(F.col("i").cast("bigint")).cast("string"), 256)
    draw = F.conv(F.substring(mixed, 1, 8), 16, 10).cast("bigint") % len(TOPICS)
    topic = F.get(F.array(*[F.lit(t) for t in TOPICS]), draw.cast("int"))
    return numbers.select(
        F.col("i").cast("bigint").alias("pos"),
        F.format_string(INSTRUCTION, topic, F.col("i").cast("bigint")).alias("instruction"),
        F.lit("").alias("input"),
        F.lit(CHOSEN).alias("chosen"),
        F.lit(REJECTED).alias("rejected"),
    )


def question_numbers(spark: SparkSession, n: int = 256) -> DataFrame:
    return spark.range(n).select(F.col("id").alias("i"))
