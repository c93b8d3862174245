"""Chat formatting by perspective: each participant in turn is the assistant, the others are named users.

A row of the result is a block of a conversation seen by one participant: the rendered turns, and the spans of them to
learn from (that participant's own words). Blocks hold ``TURNS`` turns, so a conversation of any length is never
gathered in one task; its blocks, in order, concatenate to the whole dialogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import materialize

TURNS = 64
SYSTEM = "system"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _safe(text: Column) -> Column:
    """Text in which no template marker can be read."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("<\\|"))


def numbered(turns: DataFrame) -> DataFrame:
    """Adds ``place``, the rank of a turn in its conversation (from 0), without bringing a conversation together.

    Turns are laid out in ranges of (conversation, turn, speaker, text); ranks inside a range start from how many turns
    of the conversation earlier ranges hold. Null turn numbers come first, ties go by speaker and text.
    """
    keys = ["conv_id", "turn", "speaker", "text"]
    ranged = turns.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys], F.rand(7))
    ranged = materialize(ranged.withColumn("range", F.spark_partition_id()), "turns")
    local = Window.partitionBy("conv_id", "range").orderBy(*[F.col(k).asc_nulls_first() for k in keys[1:]])
    counts = ranged.groupBy("conv_id", "range").agg(F.count("*").alias("held"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("conv_id", "range", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    ranked = ranged.withColumn("rank", F.row_number().over(local))
    return ranked.join(counts, ["conv_id", "range"]).withColumn("place", F.col("before") + F.col("rank") - 1).drop("range", "rank", "before")


def perspectives(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, speaker, block, n_turns, rendered, mask, n_learn) for every participant of every conversation.

    ``mask`` lists ``start:end`` code point spans of ``rendered``, comma-joined, that hold the participant's own turns with their
    closing marker; ``n_learn`` is their total length. ``system`` turns keep their role and are nobody's perspective.
    A null speaker is the participant ``unknown``; a null text is an empty turn; markers inside names and texts are
    escaped. Rows without a conversation id belong to none and are left out. A conversation of system turns only has no
    participant and no row, an empty table gives no rows. Repeated rows are repeated turns.
    """
    turns = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(speaker_col), F.lit("unknown")).alias("speaker"),
        _safe(F.col(text_col)).alias("text"),
    ).filter("conv_id IS NOT NULL")
    placed = numbered(turns).withColumn("block", F.floor(F.col("place") / TURNS))
    views = turns.filter(F.col("speaker") != SYSTEM).select("conv_id", F.col("speaker").alias("viewer")).distinct()
    seen = placed.join(views, "conv_id")
    own = F.col("speaker") == F.col("viewer")
    name = F.regexp_replace(_safe(F.col("speaker")), r"[\r\n]", " ")
    head = (
        F.when(F.col("speaker") == SYSTEM, F.lit(f"{OPEN}system\n"))
        .when(own, F.lit(f"{OPEN}assistant\n"))
        .otherwise(F.concat(F.lit(f"{OPEN}user name="), name, F.lit("\n")))
    )
    body = F.concat(F.col("text"), F.lit(CLOSE))
    part = F.struct("place", F.concat(head, body, F.lit("\n")).alias("shown"), F.length(head).alias("lead"), F.length(body).alias("learn"), own.alias("own"))
    blocks = seen.groupBy("conv_id", "viewer", "block").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    spans = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"), F.lit(0).alias("learn")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["shown"])).alias("at"),
            F.when(
                p["own"],
                F.concat(acc["spans"], F.array(F.concat_ws(":", (acc["at"] + p["lead"]).cast("string"), (acc["at"] + p["lead"] + p["learn"]).cast("string")))),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
            (acc["learn"] + F.when(p["own"], p["learn"]).otherwise(0)).alias("learn"),
        ),
    )
    return blocks.withColumn("mask", spans).select(
        "conv_id",
        F.col("viewer").alias("speaker"),
        F.col("block").cast("long").alias("block"),
        F.size("parts").cast("long").alias("n_turns"),
        F.array_join(F.transform("parts", lambda p: p["shown"]), "").alias("rendered"),
        F.array_join("mask.spans", ",").alias("mask"),
        F.col("mask.learn").cast("long").alias("n_learn"),
    )
