"""Training-set exports: instruction rows, preference pairs, raw text.

Each export is one lazy plan, project then filter, with no shuffle. The same ordered rule list drives the filter and the
drop accounting, so the two cannot disagree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import text as X
from tallyloom.functions.messages import last_assistant
from tallyloom.operators.selection import first_n

NO_UPPER_BOUND = 10**9
KEPT = "kept"

Rules = list[tuple[str, Column]]


def _type_of(df: DataFrame, name: str):
    return df.schema[name].dataType


# --- instruction rows -------------------------------------------------------------------------------------------


def project_sft(raw: DataFrame) -> DataFrame:
    return raw.select("pos", *[X.text_or_empty(F.col(c)).alias(c) for c in ("instruction", "input", "output")])


def sft_length() -> Column:
    return X.joined_length(F.col("instruction"), F.col("input"), F.col("output"))


def sft_rules(min_chars: int = 1, max_chars: int = NO_UPPER_BOUND) -> Rules:
    return [
        ("blank_output", X.is_blank(F.col("output"))),
        ("length", ~sft_length().between(min_chars, max_chars)),
    ]


def sft_examples(
    raw: DataFrame, min_chars: int = 1, max_chars: int = NO_UPPER_BOUND, cap: int | None = None
) -> DataFrame:
    """``(pos, instruction, input, output)`` rows that pass; ``output`` keeps its padding."""
    return first_n(_keep(project_sft(raw), sft_rules(min_chars, max_chars)), cap)


# --- preference pairs -------------------------------------------------------------------------------------------


def project_dpo(prefs: DataFrame) -> DataFrame:
    """Flat pairs: stripped prompt, empty ``input``, and the last assistant text of either side."""
    return prefs.select(
        "pos",
        X.strip(X.text_or_empty(F.col("prompt"))).alias("instruction"),
        F.lit("").alias("input"),
        last_assistant(F.col("chosen"), _type_of(prefs, "chosen")).alias("chosen"),
        last_assistant(F.col("rejected"), _type_of(prefs, "rejected")).alias("rejected"),
    )


def dpo_length() -> Column:
    return X.joined_length(F.col("instruction"), F.col("input"), F.col("chosen"), F.col("rejected"))


def dpo_rules(min_chars: int = 1, max_chars: int = NO_UPPER_BOUND) -> Rules:
    return [
        ("empty_prompt", F.col("instruction") == ""),
        ("length", ~dpo_length().between(min_chars, max_chars)),
        ("empty_side", (F.col("chosen") == "") | (F.col("rejected") == "")),
        ("identical_sides", F.col("chosen") == F.col("rejected")),
    ]


def dpo_pairs(
    prefs: DataFrame, min_chars: int = 1, max_chars: int = NO_UPPER_BOUND, cap: int | None = None
) -> DataFrame:
    """``(pos, instruction, input, chosen, rejected)`` pairs that pass. Whitespace-only sides pass; equal sides do not."""
    return first_n(_keep(project_dpo(prefs), dpo_rules(min_chars, max_chars)), cap)


# --- raw text ---------------------------------------------------------------------------------------------------


def project_cpt(raw: DataFrame) -> DataFrame:
    return raw.select("pos", X.strip(X.text_or_empty(F.col("text"))).alias("text"))


def cpt_rules(min_chars: int = 80) -> Rules:
    return [("too_short", F.length("text") < min_chars)]


def cpt_corpus(
    raw: DataFrame, min_chars: int = 80, max_chars: int | None = None, cap: int | None = None
) -> DataFrame:
    """``(pos, text)``: stripped, long enough, then cut to ``max_chars`` code points if that is asked for."""
    kept = _keep(project_cpt(raw), cpt_rules(min_chars))
    if max_chars is not None:
        kept = kept.withColumn("text", X.truncate(F.col("text"), max_chars))
    return first_n(kept, cap)


# --- shared -----------------------------------------------------------------------------------------------------


def _keep(rows: DataFrame, rules: Rules) -> DataFrame:
    for _, rejected in rules:
        rows = rows.filter(~rejected)
    return rows


def drop_reasons(rows: DataFrame, rules: Rules) -> DataFrame:
    """``(reason, rows)``: each projected row under the first rule that rejects it, or under ``kept``."""
    chain = None
    for name, rejected in rules:
        chain = F.when(rejected, name) if chain is None else chain.when(rejected, name)
    return rows.select(chain.otherwise(KEPT).alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


def row_accounting(role: str, rows: DataFrame, rules: Rules, cap: int | None = None) -> DataFrame:
    """``(role, raw_rows, exported_rows)`` in one pass over the source; a cap bounds the exported side."""
    reasons = drop_reasons(rows, rules)
    kept = F.coalesce(F.sum(F.when(F.col("reason") == KEPT, F.col("rows"))), F.lit(0))
    return reasons.agg(
        F.lit(role).alias("role"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("raw_rows"),
        (kept if cap is None else F.least(kept, F.lit(cap))).cast("bigint").alias("exported_rows"),
    )


class EmptyExportError(RuntimeError):
    """An export came out without rows."""

    exit_code = 2


def require_rows(rows: int, what: str, allow_empty: bool = False) -> None:
    if rows == 0 and not allow_empty:
        raise EmptyExportError(f"the {what} export has no rows: loosen the filters or allow empty exports")
