"""Data-quality reports of exported sets.

A report reads its input once. Every row is turned into a few tagged cells (one per length metric, one for the
duplicate key), and one map-side-combined ``groupBy`` turns the cells into histograms. A copy group that holds a third
of all rows is one counter per task; percentiles see distinct lengths, never rows.

The cells add up: those of several parts, stored with ``store_cells``, give the report of any union of the parts without
reading a row again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import text as X
from tallyloom.functions.stats import length_stats, ratio

# The field names of the report documents.
DUPLICATE_FRACTION = "approx_duplicate_fraction_sha256_norm_text"
UNIQUE_KEYS = "approx_unique_norm_hashes"
TRIGRAM_MEAN = "output_trigram_repetition_mean"
OUTPUT_LENGTH = "output_char_len"
TOTAL_LENGTH = "total_char_len"
CHOSEN_LENGTH = "chosen_char_len"
REJECTED_LENGTH = "rejected_char_len"
LENGTH_DIFFERENCE = "len_diff_chosen_minus_rejected"
CHOSEN_LONGER = "fraction_chosen_longer_than_rejected"
SHARED_PREFIX = "fraction_shared_prefix_all_chars_of_shorter"
TEXT_LENGTH = "text_char_len"

_KEY_CELL = -1
_CELLS = "cell int, value bigint, key binary, n bigint, measure_sum double"


def _histograms(df: DataFrame, lengths: list[Column], key: Column | None, measure: Column | None, part: Column | None = None) -> DataFrame:
    """``(cell, value, key, n, measure_sum)``: counts per distinct length of every metric and per duplicate key; with
    ``part``, of each of its values apart.

    ``cell`` is the metric's index. ``measure`` (a per-row number to be averaged) rides along with the key cell.
    """
    parts = [] if part is None else [part.cast("string").alias("part")]
    measure = F.lit(None).cast("double") if measure is None else measure.cast("double")
    none = {"value": F.lit(None).cast("bigint"), "key": F.lit(None).cast("binary"), "measure": F.lit(None).cast("double")}

    def cell(number: int, **fields: Column) -> Column:
        filled = {**none, **fields}
        return F.struct(F.lit(number).alias("cell"), *[c.alias(name) for name, c in filled.items()])

    cells = [cell(i, value=length.cast("bigint")) for i, length in enumerate(lengths)]
    if key is not None:
        cells.append(cell(_KEY_CELL, key=key, measure=measure))
    return (
        df.select(*parts, F.inline(F.array(*cells)))
        .groupBy(*["part" for _ in parts], "cell", "value", "key")
        .agg(F.count("*").alias("n"), F.sum("measure").alias("measure_sum"))
    )


def _of(cell: int, col: str) -> Column:
    return F.when(F.col("cell") == cell, F.col(col))


def _stats(cell: int) -> Column:
    return length_stats(_of(cell, "value"), F.col("n"))


def _rows(cell: int = _KEY_CELL) -> Column:
    return F.coalesce(F.sum(_of(cell, "n")), F.lit(0))


def _unique() -> Column:
    return F.count_if(F.col("cell") == _KEY_CELL)


def _duplicate_fraction() -> Column:
    return F.when(_rows() == 0, F.lit(0.0)).otherwise(F.lit(1.0) - ratio(_unique(), _rows()))


def sft_cells(rows: DataFrame, part: Column | None = None) -> DataFrame:
    """Histograms of ``instruction, input, output`` rows, of each part apart."""
    ins, inp, out = (X.text_or_empty(F.col(c)) for c in ("instruction", "input", "output"))
    return _histograms(
        rows,
        lengths=[F.length(out), F.length(ins) + F.length(inp) + F.length(out)],
        key=X.norm_key_bytes(F.concat_ws("\n", ins, inp, out)),
        measure=X.trigram_repetition(out),
        part=part,
    )


def sft_findings() -> list[Column]:
    """What a report of ``sft_cells`` holds."""
    return [
        _rows().alias("rows"),
        _stats(0).alias(OUTPUT_LENGTH),
        _stats(1).alias(TOTAL_LENGTH),
        _duplicate_fraction().alias(DUPLICATE_FRACTION),
        _unique().alias(UNIQUE_KEYS),
        ratio(F.sum(_of(_KEY_CELL, "measure_sum")), _rows()).alias(TRIGRAM_MEAN),
    ]


def sft_report(rows: DataFrame) -> DataFrame:
    """One-row report of ``instruction, input, output`` rows."""
    return sft_cells(rows).agg(*sft_findings())


def pair_diagnostics(rows: DataFrame) -> DataFrame:
    """Adds ``len_diff``, ``chosen_longer`` and ``shared_prefix`` to each pair."""
    chosen, rejected = X.text_or_empty(F.col("chosen")), X.text_or_empty(F.col("rejected"))
    return (
        rows.withColumn("len_diff", (F.length(chosen) - F.length(rejected)).cast("bigint"))
        .withColumn("chosen_longer", F.length(chosen) > F.length(rejected))
        .withColumn("shared_prefix", X.shares_whole_prefix(chosen, rejected))
    )


def dpo_cells(rows: DataFrame, part: Column | None = None) -> DataFrame:
    """Histograms of ``instruction, chosen, rejected`` pairs (``input`` is not part of the duplicate key), of each part apart."""
    pairs = pair_diagnostics(rows)
    ins, chosen, rejected = (X.text_or_empty(F.col(c)) for c in ("instruction", "chosen", "rejected"))
    return _histograms(
        pairs,
        lengths=[F.length(chosen), F.length(rejected), F.col("len_diff")],
        key=X.norm_key_bytes(F.concat_ws("\n", ins, chosen, rejected)),
        measure=F.col("shared_prefix").cast("int"),
        part=part,
    )


def dpo_findings() -> list[Column]:
    """What a report of ``dpo_cells`` holds."""
    longer = F.sum(F.when((F.col("cell") == 2) & (F.col("value") > 0), F.col("n")).otherwise(0))
    return [
        _rows().alias("rows"),
        _stats(0).alias(CHOSEN_LENGTH),
        _stats(1).alias(REJECTED_LENGTH),
        _stats(2).alias(LENGTH_DIFFERENCE),
        ratio(longer, _rows()).alias(CHOSEN_LONGER),
        ratio(F.sum(_of(_KEY_CELL, "measure_sum")), _rows()).alias(SHARED_PREFIX),
        _duplicate_fraction().alias(DUPLICATE_FRACTION),
        _unique().alias(UNIQUE_KEYS),
    ]


def dpo_report(rows: DataFrame) -> DataFrame:
    """One-row report of ``instruction, chosen, rejected`` pairs."""
    return dpo_cells(rows).agg(*dpo_findings())


def text_cells(rows: DataFrame, text: str = "text", part: Column | None = None) -> DataFrame:
    """Histograms of a text column, of each part apart; a NULL text counts as empty."""
    own = X.text_or_empty(F.col(text))
    return _histograms(rows, [F.length(own)], X.norm_key_bytes(own), None, part)


def text_findings() -> list[Column]:
    """What a report of ``text_cells`` holds."""
    return [_rows().alias("rows"), _stats(0).alias(TEXT_LENGTH), _duplicate_fraction().alias(DUPLICATE_FRACTION), _unique().alias(UNIQUE_KEYS)]


def store_cells(cells: DataFrame, path: str) -> None:
    """Write the cells of some parts to a folder with one subfolder per part. A part that is there already is replaced, the
    others stay, so a new delivery costs a scan of itself alone. The NULL part is a part like any other."""
    folder = F.coalesce(F.concat(F.lit("part "), "part"), F.lit("none"))
    kept = cells.select("part", *[f.split()[0] for f in _CELLS.split(", ")], folder.alias("folder"))
    kept.repartition("folder", F.xxhash64("cell", "value", "key") % 8).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("folder").parquet(path)


def stored_cells(spark: SparkSession, path: str, parts: list[str | None] | None = None) -> DataFrame:
    """The cells of all parts, or of the named ones; only their subfolders are read."""
    cells = spark.read.schema(f"part string, {_CELLS}, folder string").parquet(path)
    if parts is not None:
        cells = cells.filter(F.col("folder").isin(["none" if p is None else f"part {p}" for p in parts]))
    return cells.drop("folder")


def union_reports(cells: DataFrame, unions: Column, findings: list[Column]) -> DataFrame:
    """A report for each union of parts, in ``of``. ``unions`` is an expression over ``part``: the names of the unions it is in.

    A key that several parts share is one key of their union, so the cells are summed per union first. Counts, percentiles and
    keys are those of the rows; a mean of fractional numbers can differ in the last bits, as any sum in another order.
    """
    named = cells.withColumn("of", F.explode(unions))
    summed = named.groupBy("of", "cell", "value", "key").agg(F.sum("n").alias("n"), F.sum("measure_sum").alias("measure_sum"))
    return summed.groupBy("of").agg(*findings)


def length_report(df: DataFrame, length: Column) -> DataFrame:
    """``(rows, p50, p90, p95, p99, mean)`` of one length expression."""
    cells = _histograms(df, [length], None, None)
    return cells.agg(_rows(0).alias("rows"), _stats(0).alias("stats")).select("rows", "stats.*")


def duplicate_stats(df: DataFrame, key: Column) -> DataFrame:
    """``(rows, unique_keys, duplicate_fraction)`` of a key expression, exactly."""
    counts = df.select(key.alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    rows, unique = F.coalesce(F.sum("n"), F.lit(0)), F.count("*")
    return counts.agg(
        rows.alias("rows"),
        unique.alias("unique_keys"),
        F.when(rows == 0, F.lit(0.0)).otherwise(F.lit(1.0) - ratio(unique, rows)).alias("duplicate_fraction"),
    )


def findings_long(report: DataFrame, dataset: str | Column) -> DataFrame:
    """A report as ``(dataset, metric, stat, value)`` lines; plain numbers carry the stat ``value``. ``of``, the name of a
    union, is no metric."""
    lines = []
    for field in report.drop("of").schema.fields:
        if hasattr(field.dataType, "names"):
            lines += [(field.name, stat, F.col(f"`{field.name}`.`{stat}`")) for stat in field.dataType.names]
        else:
            lines.append((field.name, "value", F.col(f"`{field.name}`")))
    return report.select(
        F.lit(dataset).alias("dataset"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(metric).alias("metric"),
                        F.lit(stat).alias("stat"),
                        value.cast("double").alias("value"),
                    )
                    for metric, stat, value in lines
                ]
            )
        ),
    )
