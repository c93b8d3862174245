"""JSON scalars: telling numbers from look-alikes, and surviving NaN tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def quote_nonfinite(raw: Column) -> Column:
    """Rewrite bare ``NaN`` / ``Infinity`` tokens to the strings ``"nan"`` / ``"inf"`` / ``"-inf"``.

    JSON parsers disagree on these tokens. As strings they are not numbers, and print as the token should. Quoted text
    is matched whole and put back, so a string that mentions NaN is left alone. The mark is a control character that
    valid JSON cannot contain unescaped.
    """
    marked = F.regexp_replace(raw, f"({_STRING})|(-?)(NaN|Infinity)", "$1\x01$2$3\x01")
    restored = F.replace(marked, F.lit("\x01\x01"), F.lit(""))
    for token, text in (("NaN", '"nan"'), ("-Infinity", '"-inf"'), ("Infinity", '"inf"'), ("-NaN", '"nan"')):
        restored = F.replace(restored, F.lit(f"\x01{token}\x01"), F.lit(text))
    return restored


def is_number(value: Column) -> Column:
    """True for a numeric variant; text that looks like a number, booleans and null are not numbers."""
    return F.coalesce(F.schema_of_variant(value).rlike(r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.lit(False))


def number(value: Column) -> Column:
    return F.when(is_number(value), F.try_variant_get(value, "$", "double"))


def display_text(value: Column) -> Column:
    """A JSON value as plain text: True / False / None for literals, compact JSON for lists and objects."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(kind == "BOOLEAN", F.initcap(text))
        .when(kind == "VOID", F.lit("None"))
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), F.to_json(value))
        .otherwise(text)
    )


def format_metric(number_col: Column, text_col: Column) -> Column:
    """Whole numbers without decimals, other numbers with four, anything else verbatim.

    ``format_number`` rounds the number as it is in binary, ties to even; ``format_string`` would round its decimal text.
    """
    whole = (number_col == F.floor(number_col)) & (F.abs(number_col) < 1e18)
    return (
        F.when(whole, number_col.cast("bigint").cast("string"))
        .when(number_col.isNotNull(), F.call_function("format_number", number_col, F.lit("0.0000")))
        .otherwise(text_col)
    )
