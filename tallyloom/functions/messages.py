"""Chat messages: turning message content into text and finding the last assistant turn.

A message list may be typed (``ARRAY<STRUCT<role, content>>``) or a VARIANT, which is how JSON of mixed shape is read
(content as text in one row, as a list of chunks in the next). The branch is taken on the column type, or on the variant
type of the value, never on the first character of a string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ASSISTANT = "assistant"


def _variant_type(col: Column) -> Column:
    return F.schema_of_variant(col)


def _variant_text(col: Column) -> Column:
    """A variant scalar as text; objects and lists as compact JSON; null as NULL."""
    kind = _variant_type(col)
    return (
        F.when(kind == "STRING", F.try_variant_get(col, "$", "string"))
        .when(kind == "BOOLEAN", F.initcap(F.try_variant_get(col, "$", "string")))
        .when(kind != "VOID", F.to_json(col))
    )


def _falsy_as_empty(col: Column) -> Column:
    """Text of a chunk's ``text`` field: null, false, zero and empty containers count as nothing."""
    text = _variant_text(col)
    empty = text.isin("False", "0", "[]", "{}") & (_variant_type(col) != "STRING")
    return F.when(text.isNull() | empty, F.lit("")).otherwise(text)


def _variant_chunk(chunk: Column) -> Column:
    field = F.try_variant_get(chunk, "$.text", "variant")
    has_text = _variant_type(chunk).startswith("OBJECT") & field.isNotNull()
    return F.when(has_text, _falsy_as_empty(field)).otherwise(F.coalesce(_variant_text(chunk), F.lit("None")))


def stringify_content(col: Column, data_type: T.DataType) -> Column:
    """Message content as text: null gives ``''``, text stays as it is, a list of chunks is concatenated."""
    if isinstance(data_type, T.VariantType):
        chunks = F.try_variant_get(col, "$", "array<variant>")
        return (
            F.when(_variant_type(col).startswith("ARRAY"), F.array_join(F.transform(chunks, _variant_chunk), ""))
            .otherwise(F.coalesce(_variant_text(col), F.lit("")))
        )
    if isinstance(data_type, T.ArrayType):
        item = data_type.elementType
        if isinstance(item, T.VariantType):
            parts = F.transform(col, _variant_chunk)
        elif isinstance(item, T.StructType) and "text" in item.names:
            parts = F.transform(col, lambda c: F.coalesce(c["text"].cast("string"), F.lit("")))
        elif isinstance(item, (T.StructType, T.ArrayType, T.MapType)):
            parts = F.transform(col, F.to_json)
        else:
            parts = F.transform(col, lambda c: F.coalesce(c.cast("string"), F.lit("None")))
        return F.coalesce(F.array_join(parts, ""), F.lit(""))
    if isinstance(data_type, (T.StructType, T.MapType)):
        return F.coalesce(F.to_json(col), F.lit(""))
    return F.coalesce(col.cast("string"), F.lit(""))


def last_assistant(col: Column, data_type: T.DataType) -> Column:
    """Content of the last assistant message; ``''`` when there is none, or when the value is not a list.

    An empty last assistant message stays empty: there is no fallback to an earlier one.
    """
    if isinstance(data_type, T.VariantType):
        messages = F.try_variant_get(col, "$", "array<variant>")
        spoken = F.filter(
            messages,
            lambda m: (F.try_variant_get(m, "$.role", "string") == ASSISTANT),
        )
        content = F.try_variant_get(F.try_element_at(spoken, F.lit(-1)), "$.content", "variant")
        return F.coalesce(stringify_content(content, T.VariantType()), F.lit(""))
    if isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.StructType):
        spoken = F.filter(col, lambda m: m["role"] == ASSISTANT)
        content = F.try_element_at(spoken, F.lit(-1))["content"]
        return F.coalesce(stringify_content(content, data_type.elementType["content"].dataType), F.lit(""))
    return F.lit("")
