"""Reads from a raw JSON payload."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.strings import is_blank


def variant_text(member: Column) -> Column:
    """A variant that is a string with something in it, untrimmed; else null."""
    text = F.try_variant_get(member, "$", "string")
    return F.when((F.schema_of_variant(member) == "STRING") & ~is_blank(text), text)


def json_text_field(raw: Column, field: str) -> Column:
    """A field's value when it is a JSON string with something in it, else null.

    get_json_object() turns numbers and booleans into text as well, so the field
    is read as a variant, which keeps its kind.
    """
    return variant_text(F.from_json(raw, f"`{field}` variant").getField(field))


def signal_label(expression: Column, url: Column) -> Column:
    """Which declaration a verdict rests on: expression, else url, else none."""
    return (
        F.when(~is_blank(expression), F.lit("expression"))
        .when(~is_blank(url), F.lit("url"))
        .otherwise(F.lit("none"))
    )
