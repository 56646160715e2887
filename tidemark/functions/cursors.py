"""Compound cursors: ``<instant>|<id>``, the last row a job has seen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.times import parse_instant

INITIAL = "0"


def encode_cursor(at: Column, row_id: Column) -> Column:
    stamp = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return F.concat(stamp, F.lit("|"), row_id.cast("string"))


def decode_cursor(cursor: Column) -> Column:
    """Struct of ``at`` and ``row_id``.

    Split at the first bar, so an id may hold bars itself.  Text without a bar
    is an older cursor: the instant alone, before every id.
    """
    parts = F.split(cursor, r"\|", 2)
    return F.struct(
        F.when(cursor != INITIAL, parse_instant(F.get(parts, F.lit(0)))).alias("at"),
        F.when(cursor == INITIAL, F.lit(""))
        .otherwise(F.coalesce(F.get(parts, F.lit(1)), F.lit("")))
        .alias("row_id"),
    )


def past_cursor(at: Column, row_id: Column, cursor_at: Column, cursor_id: Column) -> Column:
    """(at, row_id) strictly after the cursor.

    Written out, since only this form reaches the Parquet scan as a filter; the
    row-value comparison does not.
    """
    return (at > cursor_at) | ((at == cursor_at) & (row_id > cursor_id))
