"""Incremental reads past a compound cursor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cursors import past_cursor
from tidemark.functions.times import commit_key


def rows_past(
    rows: DataFrame, at: str, row_id: str, cursor_at: Column | None, cursor_id: Column
) -> DataFrame:
    """Rows strictly after the cursor; no cursor means all rows."""
    if cursor_at is None:
        return rows
    return rows.filter(past_cursor(F.col(at), F.col(row_id), cursor_at, cursor_id))


def keyset_page(
    rows: DataFrame, at: str, row_id: str, cursor_at: Column | None, cursor_id: Column, size: int
) -> DataFrame:
    """The next page in cursor order, for callers that do page."""
    return rows_past(rows, at, row_id, cursor_at, cursor_id).orderBy(at, row_id).limit(size)


def last_position(rows: DataFrame, at: str, row_id: str) -> DataFrame:
    """One row (at, row_id) of the last row in cursor order; nulls when empty."""
    last = F.max(F.struct(F.col(at), F.col(row_id)))
    return rows.agg(last.alias("last")).select(
        F.col(f"last.{at}").alias("at"), F.col(f"last.{row_id}").alias("row_id")
    )


def read_states(pages: DataFrame, read: DataFrame, key: str = "page_url", commit: str = "commit") -> DataFrame:
    """The pages of an index with `is_read`: whether that page was read at that commit or a later one.

    ``read`` has a row for each time that a page was read; a page that has grown
    since counts as unread, and so does one that states no commit time.
    """
    latest = read.groupBy(F.col(key).alias("_key")).agg(F.max(commit).alias("_read"))
    done = F.coalesce(F.col("_read") >= F.col(commit), F.lit(False))
    return pages.join(latest, F.col(key) == F.col("_key"), "left").withColumn("is_read", done).drop("_key", "_read")


def low_watermark(pages: DataFrame, read: DataFrame, key: str = "page_url", commit: str = "commit") -> str | None:
    """The commit time up to which every page of an index has been read; None if the first one is unread.

    Both sides have commit keys (``commit_key``).  Pages of one commit count
    together: an unread one among them holds the watermark before all of them.  Two
    aggregates, with no order over all pages.
    """
    states = read_states(pages, read, key, commit)
    text = f"{commit}.commit_text"
    hole = states.filter(~F.col("is_read")).agg(F.min(commit).alias(commit)).select(text).first()[0]
    below = states if hole is None else states.filter(F.col(commit) < commit_key(F.lit(hole)))
    return below.agg(F.max(commit).alias(commit)).select(text).first()[0]
