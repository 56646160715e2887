"""Whitespace helpers.  Spark's own trim() strips spaces only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every Unicode space, and the four ASCII separators a text strip also removes.
SPACE = r"[\s\x1c-\x1f]"


def strip_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def is_blank(text: Column) -> Column:
    """True for null, empty and whitespace-only text; never null."""
    return ~F.coalesce(text.rlike(rf"(?U)[^\s\x1c-\x1f]"), F.lit(False))
