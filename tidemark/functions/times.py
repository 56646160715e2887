"""Instants and commit order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_instant(text: Column) -> Column:
    """ISO text (``Z``, offset, no zone or date only) as a timestamp, else null.

    Text without a zone is UTC, whatever the session's zone is.  Text without a
    date is no instant: a time alone would mean today, another one in each run.
    """
    whole = F.when(text.rlike(r"^\d{4}-\d\d-\d\d$"), F.concat(text, F.lit("T00:00:00Z")))
    zoned = F.when(text.rlike(r"(?:Z|[+-]\d\d:?\d\d)$"), text).otherwise(F.concat(text, F.lit("Z")))
    dated = F.when(text.rlike(r"^\d{4}-\d\d-\d\d"), F.coalesce(whole, zoned))
    return dated.try_cast("timestamp")


def commit_key(text: Column) -> Column:
    """Sort key of a commit time: the instant, then its text.

    Text alone sorts ``...00Z`` after ``...00.5Z``; the instant alone loses the
    seventh fractional digit.  Together they order texts with an equal number of
    digits beyond the sixth; of others, the one with more digits comes first.
    """
    return F.struct(parse_instant(text).alias("commit_at"), text.alias("commit_text"))
