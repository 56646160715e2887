"""Run measures: durations, rates and shares.  None raises on a zero divisor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def duration_ms(start: Column, end: Column) -> Column:
    """Whole milliseconds between two timestamps, rounded; null while running."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.round(micros / F.lit(1000)).cast("bigint")


def per_second(amount: Column, elapsed_ms: Column) -> Column:
    """Rate over at least a millisecond, two digits; null while running."""
    seconds = F.greatest(elapsed_ms / F.lit(1000.0), F.lit(0.001))
    return F.when(elapsed_ms.isNotNull(), F.round(amount / seconds, 2))


def progress_pct(done: Column, total: Column) -> Column:
    """Share done, two digits, at most 100; nothing to do counts as done."""
    return F.when(total == 0, F.lit(100.0)).otherwise(
        F.least(F.round(done * F.lit(100.0).cast("double") / total, 2), F.lit(100.0))
    )


def share_pct(part: Column, total: Column) -> Column:
    """Unrounded share; an empty table has a share of 0."""
    return F.when(total == 0, F.lit(0.0)).otherwise(part * F.lit(100.0) / total)
