"""Data-quality checks.

Every check returns rows of one shape: ``check_name, passed, severity, blocking,
measured, threshold``.  Rows that share a table are measured in one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.measures import share_pct

# Thresholds of the checks.
OSI_FLOOR = 100
UNKNOWN_WARN_PCT = 60.0
MAX_AGE_HOURS = {"catalog": 12, "license_list": 240, "license_verdict": 24}


def _result(
    name: str, passed: Column, severity: str, blocking: bool, measured: Column, threshold: float
) -> list[Column]:
    return [
        F.lit(name).alias("check_name"),
        passed.alias("passed"),
        F.lit(severity).alias("severity"),
        F.lit(blocking).alias("blocking"),
        measured.cast("double").alias("measured"),
        F.lit(float(threshold)).alias("threshold"),
    ]


def nonempty(table: DataFrame, name: str) -> DataFrame:
    counted = table.agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*_result(name, F.col("n") > 0, "ERROR", True, F.col("n"), 0))


def osi_floor(licenses: DataFrame, name: str = "osi_floor", floor: int = OSI_FLOOR) -> DataFrame:
    counted = licenses.agg(F.count_if("is_osi_approved").alias("n"))
    return counted.select(*_result(name, F.col("n") >= floor, "ERROR", True, F.col("n"), floor))


def unknown_counts(verdicts: DataFrame) -> DataFrame:
    """Unknown and total verdicts with the unrounded share of the unknown."""
    return verdicts.agg(
        F.count_if(F.col("classification") == "unknown").alias("unknown_count"),
        F.count(F.lit(1)).alias("total_count"),
    ).withColumn("pct", share_pct(F.col("unknown_count"), F.col("total_count")))


def unknown_ratio(
    verdicts: DataFrame, name: str = "unknown_ratio", limit: float = UNKNOWN_WARN_PCT
) -> DataFrame:
    share = F.col("pct")
    return unknown_counts(verdicts).select(
        *_result(name, share <= limit, "WARN", False, F.round(share, 2), limit)
    )


def repeated_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def key_uniqueness(table: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    counted = repeated_keys(table, keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*_result(name, F.col("n") == 0, "ERROR", False, F.col("n"), 0))


def count_check(rows: DataFrame, name: str) -> DataFrame:
    """Warns when there is any row that should not be."""
    counted = rows.agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*_result(name, F.col("n") == 0, "WARN", False, F.col("n"), 0))


def violations(table: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows breaking each rule, all rules in one pass.

    As in a CHECK constraint a rule that is null holds; state a required column
    as ``isNotNull()``.
    """
    counted = table.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    long = counted.unpivot([], list(rules), "check_name", "n")
    return long.select(
        "check_name",
        (F.col("n") == 0).alias("passed"),
        F.lit("ERROR").alias("severity"),
        F.lit(False).alias("blocking"),
        F.col("n").cast("double").alias("measured"),
        F.lit(0.0).alias("threshold"),
    )


# --- floors measured while a table is written -----------------------------------


class BlockingCheckFailed(RuntimeError):
    """A table that was written did not pass its checks; it must not be published."""


@dataclass(frozen=True)
class Floor:
    """What a table must reach to be published; ``measure`` is an aggregate of its rows."""

    name: str
    measure: Callable[[], Column]
    least: float


def row_floor(name: str, least: int = 1) -> Floor:
    return Floor(name, lambda: F.count(F.lit(1)), least)


def approved_floor(name: str = "osi_floor", least: int = OSI_FLOOR) -> Floor:
    return Floor(name, lambda: F.count_if("is_osi_approved"), least)


def watched(rows: DataFrame, floors: Sequence[Floor]) -> tuple[DataFrame, Observation | None]:
    """The rows, measured by whatever action reads them; no pass of their own."""
    if not floors:
        return rows, None
    seen = Observation()
    return rows.observe(seen, *[f.measure().alias(f.name) for f in floors]), seen


def require_floors(floors: Sequence[Floor], seen: Mapping[str, Any]) -> None:
    low = [f"{f.name} {seen[f.name]} < {f.least}" for f in floors if not (seen[f.name] or 0) >= f.least]
    if low:
        raise BlockingCheckFailed(f"blocking checks failed: {', '.join(sorted(low))}")


def report(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def blocking_failures(checks: DataFrame) -> DataFrame:
    return checks.filter(F.col("blocking") & ~F.col("passed"))


def require(checks: DataFrame) -> None:
    """Stop the job when a blocking check failed; at most one row per check is read."""
    failed = [row.check_name for row in blocking_failures(checks).collect()]
    if failed:
        raise BlockingCheckFailed(f"blocking checks failed: {', '.join(sorted(failed))}")


def require_rows(table: DataFrame, what: str) -> None:
    if table.isEmpty():
        raise RuntimeError(f"{what} is empty; load it first")
