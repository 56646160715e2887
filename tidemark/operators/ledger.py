"""Run ledger and checkpoints as append-only rows, and the queries over them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.measures import duration_ms, per_second

# Hours after which a source is stale and a running run is dead.
STALE_HOURS = 12
ZOMBIE_HOURS = 3
ZOMBIE_MESSAGE = "no completion within the time allowed"


def _age_at_least(since: Column, now: Column, hours: Column) -> Column:
    return F.unix_micros(now.cast("timestamp")) - F.unix_micros(since.cast("timestamp")) >= (
        hours.cast("bigint") * F.lit(3_600_000_000)
    )


def current_runs(run_events: DataFrame) -> DataFrame:
    """The ledger: each run's last row.

    A finalising row outranks every heartbeat, however late the heartbeat came;
    among finalising rows the last counts.
    """
    rest = [c for c in run_events.columns if c not in ("id", "event_at", "status")]
    ranked = F.struct(
        (F.col("status") != "running").alias("settled"), "event_at", "status", *rest
    )
    last = run_events.groupBy("id").agg(F.max(ranked).alias("last"))
    return last.select(
        "id", *[F.col(f"last.{c}").alias(c) for c in run_events.columns if c != "id"]
    ).withColumn("duration_ms", duration_ms(F.col("started_at"), F.col("completed_at")))


def current_checkpoints(entries: DataFrame) -> DataFrame:
    """Each source's last checkpoint row; earlier values are replaced, not summed."""
    rest = [c for c in entries.columns if c not in ("source", "last_sync_at")]
    last = entries.groupBy("source").agg(F.max(F.struct("last_sync_at", *rest)).alias("last"))
    return last.select(
        "source", *[F.col(f"last.{c}").alias(c) for c in entries.columns if c != "source"]
    )


def last_success(runs: DataFrame) -> DataFrame:
    """Newest completion per source; partial and failed runs do not count."""
    return (
        runs.filter(F.col("status") == "completed")
        .groupBy("source")
        .agg(F.max("completed_at").alias("last_completed_at"))
    )


def staleness(runs: DataFrame, now: Column, hours: int = STALE_HOURS) -> DataFrame:
    """Per source of the ledger: last success, and whether it is too old or missing."""
    successes = F.max(F.when(F.col("status") == "completed", F.col("completed_at")))
    return (
        runs.groupBy("source")
        .agg(successes.alias("last_completed_at"))
        .withColumn(
            "is_stale",
            F.coalesce(_age_at_least(F.col("last_completed_at"), now, F.lit(hours)), F.lit(True)),
        )
    )


def freshness(runs: DataFrame, max_age_hours: Mapping[str, int], now: Column) -> DataFrame:
    """Check rows: the age of each named source's last success against its limit."""
    spark = runs.sparkSession
    limits = spark.createDataFrame(list(max_age_hours.items()), "source string, max_hours int")
    age_ms = duration_ms(F.col("last_completed_at"), now)
    hours = age_ms / F.lit(3_600_000.0)
    return limits.join(last_success(runs), "source", "left").select(
        F.concat(F.lit("freshness_"), "source").alias("check_name"),
        F.coalesce(age_ms <= F.col("max_hours").cast("bigint") * 3_600_000, F.lit(False)).alias(
            "passed"
        ),
        F.lit("WARN").alias("severity"),
        F.lit(False).alias("blocking"),
        F.round(hours, 2).alias("measured"),
        F.col("max_hours").cast("double").alias("threshold"),
    )


def sweep_zombies(
    runs: DataFrame,
    now: Column,
    hours: int = ZOMBIE_HOURS,
    since: str = "started_at",
    source: str | None = None,
) -> DataFrame:
    """Ledger rows with runs that are running for too long turned into failed ones.

    ``since="last_heartbeat_at"`` spares long runs that still report progress.
    """
    dead = (F.col("status") == "running") & ~_younger(F.col(since), now, hours)
    if source is not None:
        dead = dead & (F.col("source") == source)
    dead = F.coalesce(dead, F.lit(False))
    return runs.select(
        *[
            {
                "status": F.when(dead, F.lit("failed")).otherwise(F.col("status")),
                "completed_at": F.when(dead, now).otherwise(F.col("completed_at")),
                "error_message": F.when(dead, F.lit(ZOMBIE_MESSAGE)).otherwise(
                    F.col("error_message")
                ),
            }
            .get(c, F.col(c))
            .alias(c)
            for c in runs.columns
        ],
        dead.alias("swept"),
    )


def _younger(since: Column, now: Column, hours: int) -> Column:
    cutoff = F.unix_micros(now.cast("timestamp")) - F.lit(hours * 3_600_000_000)
    return F.unix_micros(since.cast("timestamp")) >= cutoff


def unsettled_runs(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("status").isin("running", "failed"))


def quiet_runs(runs: DataFrame, before: Column) -> DataFrame:
    """Running runs whose last heartbeat is older than ``before``."""
    return runs.filter((F.col("status") == "running") & (F.col("last_heartbeat_at") < before))


def throughput(runs: DataFrame) -> DataFrame:
    """Rows and pages per second of each finished run."""
    return runs.select(
        "id",
        "source",
        "duration_ms",
        per_second(F.col("rows_inserted"), F.col("duration_ms")).alias("rows_per_sec"),
        per_second(F.col("pages_processed"), F.col("duration_ms")).alias("pages_per_sec"),
    )
