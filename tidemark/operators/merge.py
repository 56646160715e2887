"""Keyed merges into a stored table, as plain DataFrames.  Parquet has no MERGE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.events import DELETED_AT, DETAILS_AT, current_state, standing_delete


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows replace target rows of the same key, nulls included.

    Target rows without a batch row stay, also when the batch is a full list
    that no longer has them.  The batch must hold each key once.
    """
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def _surviving_delete(old_delete: Column, old_at: Column, new_at: Column) -> Column:
    """The stored delete, unless details newer than the row and the delete lift it."""
    lifted = (new_at > old_at) & (old_delete < new_at)
    return F.when(~F.coalesce(lifted, F.lit(False)), old_delete)


def merge_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Apply net changes to state rows.

    ==================  ===========  ================================
    batch has           target row   result
    ==================  ===========  ================================
    details             any          payload replaced, delete cleared
    details and delete  any          payload replaced, deleted when the
                                     delete is not older
    delete only         present      payload kept, newest delete time kept
    delete only         absent       nothing
    ==================  ===========  ================================

    State rows carry ``details_at``, the commit they were last set from.  An older
    batch arriving late neither replaces a newer row nor deletes it, so replays
    and late arrivals are harmless.

    Each side is read once and shuffled by key at most once; a side that is
    already grouped by key is not shuffled again.
    """
    state = target.select(
        *keys, F.struct(*[c for c in target.columns if c not in keys]).alias("_old")
    )
    batch = changes.select(
        *keys, F.struct(*[c for c in changes.columns if c not in keys]).alias("_new")
    )
    joined = state.join(batch, list(keys), "full_outer")
    old_at, new_at = F.col(f"_old.{DETAILS_AT}"), F.col(f"_new.{DETAILS_AT}")
    replaced = new_at.isNotNull() & (F.col("_old").isNull() | (new_at >= old_at))
    deleted_at = F.greatest(
        _surviving_delete(F.col("_old.deleted_at"), old_at, new_at),
        standing_delete(F.greatest(old_at, new_at), F.col(f"_new.{DELETED_AT}")),
    )

    def value(column: str) -> Column:
        if column == "deleted_at":
            return deleted_at.alias(column)
        fresh, kept = F.col(f"_new.{column}"), F.col(f"_old.{column}")
        return F.when(F.col("_replaced"), fresh).otherwise(kept).alias(column)

    return (
        joined.withColumn("_replaced", F.coalesce(replaced, F.lit(False)))
        .filter(F.col("_replaced") | F.col("_old").isNotNull())
        .select(*[F.col(c) if c in keys else value(c) for c in target.columns])
    )


def merge_few_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``merge_changes`` for a batch far smaller than the target.

    Only the batch's keys and times meet the target, so where they fit Spark's
    broadcast threshold the target is not shuffled at all.  Beyond it the result
    is the same, but ``merge_changes`` is cheaper: this form reads both twice.
    """
    times = changes.select(
        *keys, F.col(DETAILS_AT).alias("_details"), F.col(DELETED_AT).alias("_delete")
    )
    late_delete = standing_delete(F.col(DETAILS_AT), F.col("_delete"))
    kept = (
        target.join(times, list(keys), "left")
        .filter(F.col("_details").isNull() | (F.col("_details") < F.col(DETAILS_AT)))
        .withColumn("deleted_at", F.greatest("deleted_at", late_delete))
    )
    # Times of the rows the batch touches, so at most as many as the batch has.
    touched = target.select(
        *keys, F.col(DETAILS_AT).alias("_old_at"), F.col("deleted_at").alias("_old_delete")
    ).join(times.select(*keys), list(keys), "left_semi")
    old_delete = _surviving_delete(F.col("_old_delete"), F.col("_old_at"), F.col(DETAILS_AT))
    fresh = (
        current_state(changes)
        .join(touched, list(keys), "left")
        .filter(F.col("_old_at").isNull() | (F.col(DETAILS_AT) >= F.col("_old_at")))
        .withColumn("deleted_at", F.greatest("deleted_at", old_delete))
    )
    return kept.select(*target.columns).unionByName(fresh.select(*target.columns))


def mark_deleted(
    target: DataFrame, deletes: DataFrame, keys: Sequence[str], at: str = DELETED_AT
) -> DataFrame:
    """Soft delete existing rows: set when unset or older, never insert.

    Re-publishing is not looked at; this is the backfill's own rule.
    """
    last = deletes.groupBy(*keys).agg(F.max(at).alias("_delete"))
    return (
        target.join(last, list(keys), "left")
        .withColumn("deleted_at", F.greatest(F.col("deleted_at"), F.col("_delete")))
        .select(*target.columns)
    )

