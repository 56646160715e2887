"""Change capture: from catalog events to one net change per key.

An event either *details* a key (carries its payload) or *deletes* it.  A net
change keeps, per key, the payload of the last details event and the time of
the last delete event.  Both are maxima, so

* map tasks combine before the shuffle, and a key holding a third of all events
  reaches the reducer as one row per map task;
* net changes of consecutive batches combine to that of the joined batch, and a
  batch applied twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELETE_TYPE = "nuget:PackageDelete"  # fixed by the public catalog format

DETAILS_AT = "details_at"
DELETED_AT = "delete_at"


def is_delete(event_type: Column) -> Column:
    """Only the delete type deletes; every other type, known or not, is details."""
    return F.coalesce(event_type == DELETE_TYPE, F.lit(False))


def after_watermark(rows: DataFrame, commit: Column, watermark: Column | None) -> DataFrame:
    """Rows strictly after the watermark; all rows on a first run (None)."""
    return rows if watermark is None else rows.filter(commit > watermark)


def first_pages(pages: DataFrame, commit: str, max_pages: int | None) -> DataFrame:
    """The oldest pages of a run; None takes them all, and then needs no order.

    Pages that tie with the last one are taken too: the next run asks for later
    commits only.
    """
    if max_pages is None:
        return pages
    ranked = pages.withColumn("_rank", F.rank().over(Window.orderBy(commit)))
    return ranked.filter(F.col("_rank") <= max_pages).drop("_rank")


def net_changes(
    events: DataFrame,
    keys: Sequence[str],
    *,
    commit: Column,
    deletes: Column,
    payload: Sequence[str],
    order: Column | None = None,
) -> DataFrame:
    """One row per key: its payload, ``details_at`` and ``delete_at``.

    ``commit`` times events.  ``order`` ranks details where commit times can be
    equal: commit first, then the place in the log (see ``event_order``).  Given
    text payload the payload itself settles what is still equal, so list the
    place first.  A key that was only deleted has a null ``details_at`` and a
    null payload.
    """
    last = events.groupBy(*keys).agg(
        *_last_of(events, payload, commit if order is None else order, ~deletes),
        F.max(F.when(~deletes, commit)).alias(DETAILS_AT),
        F.max(F.when(deletes, commit)).alias(DELETED_AT),
    )
    return last.select(*keys, *_unpack(last, payload), DETAILS_AT, DELETED_AT)


def combine_changes(
    changes: DataFrame, keys: Sequence[str], payload: Sequence[str]
) -> DataFrame:
    """Net changes of several batches as those of one."""
    detailed = F.col(DETAILS_AT).isNotNull()
    last = changes.groupBy(*keys).agg(
        *_last_of(changes, payload, F.col(DETAILS_AT), detailed),
        F.max(DETAILS_AT).alias(DETAILS_AT),
        F.max(DELETED_AT).alias(DELETED_AT),
    )
    return last.select(*keys, *_unpack(last, payload), DETAILS_AT, DELETED_AT)


_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _last_of(rows: DataFrame, payload: Sequence[str], order: Column, where: Column):
    """Aggregates that keep the payload of the highest ``order``.

    Fixed-width columns each get a max_by(): Spark can update those buffers in
    place and aggregates by hash.  Text and nested columns cannot be updated in
    place, the aggregate sorts anyway, and one ranked struct is the least work.
    """
    if all(isinstance(rows.schema[c].dataType, _FIXED_WIDTH) for c in payload):
        return [F.max_by(F.col(c), F.when(where, order)).alias(c) for c in payload]
    ranked = F.struct(order.alias("_order"), *[F.col(c) for c in payload])
    return [F.max(F.when(where, ranked)).alias("_last")]


def _unpack(last: DataFrame, payload: Sequence[str]) -> list[Column]:
    if "_last" not in last.columns:
        return [F.col(c) for c in payload]
    return [F.col(f"_last.{c}").alias(c) for c in payload]


def event_order(commit: Column, place: Column) -> Column:
    """Commit time and a non-negative whole place in the log as one number.

    A struct would order the same, but only a number keeps the aggregate on the
    hash path.  Microseconds take 17 digits and the place 19, of 38.
    """
    micros = F.unix_micros(commit.cast("timestamp")).cast("decimal(19,0)")
    return micros * F.lit(Decimal(10) ** 19).cast("decimal(20,0)") + place.cast("decimal(19,0)")


def standing_delete(details_at: Column, delete_at: Column) -> Column:
    """The delete that still holds: at an equal time the delete wins."""
    return F.when(delete_at >= details_at, delete_at)


def current_state(changes: DataFrame) -> DataFrame:
    """Net changes over the whole log as state rows.

    A key without any details event has no row: there is nothing to mark.
    """
    return changes.filter(F.col(DETAILS_AT).isNotNull()).withColumn(
        "deleted_at", standing_delete(F.col(DETAILS_AT), F.col(DELETED_AT))
    )


def orphan_deletes(changes: DataFrame) -> DataFrame:
    """Keys deleted without ever being detailed; deleting them does nothing."""
    return changes.filter(F.col(DETAILS_AT).isNull())


def keep_last(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Whole rows that are last of their key, as a ranking window.

    For callers that want all columns of a details row and have no payload list.
    Spark limits each map task to its first rank before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[o.desc() for o in order]))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_commit(events: DataFrame, commit: Column, name: str = "watermark") -> DataFrame:
    """Highest commit over all events, deletes included: the next watermark."""
    return events.agg(F.max(commit).alias(name))
