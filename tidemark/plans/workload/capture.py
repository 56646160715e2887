"""Change capture over the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import events as ev
from tidemark.operators import merge, versions
from tidemark.plans.workload.registry import query, table
from tidemark.plans.workload.standins import LOG, LOG_KEYS, LOG_PAYLOAD, change_log, log_order

CUT = "2024-01-15 00:00:00"

_STATE = f"""{LOG},
last_details AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY package_id, version
                                 ORDER BY commit_at DESC, place DESC) AS rk
    FROM log WHERE NOT is_delete) AS ranked
  WHERE rk = 1),
last_delete AS (
  SELECT package_id, version, max(commit_at) AS delete_at
  FROM log WHERE is_delete GROUP BY package_id, version),
state AS (
  SELECT d.package_id, d.version, d.place, d.value, d.commit_at AS details_at,
         CASE WHEN x.delete_at >= d.commit_at THEN x.delete_at END AS deleted_at
  FROM last_details AS d LEFT JOIN last_delete AS x
    ON d.package_id = x.package_id AND d.version = x.version)"""

_STATE_COLUMNS = ["package_id", "version", "place", "value", "details_at", "deleted_at"]
_STATE_ROWS = f"WITH {_STATE} SELECT package_id, version, place, value, details_at, deleted_at FROM state"


def _changes(log: DataFrame) -> DataFrame:
    return ev.net_changes(
        log,
        LOG_KEYS,
        commit=F.col("commit_at"),
        deletes=F.col("is_delete"),
        payload=LOG_PAYLOAD,
        order=log_order(),
    )


def _state(log: DataFrame) -> DataFrame:
    return ev.current_state(_changes(log)).select(*_STATE_COLUMNS)


def _cut(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    at = F.lit(CUT).cast("timestamp_ntz")
    return log.filter(F.col("commit_at") < at), log.filter(F.col("commit_at") >= at)


@query(_STATE_ROWS)
def cdc_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log as state rows."""
    return _state(change_log(spark, sf_dir))


@query(f"""WITH {LOG}
SELECT package_id, version AS latest_version, value, commit_at AS details_at FROM (
  SELECT *, row_number() OVER (PARTITION BY package_id ORDER BY commit_at DESC, place DESC) AS rk
  FROM log WHERE NOT is_delete) AS ranked
WHERE rk = 1""")
def cdc_package_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last details per package; the version it names need not be the highest."""
    last = ev.net_changes(
        change_log(spark, sf_dir),
        ["package_id"],
        commit=F.col("commit_at"),
        deletes=F.col("is_delete"),
        payload=["place", "version", "value"],
        order=log_order(),
    )
    return ev.current_state(last).select(
        "package_id", F.col("version").alias("latest_version"), "value", "details_at"
    )


@query(_STATE_ROWS)
def cdc_merge_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First half of the log as state, second half merged into it."""
    first, second = _cut(change_log(spark, sf_dir))
    return merge.merge_changes(_state(first), _changes(second), LOG_KEYS)


@query(_STATE_ROWS)
def cdc_merge_few_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the form for batches far smaller than the target."""
    first, second = _cut(change_log(spark, sf_dir))
    return merge.merge_few_changes(_state(first), _changes(second), LOG_KEYS)


@query(_STATE_ROWS)
def cdc_replayed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch delivered twice, and an older one delivered late, change nothing."""
    first, second = _cut(change_log(spark, sf_dir))
    state = merge.merge_changes(_state(first), _changes(second), LOG_KEYS)
    again = merge.merge_changes(state, _changes(second), LOG_KEYS)
    return merge.merge_changes(again, _changes(first), LOG_KEYS)


@query(_STATE_ROWS)
def cdc_combine_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net changes per day, then combined: how stored batches are read back."""
    log = change_log(spark, sf_dir).withColumn("day", F.to_date("commit_at"))
    daily = ev.net_changes(
        log,
        ["day", *LOG_KEYS],
        commit=F.col("commit_at"),
        deletes=F.col("is_delete"),
        payload=LOG_PAYLOAD,
        order=log_order(),
    )
    combined = ev.combine_changes(daily, LOG_KEYS, LOG_PAYLOAD)
    return ev.current_state(combined).select(*_STATE_COLUMNS)


@query(f"""WITH {LOG}
SELECT package_id, version, place, value, commit_at FROM (
  SELECT *, row_number() OVER (PARTITION BY package_id, version
                               ORDER BY commit_at DESC, place DESC) AS rk
  FROM log WHERE NOT is_delete) AS ranked
WHERE rk = 1""")
def cdc_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole last details rows, as a ranking window."""
    details = change_log(spark, sf_dir).filter(~F.col("is_delete"))
    last = ev.keep_last(details, LOG_KEYS, [F.col("commit_at"), F.col("place")])
    return last.select("package_id", "version", "place", "value", "commit_at")


@query(f"""WITH {_STATE}
SELECT d.package_id, d.version, d.value, d.commit_at AS details_at, x.delete_at AS deleted_at
FROM last_details AS d LEFT JOIN last_delete AS x
  ON d.package_id = x.package_id AND d.version = x.version""")
def cdc_delete_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table built without deletes, marked afterwards from all delete events.

    A later re-publish does not lift the mark.
    """
    log = change_log(spark, sf_dir)
    known = _state(log.filter(~F.col("is_delete")))
    deletes = log.filter("is_delete").withColumnRenamed("commit_at", "delete_at")
    marked = merge.mark_deleted(known, deletes, LOG_KEYS)
    return marked.select("package_id", "version", "value", "details_at", "deleted_at")


@query(f"""WITH {LOG}
SELECT package_id, version, max(commit_at) AS delete_at FROM log AS x
WHERE is_delete AND NOT EXISTS (
  SELECT 1 FROM log AS d
  WHERE NOT d.is_delete AND d.package_id = x.package_id AND d.version = x.version)
GROUP BY package_id, version""")
def cdc_orphan_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes of versions that were never published."""
    orphans = ev.orphan_deletes(_changes(change_log(spark, sf_dir)))
    return orphans.select("package_id", "version", "delete_at")


@query(f"""WITH {_STATE}
SELECT package_id, count(*) AS live_versions FROM state
WHERE deleted_at IS NULL GROUP BY package_id""")
def cdc_live_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = versions.live(_state(change_log(spark, sf_dir)))
    return live.groupBy("package_id").agg(F.count(F.lit(1)).alias("live_versions"))


@query("""SELECT CASE WHEN event_type = 'error' THEN 'delete' ELSE 'details' END AS kind,
       event_type, count(*) AS n_events, min(ts) AS first_at, max(ts) AS last_at
FROM events GROUP BY 1, 2""")
def cdc_event_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details and deletes split by type, then back in one stream."""
    events = table(spark, sf_dir, "events").withColumn(
        "catalog_type",
        F.when(F.col("event_type") == "error", F.lit(ev.DELETE_TYPE)).otherwise(
            F.concat(F.lit("nuget:"), "event_type")
        ),
    )
    deletes = ev.is_delete(F.col("catalog_type"))
    details = events.filter(~deletes).withColumn("kind", F.lit("details"))
    gone = events.filter(deletes).drop("value").withColumn("kind", F.lit("delete"))
    stream = details.unionByName(gone, allowMissingColumns=True)
    return stream.groupBy("kind", "event_type").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min("ts").alias("first_at"),
        F.max("ts").alias("last_at"),
    )


@query("SELECT max(ts) AS watermark, count(*) AS n_events FROM events")
def checkpoint_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next watermark: the highest commit of all events, deletes included."""
    log = change_log(spark, sf_dir)
    return log.agg(F.max("commit_at").alias("watermark"), F.count(F.lit(1)).alias("n_events"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the log as catalog pages: commit time of the last entry, and size."""
    return (
        change_log(spark, sf_dir)
        .groupBy(F.to_date("commit_at").alias("page"))
        .agg(F.max("commit_at").alias("page_commit"), F.count(F.lit(1)).alias("n_events"))
    )


_PAGES = f"""{LOG},
paged AS (SELECT CAST(commit_at AS DATE) AS page, max(commit_at) AS page_commit,
                 count(*) AS n_events FROM log GROUP BY 1)"""


@query(f"""WITH {_PAGES}
SELECT page, page_commit, n_events FROM paged
WHERE page_commit > TIMESTAMP '{CUT}' ORDER BY page_commit LIMIT 5""")
def incremental_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next five pages after a watermark, oldest first."""
    watermark = F.lit(CUT).cast("timestamp_ntz")
    new = ev.after_watermark(_pages(spark, sf_dir), F.col("page_commit"), watermark)
    return ev.first_pages(new, "page_commit", 5).select("page", "page_commit", "n_events")


@query(f"""WITH {_PAGES}, marks AS (
  SELECT 'behind' AS reader, TIMESTAMP '{CUT}' AS watermark
  UNION ALL SELECT 'caught_up', max(page_commit) FROM paged)
SELECT m.reader, count(p.page) AS pages_left, count(p.page) = 0 AS caught_up
FROM marks AS m LEFT JOIN paged AS p ON p.page_commit > m.watermark GROUP BY m.reader""")
def caught_up_readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages left for a reader that is behind and for one that has seen all."""
    # The watermark a caught-up reader holds: one value, as read from a checkpoint.
    newest = ev.latest_commit(change_log(spark, sf_dir), F.col("commit_at")).first().watermark
    marks = {"behind": CUT, "caught_up": newest}
    commit = F.col("page_commit")
    counts = _pages(spark, sf_dir).agg(
        *[
            F.count_if(commit > F.lit(mark).cast("timestamp_ntz")).alias(reader)
            for reader, mark in marks.items()
        ]
    )
    return counts.unpivot([], ["behind", "caught_up"], "reader", "pages_left").withColumn(
        "caught_up", F.col("pages_left") == 0
    )


@query(f"""WITH {_STATE},
every AS (SELECT package_id, version, min(CASE WHEN NOT is_delete THEN 0 ELSE 1 END) AS only_deleted
          FROM log GROUP BY package_id, version)
SELECT (SELECT count(DISTINCT package_id) FROM state) AS packages_upserted,
       (SELECT count(*) FROM state) AS versions_upserted,
       CAST((SELECT count(*) FROM state WHERE deleted_at IS NOT NULL)
         + (SELECT sum(only_deleted) FROM every) AS BIGINT) AS deletes_attempted""")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run reports: upserts, and deletes attempted whether or not they hit."""
    changes = _changes(change_log(spark, sf_dir))
    detailed = F.col(ev.DETAILS_AT).isNotNull()
    attempted = F.col(ev.DELETED_AT).isNotNull() & F.coalesce(
        F.col(ev.DELETED_AT) >= F.col(ev.DETAILS_AT), F.lit(True)
    )
    per_package = changes.groupBy("package_id").agg(
        F.count_if(detailed).alias("versions"), F.count_if(attempted).alias("deletes")
    )
    return per_package.agg(
        F.count_if(F.col("versions") > 0).alias("packages_upserted"),
        F.sum("versions").alias("versions_upserted"),
        F.sum("deletes").alias("deletes_attempted"),
    )
