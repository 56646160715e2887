"""Data quality, run ledger and run measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import functions as tf
from tidemark.operators import ledger, quality
from tidemark.plans.workload.registry import query, table
from tidemark.plans.workload.standins import RUNS, change_log, runs

NOW = "2001-06-30 18:30:00"
_NOW = f"TIMESTAMP '{NOW}'"


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


# --- checks ------------------------------------------------------------------------


def _check(name: str, passed: str, severity: str, blocking: str, measured: str, limit: str) -> str:
    return f"""SELECT '{name}' AS check_name, {passed} AS passed, '{severity}' AS severity,
  {blocking} AS blocking, CAST({measured} AS DOUBLE) AS measured,
  CAST({limit} AS DOUBLE) AS threshold"""


def _rule(name: str, broken: str, source: str) -> str:
    return (
        _check(name, f"count(*) FILTER (WHERE {broken}) = 0", "ERROR", "false",
               f"count(*) FILTER (WHERE {broken})", "0") + f" FROM {source}"
    )


_DQ = " UNION ALL ".join(
    [
        _check("orders_nonempty", "count(*) > 0", "ERROR", "true", "count(*)", "0") + " FROM orders",
        _check("orders_key", "count(*) = 0", "ERROR", "false", "count(*)", "0")
        + " FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1) AS r",
        _check("lineitem_key", "count(*) = 0", "ERROR", "false", "count(*)", "0")
        + " FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) AS r",
        _rule("customer_name_set", "c_name IS NULL", "customer"),
        _rule("customer_balance", "c_acctbal < 0", "customer"),
        _rule("customer_segment", "c_mktsegment NOT IN ('BUILDING', 'MACHINERY')", "customer"),
        _rule("status_known", "o_orderstatus NOT IN ('F', 'O', 'P')", "orders"),
        _check(
            "open_orders",
            "100.0 * count(*) FILTER (WHERE o_orderstatus = 'O') / count(*) <= 60.0",
            "WARN", "false",
            "round(100.0 * count(*) FILTER (WHERE o_orderstatus = 'O') / count(*), 2)", "60",
        ) + " FROM orders",
    ]
)


@query(_DQ)
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All kinds of checks in one report; the line item key fails on purpose."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    classed = orders.select(
        F.when(F.col("o_orderstatus") == "O", F.lit("unknown"))
        .otherwise(F.lit("open_source"))
        .alias("classification")
    )
    return quality.report(
        [
            quality.nonempty(orders, "orders_nonempty"),
            quality.key_uniqueness(orders, ["o_orderkey"], "orders_key"),
            quality.key_uniqueness(
                table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem_key"
            ),
            quality.violations(
                customer,
                {
                    "customer_name_set": F.col("c_name").isNotNull(),
                    "customer_balance": F.col("c_acctbal") >= 0,
                    "customer_segment": F.col("c_mktsegment").isin("BUILDING", "MACHINERY"),
                },
            ),
            quality.violations(
                orders, {"status_known": F.col("o_orderstatus").isin("F", "O", "P")}
            ),
            quality.unknown_ratio(classed, "open_orders"),
        ]
    )


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key values that break uniqueness."""
    return quality.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"""SELECT check_name, severity, blocking AS stops_next_job
FROM ({_DQ}) AS report WHERE NOT passed""")
def dq_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed checks, and whether each stops the next job."""
    failed = dq_report(spark, sf_dir).filter(~F.col("passed"))
    return failed.select("check_name", "severity", F.col("blocking").alias("stops_next_job"))


# --- ledger ------------------------------------------------------------------------

_LIMITS = {"1": 12, "2": 24, "3": 240, "4": 2400, "5": 24000, "6": 24}


@query(f"""WITH {RUNS}, limits AS (
  SELECT * FROM (VALUES {', '.join(f"('{k}', {v})" for k, v in _LIMITS.items())}) AS v(source, h)),
last AS (SELECT lane, max(completed_at) AS at FROM runs WHERE status = 'completed' GROUP BY lane)
SELECT 'freshness_' || l.source AS check_name,
  coalesce(epoch_ms({_NOW}) - epoch_ms(a.at) <= CAST(l.h AS BIGINT) * 3600000, false) AS passed,
  round((epoch_ms({_NOW}) - epoch_ms(a.at)) / 3600000.0, 2) AS measured,
  CAST(l.h AS DOUBLE) AS threshold
FROM limits AS l LEFT JOIN last AS a ON a.lane = l.source""")
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    lanes = runs(spark, sf_dir).drop("source").withColumnRenamed("lane", "source")
    checks = ledger.freshness(lanes, _LIMITS, _now())
    return checks.select("check_name", "passed", "measured", "threshold")


@query(f"""WITH {RUNS}
SELECT source, max(CASE WHEN status = 'completed' THEN completed_at END) AS last_completed_at,
  coalesce({_NOW} - max(CASE WHEN status = 'completed' THEN completed_at END)
           >= INTERVAL '4800' HOUR, true) AS is_stale
FROM runs GROUP BY source""")
def staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.staleness(runs(spark, sf_dir), _now(), hours=4800)


@query(f"""WITH {RUNS} SELECT source, max(completed_at) AS last_completed_at
FROM runs WHERE status = 'completed' GROUP BY source""")
def last_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.last_success(runs(spark, sf_dir))


def _sweep_sql(since: str) -> str:
    dead = f"(status = 'running' AND {since} < {_NOW} - INTERVAL '9600' HOUR)"
    return f"""WITH {RUNS} SELECT id, CASE WHEN {dead} THEN 'failed' ELSE status END AS status,
  CASE WHEN {dead} THEN {_NOW} ELSE completed_at END AS completed_at, {dead} AS swept FROM runs"""


@query(_sweep_sql("started_at"))
def zombie_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    swept = ledger.sweep_zombies(runs(spark, sf_dir), _now(), hours=9600)
    return swept.select("id", "status", "completed_at", "swept")


@query(_sweep_sql("last_heartbeat_at"))
def zombie_sweep_by_heartbeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    swept = ledger.sweep_zombies(
        runs(spark, sf_dir), _now(), hours=9600, since="last_heartbeat_at"
    )
    return swept.select("id", "status", "completed_at", "swept")


@query(f"""WITH {RUNS} SELECT id, 'unsettled' AS found FROM runs WHERE status IN ('running', 'failed')
UNION ALL SELECT id, 'quiet' FROM runs
WHERE status = 'running' AND last_heartbeat_at < {_NOW} - INTERVAL '9600' HOUR""")
def ledger_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = runs(spark, sf_dir)
    before = _now() - F.make_dt_interval(hours=F.lit(9600))
    unsettled = ledger.unsettled_runs(rows).select("id", F.lit("unsettled").alias("found"))
    quiet = ledger.quiet_runs(rows, before).select("id", F.lit("quiet").alias("found"))
    return unsettled.unionByName(quiet)


_RUN_EVENTS = """run_events AS (
  SELECT user_id AS id, ts AS event_at,
         CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'completed'
              ELSE 'running' END AS status, event_id, value FROM events)"""


@query(f"""WITH {_RUN_EVENTS}
SELECT id, status, event_at, event_id AS pages_processed FROM (
  SELECT *, row_number() OVER (PARTITION BY id
    ORDER BY CASE WHEN status = 'running' THEN 0 ELSE 1 END DESC, event_at DESC) AS rk
  FROM run_events) AS ranked WHERE rk = 1""")
def run_ledger_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each run's current row; a late heartbeat never reopens a settled run."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        F.col("ts").alias("event_at"),
        F.when(F.col("event_type") == "error", "failed")
        .when(F.col("event_type") == "purchase", "completed")
        .otherwise("running")
        .alias("status"),
        F.col("event_id").alias("pages_processed"),
        F.col("ts").alias("started_at"),
        F.col("ts").alias("completed_at"),
    )
    return ledger.current_runs(events).select("id", "status", "event_at", "pages_processed")


@query("""SELECT source, watermark, last_sync_status, rows_synced FROM (
  SELECT 'user-' || CAST(user_id AS VARCHAR) AS source, CAST(event_id AS VARCHAR) AS watermark,
         event_type AS last_sync_status, CAST(json_extract_string(props, '$.k') AS BIGINT) AS rows_synced,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rk FROM events) AS r
WHERE rk = 1""")
def checkpoint_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoints are replaced per source, row counts included."""
    entries = table(spark, sf_dir, "events").select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("source"),
        F.col("event_id").cast("string").alias("watermark"),
        F.col("ts").alias("last_sync_at"),
        F.col("event_type").alias("last_sync_status"),
        F.get_json_object("props", "$.k").cast("bigint").alias("rows_synced"),
    )
    return ledger.current_checkpoints(entries).select(
        "source", "watermark", "last_sync_status", "rows_synced"
    )


@query("""WITH r AS (
  SELECT user_id, count(*) AS n, min(ts) AS started_at,
         CASE WHEN count(*) % 5 <> 0 THEN max(ts) END AS completed_at FROM events GROUP BY user_id),
d AS (SELECT *, CAST(round((epoch_us(completed_at) - epoch_us(started_at)) / 1000.0) AS BIGINT)
        AS duration_ms FROM r)
SELECT user_id, duration_ms,
  CASE WHEN duration_ms IS NOT NULL
       THEN round(n / greatest(duration_ms / 1000.0, 0.001), 2) END AS rows_per_sec FROM d""")
def run_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' sessions as runs: duration, null while running, and rate."""
    sessions = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("ts").alias("started_at"),
            F.max("ts").alias("last_at"),
        )
    )
    timed = sessions.withColumn(
        "duration_ms",
        tf.duration_ms(F.col("started_at"), F.when(F.col("n") % 5 != 0, F.col("last_at"))),
    )
    return timed.select(
        "user_id",
        "duration_ms",
        tf.per_second(F.col("n"), F.col("duration_ms")).alias("rows_per_sec"),
    )


@query(f"""WITH {RUNS}, d AS (SELECT *, epoch_ms(completed_at) - epoch_ms(started_at) AS ms
  FROM runs WHERE status <> 'running')
SELECT id, source, ms AS duration_ms,
  round(rows_inserted / greatest(ms / 1000.0, 0.001), 2) AS rows_per_sec,
  round(pages_processed / greatest(ms / 1000.0, 0.001), 2) AS pages_per_sec FROM d""")
def run_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    finished = runs(spark, sf_dir).filter(F.col("status") != "running")
    return ledger.throughput(
        finished.withColumn(
            "duration_ms", tf.duration_ms(F.col("started_at"), F.col("completed_at"))
        )
    )


@query("""WITH pages AS (
  SELECT CAST(ts AS DATE) AS page, count(*) AS n_events, max(ts) AS watermark FROM events GROUP BY 1),
seen AS (
  SELECT *, row_number() OVER (ORDER BY page) AS pages_processed,
         sum(n_events) OVER (ORDER BY page) AS rows_synced, count(*) OVER () AS pages_total
  FROM pages)
SELECT page, watermark, pages_processed, pages_total, CAST(rows_synced AS BIGINT) AS rows_synced,
       least(round(100.0 * pages_processed / pages_total, 2), 100.0) AS progress_pct FROM seen""")
def page_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress after each page, days of the log being pages.

    The window runs over one row per day, not over events.
    """
    pages = (
        change_log(spark, sf_dir)
        .groupBy(F.to_date("commit_at").alias("page"))
        .agg(F.count(F.lit(1)).alias("n_events"), F.max("commit_at").alias("watermark"))
    )
    upto, every = Window.orderBy("page"), Window.partitionBy()
    seen = pages.select(
        "page",
        "watermark",
        F.row_number().over(upto).cast("bigint").alias("pages_processed"),
        F.sum("n_events").over(upto).alias("rows_synced"),
        F.count(F.lit(1)).over(every).alias("pages_total"),
    )
    return seen.withColumn(
        "progress_pct", tf.progress_pct(F.col("pages_processed"), F.col("pages_total"))
    )
