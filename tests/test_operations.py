import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ledger, quality

RUN = "id string, source string, status string, started_at timestamp, completed_at timestamp, " \
      "last_heartbeat_at timestamp, error_message string, rows_inserted bigint, pages_processed int"


def hours(n):
    return dt.datetime(2024, 6, 1) + dt.timedelta(hours=n)


def now(n):
    return F.lit(hours(n).isoformat()).cast("timestamp")


@pytest.fixture
def runs(spark):
    rows = [
        ("r1", "catalog", "completed", hours(0), hours(1), hours(1), None, 10, 2),
        ("r2", "catalog", "partial", hours(9), hours(10), hours(10), None, 5, 1),
        ("r3", "catalog", "running", hours(11), None, hours(15), None, 0, 0),
        ("r4", "catalog", "running", hours(13), None, hours(13), None, 0, 0),
        ("r5", "license_list", "failed", hours(5), hours(6), None, "x", 0, 0),
        ("r6", "license_verdict", "completed", hours(2), hours(3), None, None, 7, 7),
    ]
    return spark.createDataFrame(rows, RUN)


def test_staleness_and_freshness(runs):
    def stale(at):
        return {r.source: r.is_stale for r in ledger.staleness(runs, now(at)).collect()}

    # Partial and failed runs never count; exactly the limit is stale.
    assert stale(12) == {"catalog": False, "license_list": True, "license_verdict": False}
    assert stale(13)["catalog"] is True
    checks = ledger.freshness(runs, quality.MAX_AGE_HOURS, now(13)).collect()
    got = {r.check_name: (r.passed, r.measured, r.threshold) for r in checks}
    assert got == {
        "freshness_catalog": (True, 12.0, 12.0),
        "freshness_license_list": (False, None, 240.0),
        "freshness_license_verdict": (True, 10.0, 24.0),
    }
    assert ledger.staleness(runs.limit(0), now(1)).count() == 0
    assert ledger.freshness(runs.limit(0), {"a": 1}, now(1)).first().passed is False


def test_zombies(runs):
    def swept(**kw):
        rows = ledger.sweep_zombies(runs, now(16), **kw).filter("swept").collect()
        return {r.id: (r.status, r.completed_at, r.error_message) for r in rows}

    assert swept() == {"r3": ("failed", hours(16), ledger.ZOMBIE_MESSAGE)}  # r4: exactly 3 h
    assert swept(since="last_heartbeat_at") == {}
    assert swept(hours=2, since="last_heartbeat_at").keys() == {"r4"}
    assert swept(source="license_list") == {}
    rest = ledger.sweep_zombies(runs, now(16)).filter("not swept").drop("swept")
    assert rest.exceptAll(runs.filter("id <> 'r3'")).isEmpty()


def test_lookups(runs):
    def ids(frame):
        return sorted(r.id for r in frame.collect())

    assert ids(ledger.unsettled_runs(runs)) == ["r3", "r4", "r5"]
    assert ids(ledger.quiet_runs(runs, now(14))) == ["r4"]


def test_current_runs(spark):
    rows = [
        ("a", "running", hours(0), hours(0), None, 0),
        ("a", "completed", hours(2), hours(0), hours(2), 9),
        ("a", "running", hours(3), hours(0), None, 4),  # a late heartbeat
        ("b", "running", hours(0), hours(0), None, 0),
        ("b", "running", hours(1), hours(0), None, 3),
        ("c", "failed", hours(1), hours(0), hours(1), 0),
        ("c", "completed", hours(2), hours(0), hours(2), 1),  # settling again counts
    ]
    events = spark.createDataFrame(
        rows,
        "id string, status string, event_at timestamp, started_at timestamp, "
        "completed_at timestamp, rows_inserted bigint",
    )
    got = {r.id: (r.status, r.rows_inserted, r.duration_ms) for r in ledger.current_runs(events).collect()}
    assert got == {
        "a": ("completed", 9, 7_200_000), "b": ("running", 3, None), "c": ("completed", 1, 7_200_000),
    }


def test_checks_on_empty_and_full_tables(spark):
    rows = spark.createDataFrame(
        [(1, "a", "unknown", True), (1, None, "unknown", True), (2, "c", "odd", False)],
        "k int, name string, classification string, is_osi_approved boolean",
    )
    rules = {
        "name_set": F.col("name").isNotNull(),
        "name_short": F.length("name") < 2,  # null holds, as in a CHECK
        "class_known": F.col("classification").isin("unknown", "open_source"),
    }

    def outcome(table):
        report = quality.report(
            [
                quality.nonempty(table, "rows"),
                quality.osi_floor(table, floor=2),
                quality.unknown_ratio(table, limit=66.66),
                quality.key_uniqueness(table, ["k"], "key"),
                quality.violations(table, rules),
            ]
        )
        assert report.columns == [
            "check_name", "passed", "severity", "blocking", "measured", "threshold",
        ]
        return {r.check_name: (r.passed, r.measured) for r in report.collect()}, report

    got, report = outcome(rows)
    assert got == {
        "rows": (True, 3.0), "osi_floor": (True, 2.0),
        "unknown_ratio": (False, 66.67),  # compared before rounding
        "key": (False, 1.0), "name_set": (False, 1.0), "name_short": (True, 0.0),
        "class_known": (False, 1.0),
    }
    quality.require(report)  # nothing blocking failed
    got, report = outcome(rows.limit(0))
    assert got == {
        "rows": (False, 0.0), "osi_floor": (False, 0.0), "unknown_ratio": (True, 0.0),
        "key": (True, 0.0), "name_set": (True, 0.0), "name_short": (True, 0.0),
        "class_known": (True, 0.0),
    }
    with pytest.raises(RuntimeError, match="osi_floor, rows"):
        quality.require(report)
