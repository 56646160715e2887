"""Syncs in slices: progress is committed and told after each one."""

import pytest

from landing import Landing, at, delete, details, leaf_of
from tidemark.plans import catalog


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path / "landing")


def land(landing, minutes):
    for minute in minutes:
        events = [details("Same", f"{minute}.0", at(minute)), details("Same", f"{minute}.0", at(minute, ".5")), details(f"P{minute}", "1.0", at(minute))]
        landing.page([*events, delete("Same", "0.1", at(minute))], leaves=[leaf_of(e) for e in events])


def beats(store):
    rows = store.run_events().orderBy("event_at").collect()
    return [(r.status, r.rows_inserted, r.rows_updated, r.rows_deleted, r.pages_processed, r.watermark_after) for r in rows]


def test_a_heartbeat_after_each_slice(store, landing):
    land(landing, range(1, 6))
    result = catalog.sync_catalog(store, *landing.sources(), slice_pages=2)
    # each page writes two versions of two packages, however often it names them
    assert beats(store) == [
        ("running", 0, 0, 0, 0, None),
        ("running", 4, 3, 1, 2, at(2, ".5")),
        ("running", 8, 6, 2, 4, at(4, ".5")),
        ("running", 10, 8, 3, 5, at(5, ".5")),
        ("completed", 10, 8, 3, 5, at(5, ".5")),
    ]
    assert (result.status, result.metrics["details"], result.metrics["pages_remaining"]) == ("completed", 15, 0)
    assert catalog.version_state(store).count() == 10
    assert len(store.checkpoint(catalog.SOURCE).folders[catalog.LOG]) == 3


def test_a_limit_cuts_the_last_slice(store, landing):
    land(landing, range(1, 6))
    result = catalog.sync_catalog(store, *landing.sources(), max_pages=3, slice_pages=2)
    assert (result.status, result.pages, result.watermark, result.metrics["pages_remaining"]) == ("partial", 3, at(3, ".5"), 2)
    assert [b[4] for b in beats(store)] == [0, 2, 3, 3]
    assert catalog.sync_catalog(store, *landing.sources(), slice_pages=9).pages == 2


def test_a_failed_run_keeps_its_slices(store, landing):
    land(landing, range(1, 6))
    index, pages, leaves = landing.sources()
    calls = []

    def failing(refs):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return leaves(refs)

    with pytest.raises(RuntimeError, match="lost"):
        catalog.sync_catalog(store, index, pages, failing, slice_pages=2)
    after = store.checkpoint(catalog.SOURCE)
    assert (after.status, after.watermark) == ("failed", at(2, ".5"))
    assert catalog.version_state(store).count() == 4
    assert catalog.sync_catalog(store, index, pages, leaves).pages == 3
    assert catalog.version_state(store).count() == 10
