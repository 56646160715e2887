"""Folds that rewrite the buckets which their log touches."""

import os

import pytest

from landing import Landing, at, delete, details, leaf_of
from tidemark.plans import catalog
from tidemark.plans.store import Store


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path / "landing")


def land(store, landing, minute, published=(), deleted=()):
    events = [details(name, version, at(minute)) for name, version in published]
    gone = [delete(name, version, at(minute)) for name, version in deleted]
    landing.page(events + gone, leaves=[leaf_of(e, projectUrl=f"https://p.example/{minute}") for e in events])
    catalog.sync_catalog(store, *landing.sources())


def files(store, table):
    """Path and date of each data file that the checkpoint names."""
    found = {}
    for name in store.checkpoint(catalog.SOURCE).folders[table]:
        for folder, _, names in os.walk(f"{store.root}/{table}/batch={name}"):
            for file in names:
                if file.endswith(".parquet"):
                    found[os.path.join(folder, file)] = os.stat(os.path.join(folder, file)).st_mtime_ns
    return found


def rows(store):
    return sorted(map(str, catalog.version_state(store).drop("synced_at").collect())), sorted(
        map(str, catalog.package_state(store).drop("synced_at").collect())
    )


def test_untouched_buckets_keep_their_files(spark, store, landing, tmp_path):
    whole = Store(spark, str(tmp_path / "whole"))
    packages = [(f"pkg{i}", "1.0.0") for i in range(40)]
    for minute, published, deleted in (
        (1, packages, ()),
        (2, [("pkg3", "1.1.0"), ("pkg3", "1.0.0")], ()),
        (3, (), [("pkg5", "1.0.0"), ("absent", "1.0.0")]),
    ):
        land(store, landing, minute, published, deleted)
        catalog.sync_catalog(whole, *landing.sources())
        before = files(store, catalog.VERSIONS) if minute > 1 else {}
        expected = rows(store)
        catalog.fold_catalog(store, buckets=8, only_touched=True)
        catalog.fold_catalog(whole, buckets=8)
        assert rows(store) == expected == rows(whole)
        if minute > 1:
            after = files(store, catalog.VERSIONS)
            assert len(before.items() & after.items()) >= len(before) - 2 and before != after
            assert set(before.items()) - set(after.items())
    assert store.checkpoint(catalog.SOURCE).folders[catalog.LOG] == []


def test_tables_change_their_form(spark, store, landing):
    land(store, landing, 1, [(f"p{i}", "1.0.0") for i in range(9)])
    catalog.fold_catalog(store, buckets=4)
    land(store, landing, 2, [("p1", "2.0.0")])
    expected = rows(store)
    catalog.fold_catalog(store, only_touched=True)
    assert rows(store) == expected
    assert len(store.checkpoint(catalog.SOURCE).folders[catalog.VERSIONS]) > 1
    land(store, landing, 3, [("p2", "2.0.0")])
    expected = rows(store)
    with pytest.raises(ValueError, match="kept in 4 buckets"):
        catalog.fold_catalog(store, buckets=5, only_touched=True)
    assert rows(store) == expected
    catalog.fold_catalog(store, buckets=5)
    assert rows(store) == expected
    assert len(store.checkpoint(catalog.SOURCE).folders[catalog.VERSIONS]) == 1


def test_backfill_of_touched_buckets(spark, store, landing):
    land(store, landing, 1, [(f"p{i}", "1.0.0") for i in range(30)])
    land(store, landing, 2, (), [("p7", "1.0.0")])
    land(store, landing, 3, [("p7", "1.0.0")])
    catalog.fold_catalog(store, buckets=8, only_touched=True)
    assert all(r.deleted_at is None for r in catalog.version_state(store).collect())
    before = files(store, catalog.VERSIONS)
    catalog.backfill_deletes(store, *landing.sources()[:2])
    marked = {r.package_id for r in catalog.version_state(store).filter("deleted_at is not null").collect()}
    assert marked == {"p7"} and catalog.version_state(store).count() == 30
    after = files(store, catalog.VERSIONS)
    assert len(before.items() & after.items()) == len(before) - 1


def test_a_fold_without_rows_publishes_nothing(spark, store, landing):
    land(store, landing, 1, (), [("gone", "1.0.0")])
    for only_touched in (True, False):
        with pytest.raises(RuntimeError, match="blocking checks failed"):
            catalog.fold_catalog(store, buckets=2, only_touched=only_touched)
        at_ = store.checkpoint(catalog.SOURCE)
        assert at_.folders[catalog.LOG] and not at_.folders.get(catalog.VERSIONS)
