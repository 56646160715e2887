import pytest
from pyspark.sql import functions as F

from landing import BASE, Landing, at, delete, details, leaf_of
from tidemark.plans import catalog
from tidemark.plans.store import Store, run_job


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path / "landing")


def sync(store, landing, **kw):
    return catalog.sync_catalog(store, *landing.sources(), **kw)


def versions(store):
    rows = catalog.version_state(store).collect()
    return {(r.package_id, r.version): r for r in rows}


def packages(store):
    return {r.package_id: r for r in catalog.package_state(store).collect()}


def test_one_package_and_replay(store, landing):
    event = details("Alpha.Core", "2.1.0-rc.1", at(1))
    landing.page(
        [event],
        leaves=[leaf_of(event, licenseExpression="MIT", projectUrl="https://alpha.example")],
    )
    result = sync(store, landing)
    assert (result.status, result.inserted, result.pages) == ("completed", 1, 1)
    assert result.watermark == at(1)
    row = versions(store)["Alpha.Core", "2.1.0-rc.1"]
    assert (row.major, row.minor, row.patch, row.prerelease) == (2, 1, 0, "rc.1")
    assert row.purl == "pkg:nuget/Alpha.Core@2.1.0-rc.1"
    assert row.listed is True and row.deprecated is False and row.deleted_at is None
    package = packages(store)["Alpha.Core"]
    assert (package.latest_version, package.license) == ("2.1.0-rc.1", "MIT")
    before = versions(store), packages(store)

    # The same page again, as after a crash before the checkpoint was written.
    store.commit(catalog.SOURCE, "0", store.checkpoint(catalog.SOURCE).folders, "failed", 0)
    sync(store, landing)
    after = versions(store), packages(store)
    assert [sorted(x) for x in before] == [sorted(x) for x in after]
    assert len(after[0]) == 1


def test_deprecation_block(store, landing):
    full, empty = details("Old", "1.0.0", at(1)), details("Old", "1.1.0", at(2))
    landing.page(
        [full, empty],
        leaves=[
            leaf_of(
                full,
                listed=False,
                deprecation={
                    "reasons": ["Legacy", "Other"],
                    "alternatePackage": {"id": "New", "range": "*"},
                    "message": "use New",
                },
            ),
            leaf_of(empty, deprecation={}),
        ],
    )
    sync(store, landing)
    row = versions(store)["Old", "1.0.0"]
    assert row.deprecated and row.deprecation_reasons == ["Legacy", "Other"]
    assert (row.alternative_package, row.deprecation_message) == ("New", "use New")
    assert row.listed is False
    row = versions(store)["Old", "1.1.0"]
    assert row.deprecated and row.deprecation_reasons is None and row.alternative_package is None


def test_last_commit_wins_within_and_across_batches(store, landing):
    first, second = details("A", "1.0", at(1)), details("A", "1.0", at(5))
    other = details("A", "0.9", at(7))
    landing.page(
        [second, first, other],
        leaves=[
            leaf_of(first, projectUrl="old"),
            leaf_of(second, projectUrl="new"),
            leaf_of(other, projectUrl="other"),
        ],
    )
    sync(store, landing)
    assert len(versions(store)) == 2
    # Latest means last committed, not the highest number.
    assert packages(store)["A"].latest_version == "0.9"
    third = details("A", "1.0", at(9))
    landing.page([third], leaves=[leaf_of(third)])
    sync(store, landing)
    package = packages(store)["A"]
    assert package.latest_version == "1.0"
    assert package.project_url is None  # a null in the newer leaf overwrites


def test_equal_commit_place_and_delete(store, landing):
    one, two = details("A", "1.0", at(1)), details("A", "2.0", at(1))
    landing.page([one, delete("A", "1.0", at(1)), two])
    sync(store, landing)
    rows = versions(store)
    assert rows["A", "1.0"].deleted_at is not None  # the delete wins
    assert rows["A", "2.0"].deleted_at is None
    assert packages(store)["A"].latest_version == "2.0"  # later place in the page


@pytest.mark.parametrize("fold", [False, True])
def test_delete_then_republish_then_delete(store, landing, fold):
    landing.page([details("A", "1.0", at(1))])
    sync(store, landing)
    steps = [
        ([delete("A", "1.0", at(2))], True),
        ([details("A", "1.0", at(3))], False),
        ([delete("A", "1.0", at(4)), delete("A", "9.9", at(4))], True),
    ]
    for events, gone in steps:
        if fold:
            catalog.fold_catalog(store)
        landing.page(events)
        sync(store, landing)
        rows = versions(store)
        assert (rows["A", "1.0"].deleted_at is not None) is gone
        assert ("A", "9.9") not in rows  # nothing to mark
        assert packages(store)["A"].deleted_at is None


def test_delete_in_one_page_keeps_payload(store, landing):
    event = details("A", "1.0", at(1))
    landing.page([event, delete("A", "1.0", at(2))], leaves=[leaf_of(event, projectUrl="p")])
    sync(store, landing)
    row = versions(store)["A", "1.0"]
    assert row.deleted_at.minute == 2
    assert '"projectUrl": "p"' in row.raw_metadata


def test_caught_up_and_partial(store, landing):
    for minute in (1, 2, 3):
        landing.page([details("A", f"{minute}.0", at(minute))])
    result = sync(store, landing, max_pages=2)
    assert (result.status, result.pages, result.metrics["pages_remaining"]) == ("partial", 2, 1)
    assert sorted(v for _, v in versions(store)) == ["1.0", "2.0"]
    assert sync(store, landing).pages == 1
    folders = store.checkpoint(catalog.SOURCE).folders
    result = sync(store, landing)
    assert (result.status, result.pages, result.folders) == ("completed", 0, folders)


def test_fractions_order_by_instant(store, landing):
    plain, half = details("A", "1.0", at(1)), details("A", "1.0", at(1, ".5"))
    fine, finer = details("B", "1", at(1, ".1234561")), details("B", "1", at(1, ".1234567"))
    landing.page(
        [half, plain, finer, fine],
        commit=at(1, ".5"),
        leaves=[
            leaf_of(plain, projectUrl="plain"),
            leaf_of(half, projectUrl="half"),
            leaf_of(fine, projectUrl="fine"),
            leaf_of(finer, projectUrl="finer"),
        ],
    )
    result = sync(store, landing)
    assert result.watermark == at(1, ".5")  # as text, the plain second sorts higher
    assert packages(store)["A"].project_url == "half"
    assert packages(store)["B"].project_url == "finer"


def test_rejects_are_kept(store, landing):
    good, lost, bad, nodate = (details(p, "1.0", at(1)) for p in ("G", "L", "B", "N"))
    undated, gone = details("U", "1.0", "zz"), delete("G", "1.0", "zz")
    landing.page(
        [good, lost, bad, nodate, undated, gone],
        commit=at(1),
        leaves=[
            leaf_of(undated),
            leaf_of(good),
            {"@id": bad["@id"], "id": "B", "published": "2024-01-01"},
            leaf_of(nodate, published="some day"),
            '{"@id": "cut short',
        ],
    )
    result = sync(store, landing)
    assert result.metrics["rejects"] == 5
    assert result.watermark == at(1)
    assert set(versions(store)) == {("G", "1.0")}
    assert versions(store)["G", "1.0"].deleted_at is None
    reasons = {r.package_id: r.reason for r in catalog.rejects(store).collect()}
    assert reasons == {
        "L": "missing_leaf", "B": "missing_field", "N": "bad_published", "U": "bad_commit",
        "G": "bad_commit",
    }


def test_leaf_identity_counts_and_copies_do_not(spark, store, landing):
    event = details("alpha", "1.0.0", at(1))
    landing.page([event, event], leaves=[leaf_of(event, id="Alpha", version="1.0"), "{}"])
    landing.leaves([leaf_of(event, id="Alpha", version="1.0")])
    result = sync(store, landing)
    assert result.inserted == 1
    assert set(versions(store)) == {("Alpha", "1.0")}
    from tidemark.sources import identity_mismatches

    assert identity_mismatches(catalog.catalog_log(store)).count() == 1


def test_any_cut_gives_the_same_tables(spark, tmp_path):
    events = []
    for minute in range(12):
        package, version = "AB"[minute % 2], f"{minute % 3}.0"
        make = delete if minute % 4 == 3 else details
        events.append(make(package, version, at(minute)))

    def state(cuts, name):
        landing = Landing(spark, tmp_path / name)
        store = Store(spark, str(tmp_path / f"{name}-store"))
        start = 0
        for cut in [*cuts, len(events)]:
            landing.page(events[start:cut])
            sync(store, landing)
            if cut % 2:
                catalog.fold_catalog(store)
            start = cut
        v = {k: (r.deleted_at, r.raw_metadata) for k, r in versions(store).items()}
        p = {k: (r.latest_version, r.raw_metadata) for k, r in packages(store).items()}
        return v, p

    whole = state([], "whole")
    assert state([5], "two") == whole
    assert state([3, 4, 9], "four") == whole


def test_backfill_marks_existing_rows_only(store, landing):
    landing.page([details("A", "1.0", at(1)), details("B", "1.0", at(1))])
    sync(store, landing)
    landing.page([delete("A", "1.0", at(2)), details("A", "1.0", at(3)), delete("C", "1", at(3))])
    sync(store, landing)
    assert versions(store)["A", "1.0"].deleted_at is None
    main = store.checkpoint(catalog.SOURCE).watermark
    index, pages, _ = landing.sources()
    result = catalog.backfill_deletes(store, index, pages)
    assert (result.deleted, result.pages) == (2, 2)
    rows = versions(store)
    assert rows["A", "1.0"].deleted_at.minute == 2  # the re-publish is not looked at
    assert rows["B", "1.0"].deleted_at is None and ("C", "1") not in rows
    assert store.checkpoint(catalog.SOURCE).watermark == main
    assert store.checkpoint(catalog.BACKFILL).watermark == at(3)
    assert catalog.backfill_deletes(store, index, pages).pages == 0
    # The next real publish lifts the mark again.
    landing.page([details("A", "1.0", at(8))])
    sync(store, landing)
    assert versions(store)["A", "1.0"].deleted_at is None


def test_run_frame_records_outcomes(store):
    from tidemark.plans.store import RunResult

    def step(before, run):
        run.heartbeat(inserted=3, pages=1, watermark="m1")
        return RunResult("w1", {"t": ["f"]}, inserted=5, updated=2, pages=2)

    run_job(store, "s", step, external_run_id="ext")
    row = store.runs().first()
    assert (row.status, row.rows_inserted, row.pages_processed) == ("completed", 5, 2)
    assert (row.watermark_before, row.watermark_after) == ("0", "w1")
    assert row.external_run_id == "ext" and row.duration_ms >= 0
    assert store.checkpoint("s").watermark == "w1"

    def broken(before, run):
        assert before.watermark == "w1"
        run.heartbeat(inserted=1, watermark="w2")
        raise ValueError("no luck")

    with pytest.raises(ValueError):
        run_job(store, "s", broken)
    failed = store.runs().filter(F.col("status") == "failed").first()
    assert failed.error_message == "no luck" and "ValueError" in failed.error_details
    assert failed.watermark_after == "w1"
    kept = store.checkpoint("s")
    assert (kept.watermark, kept.folders) == ("w1", {"t": ["f"]})
    rows = {r.source: r for r in store.checkpoints().collect()}
    assert rows["s"].last_sync_status == "failed" and rows["s"].rows_synced == 0


def test_stream_equals_batch(spark, store, landing, tmp_path):
    from tidemark.streaming.catalog_stream import stream_pages

    landing.page([details("A", "1.0", at(1)), details("B", "1.0", at(1))])
    landing.page([delete("A", "1.0", at(2)), details("A", "2.0", at(3))])

    _, _, leaves_for = landing.sources()

    def run():
        stream_pages(
            store, str(landing.root / "pages"), leaves_for, str(tmp_path / "cp"), files_per_batch=1
        ).awaitTermination()

    run()
    assert len(store.checkpoint(catalog.SOURCE).folders[catalog.LOG]) == 2
    landing.page([details("A", "1.0", at(5))])
    run()
    other = Store(spark, str(tmp_path / "batch"))
    sync(other, landing)
    drop = ["synced_at"]
    for table in (catalog.version_state, catalog.package_state):
        assert (
            table(store).drop(*drop).exceptAll(table(other).drop(*drop)).count() == 0
        )
        assert table(store).count() == table(other).count()
    assert store.checkpoint(catalog.SOURCE).watermark == at(5)
    assert store.runs().filter("status = 'completed'").count() == 3  # one per batch


def test_landed_days_reads_only_the_days_needed(spark, tmp_path):
    import json

    from tidemark.sources import parse_leaves, parse_pages

    event = details("A", "1.0", at(1))
    for day in ("2024-05-01", "2024-05-02"):
        folder = tmp_path / "leaves" / f"day={day}"
        folder.mkdir(parents=True)
        (folder / "x.json").write_text(json.dumps(leaf_of(event, version=day)) + "\n")
    page = json.dumps({"@id": f"{BASE}/p", "commitTimeStamp": at(1), "items": [event]})
    refs = parse_pages(spark.createDataFrame([(page,)], "value string"))
    documents = catalog.landed_days(spark, str(tmp_path / "leaves"), refs)
    assert [r.leaf_version for r in parse_leaves(documents).collect()] == ["2024-05-01"]
    plan = documents._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_a_fold_shuffles_only_the_log(spark, store, landing, monkeypatch):
    landing.page([details(f"P{i}", "1.0", at(1)) for i in range(30)])
    sync(store, landing)
    catalog.fold_catalog(store, buckets=4)
    landing.page([details("P3", "1.0", at(2)), delete("P4", "1.0", at(2)), details("Q", "1", at(2))])
    sync(store, landing)
    plans = []
    write = Store.write_bucketed

    def seen(self, table, name, rows, keys, buckets, *floors):
        plans.append((table, buckets, rows._jdf.queryExecution().executedPlan().toString()))
        write(self, table, name, rows, keys, buckets, *floors)

    monkeypatch.setattr(Store, "write_bucketed", seen)
    catalog.fold_catalog(store)
    folders = store.checkpoint(catalog.SOURCE).folders
    for table, buckets, plan in plans:
        assert buckets == 4 and "Bucketed: true" in plan
        target = plan.index("Bucketed: true")
        # The stored side is printed first: between the join and its scan, no exchange.
        assert "Exchange" not in plan[plan.index("SortMergeJoin") : target]
        folder = f"{store.root}/{table}/batch={folders[table][0]}"
        import os

        assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) == 4
    rows = versions(store)
    assert len(rows) == 31 and rows["P4", "1.0"].deleted_at is not None
    assert spark.catalog.listTables() == []
    kept = store.checkpoints().filter("source = 'catalog'").first()
    assert (kept.watermark, kept.last_sync_status, kept.rows_synced) == (at(2), "completed", 5)
    per_source = {r.source: r["count"] for r in store.runs().groupBy("source").count().collect()}
    assert per_source == {"catalog": 2, "catalog_fold": 2}
    # Another bucket count lays the tables out anew.
    landing.page([delete("P5", "1.0", at(3))])
    sync(store, landing)
    catalog.fold_catalog(store, buckets=2)
    assert plans[-1][1] == 2
    rows = versions(store)
    assert len(rows) == 31 and rows["P5", "1.0"].deleted_at is not None
