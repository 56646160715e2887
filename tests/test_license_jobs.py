import pytest
from pyspark.sql import functions as F

from landing import Landing, at, details, leaf_of, license_list
from tidemark import schemas
from tidemark.operators import quality
from tidemark.plans import catalog, enrichment, licenses

MIT = {"licenseId": "MIT", "name": "MIT License", "isOsiApproved": True, "isFsfLibre": True,
       "reference": "https://list.example/MIT", "seeAlso": ["https://opensource.org/licenses/MIT"]}
OWN = {"licenseId": "Own-1.0", "name": "Own", "isOsiApproved": False}


def refs(store):
    return {r.license_id: r for r in licenses.license_ref(store).collect()}


def test_list_refresh(spark, store, tmp_path):
    first = licenses.sync_licenses(store, license_list(spark, tmp_path / "l", "3.9", [MIT, OWN]), floors=())
    assert first.metrics["rewritten"] and first.watermark == "3.9"
    assert (first.metrics["osi_count"], first.metrics["see_also_total"]) == (1, 1)
    rows = refs(store)
    assert rows["Own-1.0"].see_also_urls == [] and rows["Own-1.0"].is_fsf_libre is False
    assert rows["MIT"].source_updated_at.isoformat() == "2024-02-08T00:00:00"
    assert '"isDeprecatedLicenseId":false' in rows["MIT"].raw_metadata

    same = licenses.sync_licenses(store, license_list(spark, tmp_path / "l", "3.9", [OWN]), floors=())
    assert same.metrics == {"rewritten": False} and len(refs(store)) == 2

    # 3.10 sorts before 3.9 as text, and drops a license.
    changed = {**OWN, "name": None, "isOsiApproved": True}
    licenses.sync_licenses(store, license_list(spark, tmp_path / "l", "3.10", [changed]), floors=())
    rows = refs(store)
    assert rows["Own-1.0"].is_osi_approved and rows["Own-1.0"].name is None
    assert rows["MIT"].name == "MIT License"
    assert store.checkpoint(licenses.SOURCE).watermark == "3.10"


def test_empty_list_fails_and_keeps_the_old(spark, store, tmp_path):
    licenses.sync_licenses(store, license_list(spark, tmp_path / "l", "1", [MIT]), floors=())
    with pytest.raises(RuntimeError, match="license list is empty"):
        licenses.sync_licenses(store, license_list(spark, tmp_path / "l", "2", []), floors=())
    assert set(refs(store)) == {"MIT"}
    assert store.checkpoint(licenses.SOURCE).watermark == "1"


def land(landing, minute, packages):
    events = [details(name, "1.0", at(minute)) for name in packages]
    landing.page(events, leaves=[leaf_of(e, **packages[e["nuget:id"]]) for e in events])


def verdicts(store):
    return {r.package_id: r for r in enrichment.license_verdicts(store).collect()}


def test_enrichment(spark, store, tmp_path):
    landing = Landing(spark, tmp_path / "landing")
    land(landing, 1, {
        "a": {"licenseExpression": "MIT"},
        "b": {"licenseExpression": "Own-1.0"},
        "c": {"licenseUrl": "http://www.opensource.org/licenses/MIT/"},
        "d": {"licenseUrl": 7},
        "e": {"licenseExpression": "What", "licenseUrl": "http://x.example"},
    })
    catalog.sync_catalog(store, *landing.sources())
    with pytest.raises(RuntimeError, match="license list is empty"):
        enrichment.classify_packages(store)
    licenses.sync_licenses(store, license_list(spark, tmp_path / "l", "1", [MIT, OWN]), floors=())

    result = enrichment.classify_packages(store)
    m = result.metrics
    assert (m["rows_classified"], m["open_source"], m["proprietary"], m["unknown"]) == (5, 2, 1, 2)
    assert (m["signal_expression"], m["signal_url"], m["signal_none"]) == (3, 1, 1)
    rows = verdicts(store)
    assert rows["c"].spdx_id == "MIT" and rows["d"].reasoning == "no_signal"
    assert rows["e"].reasoning == "term_unrecognised: What"
    # All five share one synced_at; the cursor names the last of them.
    assert result.watermark.endswith("|e")
    assert enrichment.classify_packages(store).metrics == {"rows_classified": 0}

    # A newer package and a changed one are judged; a new list alone changes nothing.
    licenses.sync_licenses(
        store, license_list(spark, tmp_path / "l", "2", [{**MIT, "isOsiApproved": False}, OWN]), floors=()
    )
    assert enrichment.classify_packages(store).metrics == {"rows_classified": 0}
    land(landing, 5, {"b": {"licenseExpression": "MIT"}, "f": {}})
    catalog.sync_catalog(store, *landing.sources())
    assert enrichment.classify_packages(store).metrics["rows_classified"] == 2
    rows = verdicts(store)
    assert len(rows) == 6
    assert rows["a"].classification == "open_source"
    assert (rows["b"].classification, rows["b"].license_expression) == ("proprietary", "MIT")
    enrichment.classify_packages(store, all_packages=True)
    assert verdicts(store)["a"].classification == "proprietary"
    assert enrichment.license_verdicts(store).filter(F.col("classified_at").isNull()).isEmpty()


def test_signals_of_every_kind(spark, store, tmp_path):
    landing = Landing(spark, tmp_path / "landing")
    land(landing, 1, {"a": {"licenseExpression": "MIT"}, "b": {}, "c": {"licenseUrl": "http://x.y"}})
    catalog.sync_catalog(store, *landing.sources())
    licenses.sync_licenses(store, license_list(spark, tmp_path / "l", "1", [MIT, OWN]), floors=())
    enrichment.classify_packages(store)
    assert {k: r.reasoning for k, r in verdicts(store).items()} == {
        "a": "any_approved: MIT", "b": "no_signal", "c": "url_unrecognised",
    }


def test_store_checks(spark, store, tmp_path):
    import datetime as dt

    from tidemark.plans import checks

    empty = {r.check_name: r for r in checks.table_report(store).collect()}
    assert not empty["package_state_nonempty"].passed
    assert not empty["license_ref_osi_floor"].passed
    assert empty["license_verdict_unknown_ratio"].passed

    landing = Landing(spark, tmp_path / "landing")
    land(landing, 1, {"a": {"licenseExpression": "MIT"}, "b": {}})
    lost = details("z", "1.0", at(2))
    landing.page([lost], leaves=[])
    catalog.sync_catalog(store, *landing.sources())
    licenses.sync_licenses(store, license_list(spark, tmp_path / "l", "1", [MIT, OWN]), floors=())
    enrichment.classify_packages(store)
    failed = {r.check_name: r.measured for r in checks.table_report(store).filter("not passed").collect()}
    assert failed == {"license_ref_osi_floor": 1.0, "catalog_rejects": 1.0}

    fresh = {r.check_name: r.passed for r in checks.freshness_report(store).collect()}
    assert set(fresh.values()) == {True} and len(fresh) == 3
    later = F.current_timestamp() + F.expr("INTERVAL 13 HOURS")
    fresh = {r.check_name: r.passed for r in checks.freshness_report(store, later).collect()}
    assert fresh == {
        "freshness_catalog": False, "freshness_license_list": True, "freshness_license_verdict": True,
    }

    store.log_run(id="lost", source=catalog.SOURCE, status="running",
                  started_at=dt.datetime.now(dt.timezone.utc) - dt.timedelta(hours=4))
    assert checks.fail_zombies(store) == 1
    row = store.runs().filter("id = 'lost'").first()
    assert row.status == "failed" and row.completed_at is not None and row.error_message
    assert checks.fail_zombies(store) == 0


def test_a_list_below_its_floor_is_not_published(spark, store, tmp_path):
    def listed(approved):
        rows = [{"licenseId": f"L-{i}", "isOsiApproved": i < approved} for i in range(110)]
        return license_list(spark, tmp_path / "l", f"v{approved}", rows)

    first = licenses.sync_licenses(store, listed(100))
    assert first.metrics["license_ref_osi_floor"] == 100
    before = store.checkpoint(licenses.SOURCE)
    with pytest.raises(quality.BlockingCheckFailed, match="license_ref_osi_floor 99 < 100"):
        licenses.sync_licenses(store, listed(99))
    after = store.checkpoint(licenses.SOURCE)
    assert (after.watermark, after.folders, after.status) == ("v100", before.folders, "failed")
    assert sum(r.is_osi_approved for r in licenses.license_ref(store).collect()) == 100
    licenses.sync_licenses(store, listed(101))
    assert store.checkpoint(licenses.SOURCE).watermark == "v101"


def test_verdict_runs_write_what_they_judge(spark, store, tmp_path):
    """The table holds the verdicts after a fold; before that the runs' own folders do."""
    landing = Landing(spark, tmp_path / "landing")
    licenses.sync_licenses(store, license_list(spark, tmp_path / "l", "1", [MIT, OWN]), floors=())
    land(landing, 1, {f"p{i}": {"licenseExpression": "MIT"} for i in range(9)})
    catalog.sync_catalog(store, *landing.sources())
    enrichment.classify_packages(store)
    land(landing, 2, {"p1": {"licenseExpression": "Own-1.0"}})
    catalog.sync_catalog(store, *landing.sources())
    assert enrichment.classify_packages(store).metrics["rows_classified"] == 1
    at = store.checkpoint(enrichment.SOURCE)
    assert len(at.folders[enrichment.DELTA]) == 2 and not at.folders.get(enrichment.TABLE)
    assert store.read(enrichment.BATCH, at.folders[enrichment.DELTA][1:], schemas.LICENSE_VERDICT).count() == 1

    before = verdicts(store)
    enrichment.fold_verdicts(store)
    at = store.checkpoint(enrichment.SOURCE)
    assert at.folders[enrichment.DELTA] == [] and len(at.folders[enrichment.TABLE]) == 1
    assert verdicts(store) == before and before["p1"].classification == "proprietary"
    land(landing, 3, {"p1": {"licenseExpression": "MIT"}, "new": {}})
    catalog.sync_catalog(store, *landing.sources())
    enrichment.classify_packages(store)
    assert verdicts(store)["p1"].classification == "open_source" and len(verdicts(store)) == 10


def test_an_empty_verdict_table_is_not_published(spark, store, tmp_path):
    landing = Landing(spark, tmp_path / "landing")
    licenses.sync_licenses(store, license_list(spark, tmp_path / "l", "1", [MIT]), floors=())
    land(landing, 1, {"a": {}})
    catalog.sync_catalog(store, *landing.sources())
    enrichment.classify_packages(store)
    with pytest.raises(quality.BlockingCheckFailed):
        enrichment.fold_verdicts(store, floors=(quality.row_floor("rows", 2),))
    assert set(verdicts(store)) == {"a"}
    assert store.checkpoint(enrichment.SOURCE).folders[enrichment.DELTA]


def test_refresh_judges_what_a_changed_license_touches(spark, store, tmp_path):
    landing = Landing(spark, tmp_path / "landing")

    def edition(version, mit, own):
        rows = [{**MIT, **mit}, {**OWN, "seeAlso": ["https://own.example/l"], **own}, {"licenseId": "Far", "isOsiApproved": True}]
        licenses.sync_licenses(store, license_list(spark, tmp_path / "l", version, rows), floors=())

    edition("1", {}, {})
    land(landing, 1, {
        "mit": {"licenseExpression": "MIT"}, "either": {"licenseExpression": "MIT OR Own-1.0"},
        "own": {"licenseExpression": "Own-1.0+"}, "far": {"licenseExpression": "Far"}, "none": {},
        "url": {"licenseUrl": "http://www.own.example/l/"}, "eula": {"licenseUrl": "http://aka.ms/deprecateLicenseUrl"},
        "other": {"licenseUrl": "https://moved.example/l"}, "odd": {"licenseExpression": "own-1.0"},
    })
    catalog.sync_catalog(store, *landing.sources())
    enrichment.classify_packages(store)
    assert enrichment.refresh_verdicts(store).metrics == {"rows_classified": 0}

    edition("2", {}, {"isOsiApproved": True})
    result = enrichment.refresh_verdicts(store)
    assert result.metrics["rows_classified"] == result.updated == 3  # either, own, url
    rows = verdicts(store)
    assert {k for k, r in rows.items() if r.classification == "open_source"} == {"mit", "either", "own", "far", "url"}
    assert enrichment.refresh_verdicts(store).metrics == {"rows_classified": 0}

    # a link that moves touches the URLs of before and of now
    edition("3", {}, {"isOsiApproved": True, "seeAlso": ["https://moved.example/l"]})
    assert enrichment.refresh_verdicts(store).metrics["rows_classified"] == 5 - 1  # either, own, url, other
    rows = verdicts(store)
    assert (rows["url"].classification, rows["other"].classification) == ("unknown", "open_source")

    # a list that was there only while packages were judged counts too
    edition("4", {"isOsiApproved": False}, {"isOsiApproved": True, "seeAlso": ["https://moved.example/l"]})
    land(landing, 2, {"late": {"licenseExpression": "MIT"}})
    catalog.sync_catalog(store, *landing.sources())
    enrichment.classify_packages(store)
    assert verdicts(store)["late"].classification == "proprietary"
    edition("5", {}, {"isOsiApproved": True, "seeAlso": ["https://moved.example/l"]})
    enrichment.refresh_verdicts(store)
    again = {k: r.classification for k, r in verdicts(store).items()}
    assert again["late"] == "open_source"
    enrichment.classify_packages(store, all_packages=True)
    assert {k: r.classification for k, r in verdicts(store).items()} == again
