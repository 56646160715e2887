"""Pages, commits and lists that must fail or count, and not vanish."""

import json

import pytest
from pyspark.sql import functions as F

from landing import Landing, at, delete, details, license_list
from tidemark.functions.times import parse_instant
from tidemark.plans import catalog, licenses
from tidemark.plans.store import CommitConflict, rebased
from tidemark.streaming.catalog_stream import stream_pages

MIT = {"licenseId": "MIT", "name": "MIT", "isOsiApproved": True}


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path / "landing")


def names(store):
    return {r.package_id for r in catalog.stored_packages(store).select("package_id").collect()}


def page_files(landing):
    return sorted((landing.root / "pages").iterdir())


def test_a_page_that_has_not_landed_fails_the_run(store, landing):
    for minute, package in enumerate("abc", 1):
        landing.page([details(package, "1.0", at(minute))])
    gone = page_files(landing)[1]
    text = gone.read_text()
    gone.unlink()
    with pytest.raises(LookupError, match="not landed"):
        catalog.sync_catalog(store, *landing.sources())
    gone.write_text(text)
    catalog.sync_catalog(store, *landing.sources())
    assert names(store) == {"a", "b", "c"}


def test_a_page_cut_short_fails_the_run(store, landing):
    landing.page([details("a", "1.0", at(1)), details("b", "1.0", at(1))])
    page = page_files(landing)[0]
    page.write_text(page.read_text()[:-40])
    with pytest.raises(LookupError):
        catalog.sync_catalog(store, *landing.sources())


def test_pages_without_an_id_take_the_landed_url(spark, store, landing):
    url = landing.page([details("a", "1.0", at(1))])
    page = page_files(landing)[0]
    body = json.loads(page.read_text())
    del body["@id"]
    page.write_text(json.dumps(body))
    index, _, leaves = landing.sources()
    with pytest.raises(LookupError):
        catalog.sync_catalog(store, *landing.sources())
    catalog.sync_catalog(store, index, lambda pages: landing.read("pages").withColumn("url", F.lit(url)), leaves)
    assert names(store) == {"a"}


def test_an_index_entry_without_a_readable_commit_fails_the_run(store, landing):
    landing.page([details("a", "1.0", at(1))])
    landing.page([details("b", "1.0", at(2))], commit="soon")
    with pytest.raises(ValueError, match="readable commit"):
        catalog.sync_catalog(store, *landing.sources())


def test_pages_of_one_commit_are_taken_together(store, landing):
    for package in "ab":
        landing.page([details(package, "1.0", at(1))])
    landing.page([details("c", "1.0", at(2))])
    first = catalog.sync_catalog(store, *landing.sources(), max_pages=1)
    assert (first.pages, first.metrics["pages_remaining"]) == (2, 1)
    catalog.sync_catalog(store, *landing.sources(), max_pages=1)
    assert names(store) == {"a", "b", "c"}


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_landed_days_are_utc(spark, tmp_path, zone):
    for day in ("2024-05-01", "2024-05-02"):
        folder = tmp_path / "pages" / f"day={day}"
        folder.mkdir(parents=True)
        (folder / "p.json").write_text(day)
    commits = spark.createDataFrame([("2024-05-01T02:00:00Z",), ("2024-05-01T22:00:00Z",)], "t string")
    rows = commits.select(F.struct(parse_instant(F.col("t")).alias("commit_at")).alias("commit"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        found = catalog.landed_days(spark, str(tmp_path / "pages"), rows).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.value for r in found] == ["2024-05-01"]


def test_a_time_without_a_date_is_no_instant(spark):
    texts = spark.createDataFrame([("10:20:30",), ("T10:20:30Z",), ("2024-05-01",), ("2024-05-01T10:20:30+02:00",)], "t string")
    assert [r.v for r in texts.select(parse_instant(F.col("t")).isNull().alias("v")).collect()] == [True, True, False, False]


@pytest.mark.parametrize(
    "version,rows",
    [(None, [MIT]), ("3.9", [MIT, MIT]), ("3.9", [MIT, {"name": "no id"}])],
)
def test_a_faulty_license_list_fails(spark, store, tmp_path, version, rows):
    with pytest.raises(ValueError, match="license list"):
        licenses.sync_licenses(store, license_list(spark, tmp_path / "l", version, rows), floors=())
    assert licenses.license_ref(store).count() == 0


def test_two_editions_at_once_fail(spark, store, tmp_path):
    both = license_list(spark, tmp_path / "l", "3.9", [MIT]).union(license_list(spark, tmp_path / "l", "3.10", [MIT]))
    with pytest.raises(ValueError, match="2 versions"):
        licenses.sync_licenses(store, both, floors=())


def test_errors_are_stored_whole(store):
    from tidemark.plans.store import run_job

    def work(before, run):
        raise RuntimeError("x" * 5000)

    with pytest.raises(RuntimeError):
        run_job(store, "job", work)
    assert store.runs().filter("status = 'failed'").first().error_message.count("x") == 5000


def during(monkeypatch, store, happens):
    """Lets something happen once, in the middle of the next bucketed write."""
    write, left = store.write_bucketed, [happens]

    def meanwhile(*args):
        if left:
            left.pop()()
        write(*args)

    monkeypatch.setattr(store, "write_bucketed", meanwhile)


def test_a_sync_inside_a_fold_is_kept(store, landing, monkeypatch):
    landing.page([details("a", "1.0", at(1))])
    catalog.sync_catalog(store, *landing.sources())
    landing.page([details("b", "1.0", at(2))])
    during(monkeypatch, store, lambda: catalog.sync_catalog(store, *landing.sources()))
    catalog.fold_catalog(store)
    assert names(store) == {"a", "b"}
    assert store.checkpoint(catalog.SOURCE).watermark == at(2)
    catalog.fold_catalog(store)
    assert names(store) == {"a", "b"}


def test_a_sync_inside_a_backfill_is_kept(store, landing, monkeypatch):
    landing.page([details("a", "1.0", at(1))])
    catalog.sync_catalog(store, *landing.sources())
    catalog.fold_catalog(store)
    landing.page([details("b", "1.0", at(2)), delete("a", "1.0", at(2))])
    during(monkeypatch, store, lambda: catalog.sync_catalog(store, *landing.sources()))
    index, pages, _ = landing.sources()
    assert catalog.backfill_deletes(store, index, pages).deleted == 1
    assert names(store) == {"a", "b"}
    gone = catalog.version_state(store).filter("deleted_at is not null").select("package_id").collect()
    assert [r.package_id for r in gone] == ["a"]


def test_a_fold_inside_a_fold_fails_the_later_one(store, landing, monkeypatch):
    landing.page([details("a", "1.0", at(1))])
    catalog.sync_catalog(store, *landing.sources())
    during(monkeypatch, store, lambda: catalog.fold_catalog(store))
    with pytest.raises(CommitConflict):
        catalog.fold_catalog(store)
    assert names(store) == {"a"}


def test_a_backfill_needs_its_pages(store, landing):
    landing.page([details("a", "1.0", at(1))])
    catalog.sync_catalog(store, *landing.sources())
    page_files(landing)[0].unlink()
    index, pages, _ = landing.sources()
    with pytest.raises(LookupError, match="not landed"):
        catalog.backfill_deletes(store, index, pages)


def test_folders_change_from_where_they_stand():
    log, table = "catalog_log", "version_state"
    assert rebased({log: ["a"]}, {log: ["a", "b"]}, {log: ["c"]}) == {log: ["c", "b"]}
    assert rebased({log: ["a"]}, {log: [], table: ["t"]}, {log: ["a", "b"]}) == {log: ["b"], table: ["t"]}
    assert rebased({table: ["t"]}, {table: ["u"]}, {table: ["t"], log: ["a"]}) == {table: ["u"], log: ["a"]}
    with pytest.raises(CommitConflict):
        rebased({table: ["t"]}, {table: ["u"]}, {table: ["v"]})


def test_a_page_cut_short_fails_the_stream(store, landing, tmp_path):
    landing.page([details("a", "1.0", at(1))])
    page = page_files(landing)[0]
    whole = page.read_text()
    page.write_text(whole[:-40])

    def run():
        stream = stream_pages(store, str(landing.root / "pages"), lambda refs: landing.read("leaves"), str(tmp_path / "offsets"))
        stream.awaitTermination()

    with pytest.raises(Exception, match="not readable"):
        run()
    assert names(store) == set()
    page.write_text(whole)
    run()
    assert names(store) == {"a"}
