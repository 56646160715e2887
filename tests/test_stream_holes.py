"""The stream's watermark stays before pages that have not landed."""

import random

import pytest
from landing import Landing, at, details
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.times import commit_key
from tidemark.operators.cursors import low_watermark
from tidemark.plans import catalog
from tidemark.plans.store import Store
from tidemark.streaming.catalog_stream import AHEAD, stream_pages


def pages_of(spark, rows):
    rows = spark.createDataFrame(rows, "page_url string, text string")
    return rows.select("page_url", commit_key(F.col("text")).alias("commit"))


def test_low_watermark(spark):
    index = pages_of(spark, [("a", at(1)), ("b", at(2)), ("c", at(2)), ("d", at(3)), ("e", at(4))])

    def low(*read):
        return low_watermark(index, pages_of(spark, list(read)))

    a, b, c, d, e = ("a", at(1)), ("b", at(2)), ("c", at(2)), ("d", at(3)), ("e", at(4))
    assert low(b, c, d, e) is None
    assert low(a, c, d, e) == at(1)  # b and c have one commit
    assert low(a, a, b, c, e) == at(2)
    assert low(a, b, c, d, ("e", at(3))) == at(3)  # e has grown since
    assert low(a, b, c, d, e, ("x", at(9)), ("e", at(3))) == at(4)


def test_low_watermark_of_nothing(spark):
    empty = spark.createDataFrame([], "page_url string, commit struct<commit_at: timestamp, commit_text: string>")
    assert low_watermark(empty, empty) is None
    assert low_watermark(pages_of(spark, [("a", at(1))]), empty) is None


def test_low_watermark_plain(spark):
    rng = random.Random(2)
    for _ in range(3):
        rows = [(f"p{i}", at(rng.randrange(12))) for i in range(20)]
        read = [r for r in rows if rng.random() < 0.85]
        hole = min((t for u, t in rows if (u, t) not in read), default="~")
        want = max((t for _, t in rows if t < hole), default=None)
        assert low_watermark(pages_of(spark, rows), pages_of(spark, read)) == want


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path / "land")


def test_late_page(spark, landing, tmp_path):
    """A page that lands two runs late: the watermark waits for it, the other pages do not."""
    store = Store(spark, str(tmp_path / "store"))
    index, _, leaves_for = landing.sources()
    for minute in (1, 2, 3):
        landing.page([details("A", f"{minute}.0", at(minute))], name=str(minute))
    late = (landing.root / "pages" / "2.json").read_text()
    (landing.root / "pages" / "2.json").unlink()

    def run():
        stream_pages(
            store, str(landing.root / "pages"), leaves_for, str(tmp_path / "cp"), files_per_batch=1, index=lambda: landing.read("index")
        ).awaitTermination()
        state = store.checkpoint(catalog.SOURCE)
        ahead = store.read(AHEAD, state.folders[AHEAD], schemas.PAGES_READ)
        return state.watermark, sorted(r.commit.commit_text for r in ahead.collect())

    def versions():
        return sorted(r.version for r in catalog.version_state(store).collect())

    assert run() == (at(1), [at(3)])
    landing.page([details("A", "4.0", at(4))], name="4")
    assert run() == (at(1), [at(3), at(4)])
    assert versions() == ["1.0", "3.0", "4.0"]
    (landing.root / "pages" / "2b.json").write_text(late)
    assert run() == (at(4), [])
    assert versions() == ["1.0", "2.0", "3.0", "4.0"]
    other = Store(spark, str(tmp_path / "batch"))
    (landing.root / "pages" / "2.json").write_text(late)
    catalog.sync_catalog(other, *landing.sources())
    ours, theirs = (catalog.version_state(s).drop("synced_at") for s in (store, other))
    assert ours.exceptAll(theirs).count() == 0 == theirs.exceptAll(ours).count()


def test_batch_after_a_stream_with_a_hole(spark, landing, tmp_path):
    """A batch job takes up before the hole; what it reads a second time changes nothing."""
    store = Store(spark, str(tmp_path / "store"))
    for minute in (1, 2, 3):
        landing.page([details("A", f"{minute}.0", at(minute))], name=str(minute))
    late = (landing.root / "pages" / "2.json").read_text()
    (landing.root / "pages" / "2.json").unlink()
    stream_pages(
        store, str(landing.root / "pages"), landing.sources()[2], str(tmp_path / "cp"), index=lambda: landing.read("index")
    ).awaitTermination()
    with pytest.raises(LookupError):
        catalog.sync_catalog(store, *landing.sources())
    (landing.root / "pages" / "2.json").write_text(late)
    assert catalog.sync_catalog(store, *landing.sources()).pages == 2
    assert sorted(r.version for r in catalog.version_state(store).collect()) == ["1.0", "2.0", "3.0"]
    assert store.checkpoint(catalog.SOURCE).watermark == at(3)
