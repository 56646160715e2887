"""Catalog and license-list documents, written by Spark from the tables and read back.

Each event becomes one page document and each details event one leaf; days are
the catalog's pages.  A few leaves are unusable or missing on purpose.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from contextlib import suppress
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.times import commit_key
from tidemark.operators.events import current_state
from tidemark.operators.licenses import list_profile
from tidemark.operators.quality import BlockingCheckFailed, approved_floor, row_floor
from tidemark.operators.versions import package_changes, version_changes
from tidemark.plans import catalog, enrichment
from tidemark.plans import licenses as list_refresh
from tidemark.plans.store import Store
from tidemark.plans.workload.registry import query, table
from tidemark.plans.workload.standins import licenses
from tidemark.session import shared_dir
from tidemark.sources import (
    catalog_events,
    parse_index,
    parse_leaves,
    parse_license_list,
    parse_pages,
    rejected,
)
from tidemark.sources.catalog import page_states
from tidemark.streaming.catalog_stream import AHEAD, stream_pages

_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

# The same events in SQL; ``problem`` says what is wrong with a leaf.
_EVENTS = r"""ev AS (
  SELECT event_id, user_id, ts, value, event_type = 'error' AS gone,
         concat('https://c.example/leaf/', CAST(event_id AS VARCHAR)) AS leaf_url,
         concat('pkg.', CAST(user_id AS VARCHAR)) AS package_id,
         concat(json_extract_string(props, '$.k'), '.0-r1') AS version,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         concat(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), 'Z') AS commit_text,
         concat('https://c.example/page/', CAST(CAST(ts AS DATE) AS VARCHAR)) AS page_url,
         CASE WHEN event_type = 'error' THEN NULL WHEN value < 2 THEN 'missing_leaf'
              WHEN value < 4 THEN 'unreadable' WHEN value < 6 THEN 'missing_field'
              WHEN value < 8 THEN 'bad_published' END AS problem
  FROM events)"""


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    # a scan task takes a row group, whose events are many times their size as documents
    spread = table(spark, sf_dir, "events").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "event_id", "ts")
    return spread.select(
        "event_id",
        "value",
        k.cast("int").alias("k"),
        F.concat(F.lit("https://c.example/leaf/"), F.col("event_id").cast("string")).alias("url"),
        F.concat(F.lit("pkg."), F.col("user_id").cast("string")).alias("id"),
        F.concat(k, F.lit(".0-r1")).alias("version"),
        F.date_format("ts", _ISO).alias("commit"),
        F.to_date("ts").alias("day"),
        F.concat(
            F.lit("nuget:"),
            F.when(F.col("event_type") == "error", F.lit("PackageDelete")).otherwise(
                F.lit("PackageDetails")
            ),
        ).alias("type"),
    )


def _page_url(day: str = "day"):
    return F.concat(F.lit("https://c.example/page/"), F.col(day).cast("string"))


def _index_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _events(spark, sf_dir).groupBy("day").agg(F.max("commit").alias("commit"))
    item = F.struct(_page_url().alias("@id"), F.col("commit").alias("commitTimeStamp"))
    return days.select(
        F.to_json(
            F.struct(F.col("commit").alias("commitTimeStamp"), F.array(item).alias("items"))
        ).alias("value")
    )


def _page_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(
        F.col("url").alias("@id"),
        F.col("type").alias("@type"),
        F.col("commit").alias("commitTimeStamp"),
        F.col("id").alias("nuget:id"),
        F.col("version").alias("nuget:version"),
    )
    page = F.struct(
        _page_url().alias("@id"),
        F.concat(F.col("day").cast("string"), F.lit("T23:59:59.999999Z")).alias("commitTimeStamp"),
        F.array(item).alias("items"),
    )
    return _events(spark, sf_dir).select(F.to_json(page).alias("value"))


def _leaf_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = _events(spark, sf_dir).filter("type <> 'nuget:PackageDelete' AND value >= 2")
    k = F.col("k")
    alternate = F.when(k % 6 == 0, F.struct(F.concat(F.lit("alt."), k.cast("string")).alias("id")))
    block = F.struct(
        F.when(k % 9 == 0, F.array(F.lit("Legacy"), F.lit("Other"))).alias("reasons"),
        alternate.alias("alternatePackage"),
        F.when(k % 2 == 0, F.lit("moved on")).alias("message"),
    )
    body = F.struct(
        F.col("url").alias("@id"),
        "id",
        "version",
        F.when(F.col("value") >= 8, F.col("commit"))
        .when(F.col("value") >= 6, F.lit("some day"))
        .alias("published"),
        F.when(k % 4 > 0, k % 4 == 1).alias("listed"),
        F.when(k % 5 == 0, F.lit("MIT")).alias("licenseExpression"),
        F.when(k % 5 == 1, F.lit("https://p.example")).alias("projectUrl"),
        F.when(k % 3 == 0, block).alias("deprecation"),
        F.lit("not read").alias("title"),
    )
    text = F.to_json(body)
    cut = F.substring(text, F.lit(1), F.length(text) - 1)
    return details.select(
        F.when((F.col("value") < 4), cut).otherwise(text).alias("value"), "url", "day"
    )


@query(f"""WITH {_EVENTS}
SELECT page_url, 0 AS position, leaf_url, commit_text, package_id, version,
       CASE WHEN gone THEN 'nuget:PackageDelete' ELSE 'nuget:PackageDetails' END AS event_type,
       epoch_us(ts) AS commit_micros FROM ev""")
def catalog_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event references out of page documents."""
    refs = parse_pages(_page_documents(spark, sf_dir))
    return refs.select(
        "place.page_url",
        "place.position",
        "leaf_url",
        "commit.commit_text",
        "package_id",
        "version",
        "event_type",
        F.unix_micros("commit.commit_at").alias("commit_micros"),
    )


@query(f"""WITH {_EVENTS}
SELECT page_url, max(commit_text) AS commit_text FROM ev GROUP BY page_url""")
def catalog_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = parse_index(_index_documents(spark, sf_dir))
    return pages.select("page_url", "commit.commit_text")


_LEAF_COLUMNS = """CASE WHEN k % 4 = 0 THEN true ELSE k % 4 = 1 END AS listed,
  k % 3 = 0 AS deprecated, CASE WHEN k % 9 = 0 THEN 'Legacy,Other' END AS reasons,
  CASE WHEN k % 6 = 0 THEN concat('alt.', CAST(k AS VARCHAR)) END AS alternative_package,
  CASE WHEN k % 6 = 0 THEN 'moved on' END AS deprecation_message"""


def _flat_leaf_columns() -> list:
    return [
        "listed",
        "deprecated",
        F.array_join("deprecation_reasons", ",").alias("reasons"),
        "alternative_package",
        "deprecation_message",
    ]


@query(f"""WITH {_EVENTS}, leaf AS (
  SELECT *, coalesce(problem <> 'unreadable', true) AS readable FROM ev
  WHERE NOT gone AND coalesce(problem <> 'missing_leaf', true))
SELECT leaf_url, problem, CASE WHEN readable THEN package_id END AS leaf_id,
  CASE WHEN readable THEN version END AS leaf_version,
  CASE WHEN readable AND k % 5 = 0 THEN 'MIT' END AS license_expression,
  CASE WHEN readable AND k % 5 = 1 THEN 'https://p.example' END AS project_url,
  CASE WHEN problem IS NULL THEN epoch_us(ts) END AS published_micros,
  CASE WHEN readable THEN k % 4 IN (0, 1) END AS listed,
  CASE WHEN readable AND k % 9 = 0 THEN 'Legacy,Other' END AS reasons,
  CASE WHEN readable AND k % 6 = 0 THEN concat('alt.', CAST(k AS VARCHAR)) END
    AS alternative_package
FROM leaf""")
def catalog_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves with their problem; absent flags take their defaults.

    Fields of unreadable leaves are left out, as a cut text may hold some of them.
    """
    leaves = parse_leaves(_leaf_documents(spark, sf_dir))
    readable = F.coalesce(F.col("problem") != "unreadable", F.lit(True))
    usable = F.col("problem").isNull()
    return leaves.select(
        "leaf_url",
        "problem",
        *[
            F.when(readable, F.col(c)).alias(c)
            for c in (
                "leaf_id",
                "leaf_version",
                "license_expression",
                "project_url",
                "listed",
                "alternative_package",
            )
        ],
        F.when(usable, F.unix_micros("published_at")).alias("published_micros"),
        F.when(readable, F.array_join("deprecation_reasons", ",")).alias("reasons"),
    )


def _applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = parse_pages(_page_documents(spark, sf_dir))
    leaves = parse_leaves(_leaf_documents(spark, sf_dir))
    return catalog_events(refs, leaves).withColumn(
        "synced_at", F.lit("2024-06-01").cast("timestamp")
    )


@query(f"""WITH {_EVENTS}
SELECT leaf_url, package_id, version, problem AS reason FROM ev WHERE problem IS NOT NULL""")
def catalog_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References that could not be applied, with the reason."""
    return rejected(_applied(spark, sf_dir)).select("leaf_url", "package_id", "version", "reason")


_VERSION_ROWS = f"""WITH {_EVENTS},
d AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY package_id, version ORDER BY ts DESC) AS rk
  FROM ev WHERE NOT gone AND problem IS NULL) AS r WHERE rk = 1),
x AS (SELECT package_id, version, max(ts) AS gone_at FROM ev WHERE gone GROUP BY 1, 2)
SELECT d.package_id, d.version, concat('pkg:nuget/', d.package_id, '@', d.version) AS purl,
  k AS major, 0 AS minor, CAST(NULL AS INTEGER) AS patch, 'r1' AS prerelease,
  epoch_us(ts) AS published_micros, {_LEAF_COLUMNS},
  CASE WHEN gone_at >= ts THEN epoch_us(gone_at) END AS deleted_micros
FROM d LEFT JOIN x ON x.package_id = d.package_id AND x.version = d.version"""


def _flat_versions(versions: DataFrame, deleted_at: str) -> DataFrame:
    return versions.select(
        "package_id",
        "version",
        "purl",
        "major",
        "minor",
        "patch",
        "prerelease",
        F.unix_micros("published_at").alias("published_micros"),
        *_flat_leaf_columns(),
        F.unix_micros(deleted_at).alias("deleted_micros"),
    )


@query(_VERSION_ROWS)
def catalog_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version rows from documents in one pass."""
    state = current_state(version_changes(_applied(spark, sf_dir)))
    return _flat_versions(state, "deleted_at.commit_at")


@query(f"""WITH {_EVENTS}
SELECT package_id, version AS latest_version, epoch_us(ts) AS published_micros,
  CASE WHEN k % 5 = 0 THEN 'MIT' END AS license,
  CASE WHEN k % 5 = 1 THEN 'https://p.example' END AS project_url FROM (
  SELECT *, row_number() OVER (PARTITION BY package_id ORDER BY ts DESC) AS rk
  FROM ev WHERE NOT gone AND problem IS NULL) AS r WHERE rk = 1""")
def catalog_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Package rows from documents; deletes leave them alone."""
    state = current_state(package_changes(_applied(spark, sf_dir)))
    return state.select(
        "package_id",
        "latest_version",
        F.unix_micros("source_updated_at").alias("published_micros"),
        "license",
        "project_url",
    )


@query(_VERSION_ROWS)
def catalog_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job on stored tables: half the pages, a fold, then the rest."""
    store = Store(spark, shared_dir(spark, "catalog-job"))
    index = _index_documents(spark, sf_dir)

    def pages_for(pages: DataFrame) -> DataFrame:
        return _page_documents(spark, sf_dir)

    def leaves_for(refs: DataFrame) -> DataFrame:
        return _leaf_documents(spark, sf_dir)

    catalog.sync_catalog(store, index, pages_for, leaves_for, max_pages=15)
    catalog.fold_catalog(store)
    catalog.sync_catalog(store, index, pages_for, leaves_for)
    return _flat_versions(catalog.version_state(store), "deleted_at")


def _job(spark: SparkSession, sf_dir: str, name: str) -> tuple[Store, Callable[..., object]]:
    """A store and a sync of the catalog's documents into it."""
    store, index = Store(spark, shared_dir(spark, name)), _index_documents(spark, sf_dir)

    def sync(max_pages: int | None = None) -> object:
        return catalog.sync_catalog(
            store, index, lambda pages: _page_documents(spark, sf_dir), lambda refs: _leaf_documents(spark, sf_dir), max_pages
        )

    return store, sync


@query(_VERSION_ROWS)
def fold_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job with folds that rewrite the buckets which their log touches: the last one page, so few of them."""
    store, sync = _job(spark, sf_dir, "fold-touched")
    for pages in (14, 1, None):
        sync(pages)
        catalog.fold_catalog(store, buckets=16, only_touched=True)
    return _flat_versions(catalog.version_state(store), "deleted_at")


# A heartbeat after every ten pages; a run's last row repeats the last one as completed.
@query(f"""WITH {_EVENTS},
placed AS (SELECT *, (dense_rank() OVER (ORDER BY page_url) - 1) // 10 AS slice FROM ev),
slices AS (
  SELECT slice, count(DISTINCT page_url) AS pages, max(commit_text) AS watermark,
    count(DISTINCT (package_id, version)) FILTER (NOT gone AND problem IS NULL) AS versions,
    count(DISTINCT package_id) FILTER (NOT gone AND problem IS NULL) AS packages,
    count(DISTINCT (package_id, version)) FILTER (gone) AS deletes FROM placed GROUP BY slice),
beats AS (
  SELECT slice, watermark, sum(versions) OVER w AS versions, sum(packages) OVER w AS packages, sum(deletes) OVER w AS deletes, sum(pages) OVER w AS pages
  FROM slices WINDOW w AS (ORDER BY slice)),
rows_ AS (
  SELECT 'running' AS status, 0 AS v, 0 AS p, 0 AS d, 0 AS pages, NULL AS watermark
  UNION ALL SELECT 'running', versions, packages, deletes, pages, watermark FROM beats
  UNION ALL SELECT 'completed', versions, packages, deletes, pages, watermark FROM beats WHERE slice = (SELECT max(slice) FROM beats))
SELECT status, v::BIGINT AS rows_inserted, p::BIGINT AS rows_updated, d::BIGINT AS rows_deleted, pages::INTEGER AS pages_processed, watermark AS watermark_after
FROM rows_""")
def run_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ledger row of one sync in slices: it opens, reports after each slice, and settles."""
    store, index = Store(spark, shared_dir(spark, "run-progress")), _index_documents(spark, sf_dir)
    catalog.sync_catalog(
        store, index, lambda pages: _page_documents(spark, sf_dir), lambda refs: _leaf_documents(spark, sf_dir), slice_pages=10
    )
    return store.run_events().select("status", "rows_inserted", "rows_updated", "rows_deleted", "pages_processed", "watermark_after")


# Only what a fold had stored is marked, by all pages, whatever was published after.
@query(f"""WITH {_EVENTS},
d AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY package_id, version ORDER BY ts DESC) AS rk
  FROM ev WHERE NOT gone AND problem IS NULL) AS r WHERE rk = 1),
x AS (SELECT package_id, version, max(ts) AS gone_at FROM ev WHERE gone GROUP BY 1, 2)
SELECT d.package_id, d.version, epoch_us(gone_at) AS deleted_micros
FROM d LEFT JOIN x ON x.package_id = d.package_id AND x.version = d.version""")
def backfill_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delete backfill on stored tables, in two runs: deletes of all pages mark the rows that exist."""
    store, sync = _job(spark, sf_dir, "backfill-job")
    sync()
    for limit in (9, None):
        catalog.backfill_deletes(store, _index_documents(spark, sf_dir), lambda pages: _page_documents(spark, sf_dir), limit)
    return catalog.version_state(store).select("package_id", "version", F.unix_micros("deleted_at").alias("deleted_micros"))


@query(_VERSION_ROWS)
def catalog_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming form, over landed files and leaves kept by day."""
    root = shared_dir(spark, "catalog-stream")
    pages = _page_documents(spark, sf_dir)
    pages.write.text(f"{root}/pages")
    leaves = _leaf_documents(spark, sf_dir)
    leaves.select("value", "day").write.partitionBy("day").text(f"{root}/leaves")
    store = Store(spark, f"{root}/store")
    query = stream_pages(
        store,
        f"{root}/pages",
        lambda refs: catalog.landed_days(spark, f"{root}/leaves", refs),
        f"{root}/offsets",
        one_per_file=False,
    )
    query.awaitTermination()
    return _flat_versions(catalog.version_state(store), "deleted_at")


_LATE_DAY = 17  # of the month; its pages land after all others


@query(f"""WITH {_EVENTS}, page AS (
  SELECT page_url, CAST(max(ts) AS DATE) + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND AS last_ts,
    day(any_value(ts)) = {_LATE_DAY} AS is_late FROM ev GROUP BY page_url),
hole AS (SELECT coalesce(min(last_ts), TIMESTAMP '9999-01-01') AS first_ts FROM page WHERE is_late)
SELECT 1 AS run, (SELECT epoch_us(max(last_ts)) FROM page, hole WHERE last_ts < first_ts) AS watermark_micros,
  (SELECT count(*) FROM ev WHERE NOT gone AND day(ts) <> {_LATE_DAY}) AS details,
  (SELECT count(*) FROM page, hole WHERE NOT is_late AND last_ts > first_ts) AS pages_ahead
UNION ALL SELECT 2, (SELECT epoch_us(max(last_ts)) FROM page), (SELECT count(*) FROM ev WHERE NOT gone), 0""")
def stream_past_a_hole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream run twice, one day's pages landing between: watermark, applied or rejected details, and pages read ahead of it, after each run."""
    root = shared_dir(spark, "stream-hole")
    index = shared_dir(spark, "stream-hole-index")
    page = page_states(_page_documents(spark, sf_dir)).select("page_url", "commit.commit_text").distinct()
    items = F.array(F.struct(F.col("page_url").alias("@id"), F.col("commit_text").alias("commitTimeStamp")))
    page.select(F.to_json(F.struct(items.alias("items"))).alias("value")).write.text(index)
    leaves = _leaf_documents(spark, sf_dir)
    leaves.select("value", "day").write.partitionBy("day").text(f"{root}/leaves")
    late = F.get_json_object("value", "$.commitTimeStamp").substr(9, 2) == f"{_LATE_DAY:02d}"
    store, shown = Store(spark, f"{root}/store"), []
    for run, landing in ((1, ~late), (2, late)):
        _page_documents(spark, sf_dir).filter(landing).write.mode("append").text(f"{root}/pages")
        stream_pages(
            store, f"{root}/pages", lambda refs: catalog.landed_days(spark, f"{root}/leaves", refs), f"{root}/offsets",
            one_per_file=False, index=lambda: spark.read.text(index),
        ).awaitTermination()
        at = store.checkpoint(catalog.SOURCE)
        ahead = store.read(AHEAD, at.folders.get(AHEAD, []), schemas.PAGES_READ)
        micros = F.unix_micros(commit_key(F.lit(at.watermark))["commit_at"]).alias("watermark_micros")
        details = F.count_if(F.col("kind") != "delete").alias("details")
        n_ahead = F.lit(ahead.select("page_url").distinct().count()).cast("bigint").alias("pages_ahead")
        shown.append(catalog.catalog_log(store, at).agg(details).select(F.lit(run).alias("run"), micros, "details", n_ahead))
    return shown[0].unionByName(shown[1])


@query("""SELECT concat('Lic-', CAST(s_suppkey AS VARCHAR), '.0') AS license_id, s_name AS name,
  CASE WHEN s_nationkey < 20 THEN s_acctbal >= 3000 ELSE false END AS is_osi_approved,
  s_nationkey % 2 = 0 AS is_fsf_libre, false AS is_deprecated_id,
  CASE WHEN s_nationkey < 10 THEN
    concat('https://licenses.example.org/', CAST(s_suppkey AS VARCHAR)) END AS reference_url,
  CAST(1 + CASE WHEN s_nationkey % 3 <> 0 THEN 1 ELSE 0 END
         + CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 0 END AS INTEGER)
    * CASE WHEN s_nationkey >= 5 THEN 1 ELSE 0 END AS n_links,
  '3.10' AS list_version FROM supplier""")
def license_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses out of list documents; absent flags and links take their defaults."""
    return _license_documents(spark, sf_dir).select(
        "license_id",
        "name",
        "is_osi_approved",
        "is_fsf_libre",
        "is_deprecated_id",
        "reference_url",
        F.size("see_also_urls").alias("n_links"),
        "list_version",
    )


def _list_texts(
    spark: SparkSession, sf_dir: str, version: str = "3.10", approved: str = "is_osi_approved"
) -> DataFrame:
    nation = F.col("s_nationkey")
    entry = F.struct(
        F.col("license_id").alias("licenseId"),
        "name",
        F.when(nation < 20, F.expr(approved)).alias("isOsiApproved"),
        F.col("is_fsf_libre").alias("isFsfLibre"),
        F.when(nation < 10, F.col("reference_url")).alias("reference"),
        F.when(nation >= 5, F.col("see_also_urls")).alias("seeAlso"),
    )
    document = F.struct(F.lit(version).alias("licenseListVersion"), F.array(entry).alias("licenses"))
    return licenses(spark, sf_dir).select("license_id", F.to_json(document).alias("value"))


def _license_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_license_list(_list_texts(spark, sf_dir))


@query("""SELECT count(*) AS license_count,
  count(*) FILTER (WHERE s_nationkey < 20 AND s_acctbal >= 3000) AS osi_count FROM supplier""")
def license_list_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = list_profile(_license_documents(spark, sf_dir))
    return profile.select("license_count", "osi_count")


# In the later edition a seventh of the licenses is missing and approval is dealt anew.
@query("""SELECT license_id, name, CAST(approved AS BOOLEAN) AS is_osi_approved, approved = 'true' AS raw_approved,
  n_links FROM (
  SELECT concat('Lic-', CAST(s_suppkey AS VARCHAR), '.0') AS license_id, s_name AS name,
    CASE WHEN s_nationkey >= 20 THEN 'false'
         WHEN s_suppkey % 7 = 0 THEN CAST(s_acctbal >= 3000 AS VARCHAR)
         ELSE CAST(s_acctbal < 3000 AS VARCHAR) END AS approved,
    CAST(1 + CASE WHEN s_nationkey % 3 <> 0 THEN 1 ELSE 0 END
           + CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 0 END AS INTEGER)
      * CASE WHEN s_nationkey >= 5 THEN 1 ELSE 0 END AS n_links
  FROM supplier) AS l""")
def license_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refresh job on stored tables: an edition, the next one, and that one again with other flags."""
    store = Store(spark, shared_dir(spark, "license-job"))
    number = F.regexp_extract("license_id", r"(\d+)", 1).cast("long")
    list_refresh.sync_licenses(store, _list_texts(spark, sf_dir, "3.9"), floors=())
    later = _list_texts(spark, sf_dir, "3.10", "not is_osi_approved").filter(number % 7 != 0)
    list_refresh.sync_licenses(store, later, floors=())
    list_refresh.sync_licenses(store, _list_texts(spark, sf_dir, "3.10"), floors=())
    return list_refresh.license_ref(store).select(
        "license_id",
        "name",
        "is_osi_approved",
        (F.get_json_object("raw_metadata", "$.isOsiApproved") == "true").alias("raw_approved"),
        F.size("see_also_urls").alias("n_links"),
    )


# An edition that approves nothing lies below the floor: its run fails and the list before it stands.
@query("""WITH l AS (
  SELECT concat('Lic-', CAST(s_suppkey AS VARCHAR), '.0') AS license_id, s_nationkey < 20 AND s_acctbal >= 3000 AS approved,
    s_nationkey < 20 AND s_acctbal < 3000 AS other FROM supplier)
SELECT 'first' AS attempt, 'completed' AS status, '1' AS edition, license_id, approved AS is_osi_approved FROM l
UNION ALL SELECT 'second', 'failed', '1', license_id, approved FROM l
UNION ALL SELECT 'third', 'completed', '3', license_id, other FROM l""")
def gated_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list as it stands after each of three refreshes, the second of which misses the floor of approved licenses."""
    store = Store(spark, shared_dir(spark, "gated-refresh"))
    floors = (row_floor("license_ref_nonempty"), approved_floor(least=1))
    standing = []
    for attempt, version, approved in (("first", "1", "is_osi_approved"), ("second", "2", "false"), ("third", "3", "not is_osi_approved")):
        with suppress(BlockingCheckFailed):
            list_refresh.sync_licenses(store, _list_texts(spark, sf_dir, version, approved), floors)
        at = store.checkpoint(list_refresh.SOURCE)
        standing.append(
            list_refresh.license_ref(store, at).select(
                F.lit(attempt).alias("attempt"), F.lit(at.status).alias("status"), F.lit(at.watermark).alias("edition"),
                "license_id", "is_osi_approved",
            )
        )
    return reduce(DataFrame.union, standing)


@query(f"""WITH {_EVENTS},
p AS (SELECT package_id, k FROM (
  SELECT *, row_number() OVER (PARTITION BY package_id ORDER BY ts DESC) AS rk
  FROM ev WHERE NOT gone AND problem IS NULL) AS r WHERE rk = 1)
SELECT package_id, CASE WHEN k % 5 = 0 THEN 'proprietary' ELSE 'unknown' END AS classification,
  CASE WHEN k % 5 = 0 THEN 'none_approved: MIT' ELSE 'no_signal' END AS reasoning,
  (SELECT count(*) FROM p WHERE k % 5 = 0) AS judged_again FROM p""")
def verdict_refresh_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refresh job on stored tables: one license loses its approval, and the packages that name it are judged again."""
    store = Store(spark, shared_dir(spark, "verdict-refresh"))

    def edition(version: str, approved: bool) -> None:
        mit = {"licenseListVersion": version, "licenses": [{"licenseId": "MIT", "isOsiApproved": approved}]}
        texts = _list_texts(spark, sf_dir, version).select("value")
        list_refresh.sync_licenses(store, texts.union(spark.createDataFrame([(json.dumps(mit),)], "value string")), floors=())

    edition("1", True)
    catalog.sync_catalog(
        store, _index_documents(spark, sf_dir), lambda pages: _page_documents(spark, sf_dir), lambda refs: _leaf_documents(spark, sf_dir)
    )
    enrichment.classify_packages(store)
    enrichment.fold_verdicts(store)
    edition("2", False)
    judged = enrichment.refresh_verdicts(store).metrics["rows_classified"]
    return enrichment.license_verdicts(store).select(
        "package_id", "classification", "reasoning", F.lit(judged).cast("bigint").alias("judged_again")
    )


@query(f"""WITH {_EVENTS}
SELECT package_id, CASE WHEN k % 5 = 0 THEN 'open_source' ELSE 'unknown' END AS classification,
  CASE WHEN k % 5 = 0 THEN 'MIT' END AS spdx_id,
  CASE WHEN k % 5 = 0 THEN 'any_approved: MIT' ELSE 'no_signal' END AS reasoning FROM (
  SELECT *, row_number() OVER (PARTITION BY package_id ORDER BY ts DESC) AS rk
  FROM ev WHERE NOT gone AND problem IS NULL) AS r WHERE rk = 1""")
def enrich_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict job on stored tables, run after half the pages and again after the rest."""
    store = Store(spark, shared_dir(spark, "enrich-job"))
    mit = {"licenseListVersion": "1", "licenses": [{"licenseId": "MIT", "isOsiApproved": True}]}
    lists = _list_texts(spark, sf_dir, "1").select("value")
    list_refresh.sync_licenses(store, lists.union(spark.createDataFrame([(json.dumps(mit),)], "value string")), floors=())
    index = _index_documents(spark, sf_dir)
    for limit in (15, None):
        catalog.sync_catalog(
            store,
            index,
            lambda pages: _page_documents(spark, sf_dir),
            lambda refs: _leaf_documents(spark, sf_dir),
            max_pages=limit,
        )
        enrichment.classify_packages(store)
    return enrichment.license_verdicts(store).select(
        "package_id", "classification", "spdx_id", "reasoning"
    )
