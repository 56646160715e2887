"""Catalog jobs: ingest new pages, fold them into the state tables, mark deletes.

Ingest appends the events of new pages to a log, at a cost that follows the
batch and not the tables.  The tables are what the last fold stored plus the
log since; a fold rewrites them and empties the log.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.cursors import INITIAL
from tidemark.functions.times import commit_key
from tidemark.operators.events import after_watermark, current_state, first_pages
from tidemark.operators.merge import mark_deleted, merge_changes
from tidemark.operators.quality import BlockingCheckFailed, row_floor
from tidemark.operators.versions import (
    PACKAGE_KEYS,
    VERSION_KEYS,
    package_changes,
    version_changes,
)
from tidemark.plans.store import Checkpoint, Run, RunResult, Store, rebased, run_job
from tidemark.sources.catalog import (
    catalog_events,
    once,
    page_states,
    parse_index,
    parse_leaves,
    parse_pages,
    read_documents,
)

SOURCE = "catalog"
BACKFILL = "delete_backfill"
FOLD = "catalog_fold"  # a fold is no sync: it must not make the catalog look fresh
REFS = "catalog_refs"  # the references of a slice
LOG, VERSIONS, PACKAGES = "catalog_log", "version_state", "package_state"
SHOWN = 5  # pages that an error names
BUCKETS = "buckets"  # of the stored tables, beside their folders in the checkpoint
OF_BUCKET = "/bucket="  # in the name of a folder that holds one bucket
DELETES = "backfill_deletes"
FLOORS = (row_floor("nonempty"),)


def watermark_key(text: str) -> Column | None:
    return None if text == INITIAL else commit_key(F.lit(text))


def _newest() -> Column:
    """The next watermark: the last commit that can be read, of any kind of event."""
    readable = F.col("commit.commit_at").isNotNull()
    return F.max(F.when(readable, F.col("commit"))).alias("watermark")


def is_after(spark: SparkSession, commit: str, watermark: str) -> bool:
    """Whether a commit time lies after a watermark; never a comparison of texts."""
    if watermark == INITIAL:
        return True
    later = commit_key(F.lit(commit)) > commit_key(F.lit(watermark))
    return bool(spark.range(1).select(later.alias("later")).first().later)


def _refs_of(pages: DataFrame, page_documents: DataFrame) -> DataFrame:
    urls = pages.select(F.col("page_url").alias("_page"))
    refs = parse_pages(page_documents)
    # no entry lacks its URL; a plain equality would test the pages' own for null first and parse them twice
    return refs.join(urls, F.col("place.page_url").eqNullSafe(F.col("_page")), "left_semi")


def require_dated(pages: DataFrame) -> None:
    """Fails on index entries without a URL or a readable commit time: no run would ever read their pages."""
    bad = pages.filter(F.col("page_url").isNull() | F.col("commit.commit_at").isNull())
    named = [row.page_url for row in bad.select("page_url").limit(SHOWN).collect()]
    if named:
        raise ValueError(f"index entries without a URL or a readable commit time: {named}")


def require_landed(chosen: DataFrame, page_documents: DataFrame) -> None:
    """Fails if a chosen page has not landed or cannot be read, before the watermark passes it."""
    # a filter by `readable` would parse the pages twice, once where they are read
    whole = page_states(page_documents).select(F.when(F.col("readable"), F.col("page_url")).alias("_page")).distinct()
    missing = chosen.join(whole, F.col("page_url").eqNullSafe(F.col("_page")), "left_anti")
    named = [row.page_url for row in missing.select("page_url").limit(SHOWN).collect()]
    if named:
        raise LookupError(f"pages not landed or not readable: {named}")


def require_readable(page_documents: DataFrame) -> None:
    """Fails if any landed page cannot be read whole; blank lines are no pages."""
    bad = page_states(page_documents.filter(F.trim("value") != "")).filter(~F.col("readable"))
    named = [row.page_url for row in bad.select("page_url").limit(SHOWN).collect()]
    if named:
        raise LookupError(f"pages not readable: {named}")


Pages = Callable[[DataFrame], DataFrame]
Leaves = Callable[[DataFrame], DataFrame]


def landed_days(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Documents landed in folders ``day=YYYY-MM-DD`` by their commit, one per line.

    Reads the days of the given rows only.  The list of days is bounded by the
    calendar, not by the batch.
    """
    # the folders' days are UTC, whatever the session's zone is
    since = F.expr("unix_micros(commit.commit_at) div 86400000000")
    day = F.when(since.isNotNull(), F.date_from_unix_date(since.cast("int"))).cast("string")
    days = [row.day for row in rows.select(day.alias("day")).distinct().collect()]
    documents = read_documents(spark, path, one_per_file=False)
    return documents.filter(F.col("day").cast("string").isin(days)).drop("day")


def append_events(store: Store, name: str, refs: DataFrame, leaves: DataFrame) -> dict:
    """Writes one batch to the log and returns what the pass observed."""
    events = catalog_events(refs, leaves).withColumn("synced_at", F.current_timestamp())
    seen = Observation()
    kind = F.col("kind")
    observed = events.observe(
        seen,
        _newest(),
        F.count_if(kind == "details").alias("details"),
        F.count_if(kind == "delete").alias("deletes"),
        F.count_if(kind == "reject").alias("rejects"),
    )
    store.write(LOG, name, observed.select(*schemas.CATALOG_LOG.names))
    return seen.get


def written(store: Store, name: str) -> dict[str, int]:
    """What one slice of the log brings: versions and packages written, and versions whose delete was attempted."""
    log, kind = store.read(LOG, [name], schemas.CATALOG_LOG), F.col("kind")
    version = F.struct(*VERSION_KEYS)
    counted = log.agg(
        F.count_distinct(F.when(kind == "details", version)).alias("versions"),
        F.count_distinct(F.when(kind == "details", F.col("package_id"))).alias("packages"),
        F.count_distinct(F.when(kind == "delete", version)).alias("deletes_attempted"),
    )
    return counted.first().asDict()


def sync_catalog(
    store: Store,
    index_documents: DataFrame,
    pages_for: Pages,
    leaves_for: Leaves,
    max_pages: int | None = None,
    external_run_id: str | None = None,
    slice_pages: int | None = None,
) -> RunResult:
    """Ingests the pages committed after the checkpoint, whole pages at a time.

    ``pages_for`` returns page documents holding at least the given pages, and
    ``leaves_for`` leaf documents holding those of the given references, so a run
    need not read the whole landing area (see ``landed_days``).

    With ``slice_pages`` a long run goes in slices of so many pages: each one is
    committed and followed by a heartbeat, so its progress can be seen while the
    run lasts and survives its end.  A run counts the versions and packages that
    its slices write (inserted, updated) and the deletes they attempt.
    """

    def work(before: Checkpoint, run: Run) -> RunResult:
        pages = parse_index(index_documents)
        require_dated(pages)
        new = after_watermark(pages, F.col("commit"), watermark_key(before.watermark))
        left = new.count()
        if left == 0:
            return RunResult(before.watermark, before.folders, metrics={"pages_remaining": 0})
        at, folders, totals, done = before.watermark, before.folders, Counter(), 0
        while done < left and (max_pages is None or done < max_pages):
            sizes = [n for n in (slice_pages, None if max_pages is None else max_pages - done) if n is not None]
            chosen = first_pages(new, "commit", min(sizes, default=None))
            taken = chosen.agg(F.count(F.lit(1)).alias("n"), F.max("commit").alias("last")).first()
            landed = pages_for(chosen)
            require_landed(chosen, landed)
            name = run.id if slice_pages is None else f"{run.id}-{len(folders.get(LOG, []))}"
            # read for the leaves' days and again for the events, but parsed once
            refs = _refs_of(chosen, landed)
            store.write(REFS, name, refs)
            refs = store.read(REFS, [name], refs.schema)
            seen = append_events(store, name, refs, parse_leaves(leaves_for(refs)))
            newest = seen.pop("watermark")
            totals.update({**seen, **written(store, name)})
            done += taken.n
            at = at if newest is None else newest.commit_text
            folders = {**folders, LOG: [*folders.get(LOG, []), name]}
            if slice_pages is not None:
                store.commit(SOURCE, at, rebased(before.folders, folders, store.checkpoint(SOURCE).folders), "running", _rows_of(totals))
                run.heartbeat(totals["versions"], totals["packages"], totals["deletes_attempted"], done, at)
            new = after_watermark(pages, F.col("commit"), commit_key(F.lit(taken.last.commit_text)))
        return RunResult(
            at,
            folders,
            status="completed" if done == left else "partial",
            inserted=totals["versions"],
            updated=totals["packages"],
            deleted=totals["deletes_attempted"],
            pages=done,
            metrics={**totals, "watermark": at, "pages_remaining": left - done},
        )

    return run_job(store, SOURCE, work, external_run_id)


def _rows_of(totals: Counter) -> int:
    return totals["versions"] + totals["packages"] + totals["deletes_attempted"]


# --- tables ------------------------------------------------------------------


def catalog_log(store: Store, at: Checkpoint | None = None) -> DataFrame:
    at = at or store.checkpoint(SOURCE)
    return store.read(LOG, at.folders.get(LOG, []), schemas.CATALOG_LOG)


def _merged(store: Store, at: Checkpoint, table: str, schema, keys, changes: DataFrame) -> DataFrame:
    stored = at.folders.get(table, [])
    columns = schema.names
    if not at.folders.get(LOG):
        return store.read(table, stored, schema)
    if not stored:
        return current_state(changes).select(*columns)
    return merge_changes(store.read(table, stored, schema), changes, keys).select(*columns)


def stored_versions(store: Store, at: Checkpoint | None = None) -> DataFrame:
    at = at or store.checkpoint(SOURCE)
    changes = version_changes(catalog_log(store, at))
    return _merged(store, at, VERSIONS, schemas.VERSION_STATE, VERSION_KEYS, changes)


def stored_packages(store: Store, at: Checkpoint | None = None) -> DataFrame:
    at = at or store.checkpoint(SOURCE)
    changes = package_changes(catalog_log(store, at))
    return _merged(store, at, PACKAGES, schemas.PACKAGE_STATE, PACKAGE_KEYS, changes)


def _public(state: DataFrame) -> DataFrame:
    return state.withColumn("deleted_at", F.col("deleted_at.commit_at")).drop("details_at")


def version_state(store: Store) -> DataFrame:
    return _public(stored_versions(store))


def package_state(store: Store) -> DataFrame:
    return _public(stored_packages(store))


def rejects(store: Store) -> DataFrame:
    """Events of the log that could not be applied, with the reason."""
    return catalog_log(store).filter(F.col("kind") == "reject").select(
        "leaf_url", "package_id", "version", "commit", "reason"
    )


# --- storing the tables ---------------------------------------------------------


def _buckets(store: Store, at: Checkpoint, wanted: int | None) -> int:
    default = store.spark.conf.get("spark.sql.shuffle.partitions")
    return wanted or int(at.folders.get(BUCKETS, [default])[0])


def _by_bucket(names: list[str]) -> dict[int, str]:
    """The folder of each bucket, where a table is stored bucket by bucket; empty where it is stored whole."""
    return {int(name.partition(OF_BUCKET)[2]): name for name in names if OF_BUCKET in name}


def _bucket(n: int) -> Column:
    """All versions of a package are in one bucket, in either table."""
    return F.pmod(F.xxhash64("package_id"), F.lit(n)).cast("int")


def _fold_table(
    store: Store, at: Checkpoint, name: str, table: str, schema, keys, changes: DataFrame, n: int
) -> None:
    """Stores one table anew, bucketed by key.

    The stored table is bucketed already, so only the log is shuffled.
    """
    stored = at.folders.get(table, [])
    if stored and at.folders[BUCKETS] == [str(n)] and not _by_bucket(stored):
        with store.bucketed(table, stored[0], schema, keys, n) as target:
            store.write_bucketed(table, name, merge_changes(target, changes, keys), keys, n, FLOORS)
        return
    rows = current_state(changes).select(*schema.names)
    if stored:
        rows = merge_changes(store.read(table, stored, schema), changes, keys)
    store.write_bucketed(table, name, rows.repartition(n, *keys), keys, n, FLOORS)


def rewritten_buckets(
    store: Store, name: str, table: str, schema, stored: list[str], changes: DataFrame, n: int,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
) -> list[str]:
    """Merges changes into the buckets that they touch; returns the folders of all buckets.

    A touched bucket is written beside the old one and named instead of it.
    The files of the others are neither read nor written.
    """
    held, in_bucket = _by_bucket(stored), _bucket(n)
    # at most one row for each bucket
    touched = {row.bucket for row in changes.select(in_bucket.alias("bucket")).distinct().collect()}
    if stored and not held:
        target, touched = store.read(table, stored, schema), set(range(n))  # stored whole so far
    else:
        target = store.read(table, [held[b] for b in sorted(touched & held.keys())], schema)
    merged = merge(target, changes).select(*schema.names, in_bucket.alias("bucket"))
    store.write_partitioned(table, name, merged.repartition(n, "bucket"), "bucket")
    made = store.partitions(table, name, "bucket")
    return [f"{name}{OF_BUCKET}{b}" if b in made else held[b] for b in sorted(made | (held.keys() - touched))]


def fold_catalog(store: Store, buckets: int | None = None, only_touched: bool = False) -> None:
    """Stores the tables anew and empties the log; the watermark stays.

    ``buckets`` is kept from fold to fold unless given, and starts as the session's
    number of shuffle partitions.  Choose it for tables of their full size: a
    bucket is one task's work.

    ``only_touched`` keeps a folder for each bucket and rewrites the buckets that
    the log touches, which is for logs of few packages and tables of many
    buckets.  Else the whole table is rewritten, without a shuffle of it.  A
    table goes from one form to the other with its next fold.
    """

    def work(own: Checkpoint, run: Run) -> RunResult:
        before = store.checkpoint(SOURCE)
        if not before.folders.get(LOG):
            return RunResult(own.watermark, own.folders)
        n, log = _buckets(store, before, buckets), catalog_log(store, before)
        folders = {LOG: [], BUCKETS: [str(n)]}
        for table, schema, keys, changes in (
            (VERSIONS, schemas.VERSION_STATE, VERSION_KEYS, version_changes(log)),
            (PACKAGES, schemas.PACKAGE_STATE, PACKAGE_KEYS, package_changes(log)),
        ):
            stored = before.folders.get(table, [])
            if not only_touched:
                _fold_table(store, before, run.id, table, schema, keys, changes, n)
                folders[table] = [run.id]
                continue
            if before.folders.get(BUCKETS) != [str(n)] and _by_bucket(stored):
                raise ValueError(f"{table} is kept in {before.folders[BUCKETS][0]} buckets; fold it whole to change their number")
            folders[table] = rewritten_buckets(
                store, run.id, table, schema, stored, changes, n, lambda target, batch, keys=keys: merge_changes(target, batch, keys)
            )
            if not folders[table]:
                raise BlockingCheckFailed(f"blocking checks failed: {table} has no rows")
        store.change_folders(SOURCE, before.folders, {**before.folders, **folders})
        return RunResult(before.watermark, own.folders)

    run_job(store, FOLD, work)


def backfill_deletes(
    store: Store, index_documents: DataFrame, pages_for: Pages, max_pages: int | None = None
) -> RunResult:
    """Folds, then marks stored versions from the delete events of all pages.

    Keeps its own checkpoint and never moves the catalog's watermark.  Only rows
    that exist are marked, and a later re-publish is not looked at.
    """

    def work(before: Checkpoint, run: Run) -> RunResult:
        pages = parse_index(index_documents)
        require_dated(pages)
        new = after_watermark(pages, F.col("commit"), watermark_key(before.watermark))
        chosen = first_pages(new, "commit", max_pages)
        left = new.count()
        catalog = store.checkpoint(SOURCE)
        if left == 0 or not catalog.folders.get(VERSIONS):
            return RunResult(before.watermark, before.folders)
        done = left if max_pages is None else chosen.count()
        landed = pages_for(chosen)
        require_landed(chosen, landed)
        seen = Observation()
        observed = once(_refs_of(chosen, landed)).observe(
            seen, _newest(), F.count_if("gone").alias("deletes")
        )
        dated = F.col("gone") & F.col("commit.commit_at").isNotNull()
        deletes = observed.filter(dated).select(*VERSION_KEYS, F.col("commit").alias("delete_at"))
        n, stored, schema = _buckets(store, catalog, None), catalog.folders[VERSIONS], schemas.VERSION_STATE

        def mark(target: DataFrame, batch: DataFrame) -> DataFrame:
            return mark_deleted(target, batch, VERSION_KEYS)

        if _by_bucket(stored):
            kept = f"{run.id}-deletes"
            store.write(DELETES, kept, deletes)  # read twice: for the buckets and to mark them
            deletes = store.read(DELETES, [kept], deletes.schema)
            names = rewritten_buckets(store, run.id, VERSIONS, schema, stored, deletes, n, mark)
        else:
            with store.bucketed(VERSIONS, stored[0], schema, VERSION_KEYS, n) as target:
                store.write_bucketed(VERSIONS, run.id, mark(target, deletes), VERSION_KEYS, n, FLOORS)
            names = [run.id]
        store.change_folders(SOURCE, catalog.folders, {**catalog.folders, VERSIONS: names})
        newest = seen.get["watermark"]
        return RunResult(
            before.watermark if newest is None else newest.commit_text,
            before.folders,
            status="completed" if done == left else "partial",
            deleted=seen.get["deletes"],
            pages=done,
            metrics={"pages_remaining": left - done},
        )

    fold_catalog(store, only_touched=bool(_by_bucket(store.checkpoint(SOURCE).folders.get(VERSIONS, []))))
    return run_job(store, BACKFILL, work)
