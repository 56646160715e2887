"""License list refresh, gated on the list's version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.cursors import INITIAL
from tidemark.operators.licenses import list_profile
from tidemark.operators.merge import upsert
from tidemark.operators.quality import Floor, approved_floor, require_rows, row_floor
from tidemark.plans.store import Checkpoint, Run, RunResult, Store, run_job
from tidemark.sources.licenses import parse_license_list

SOURCE = "license_list"
TABLE = "license_ref"
#: What the list must reach, as a whole, before a new edition of it is published.
FLOORS = (row_floor("license_ref_nonempty"), approved_floor("license_ref_osi_floor"))


def is_new_edition(edition: str, stored: str) -> bool:
    """Versions are compared for equality only: 3.10 sorts before 3.9 as text."""
    return stored == INITIAL or edition != stored


def edition_version(edition: DataFrame) -> str:
    """The version of the one list that the rows come from; fails on rows of several, or without or with repeated ids."""
    found = edition.agg(
        F.count_if(F.col("list_version").isNull()).alias("unversioned"),
        F.count_distinct("list_version").alias("versions"),
        F.count_if(F.col("license_id").isNull()).alias("unnamed"),
        (F.count("license_id") - F.count_distinct("license_id")).alias("repeated"),
        F.min("list_version").alias("version"),
    ).first()
    if found.unversioned or found.versions != 1:
        raise ValueError(f"license list: {found.versions} versions, {found.unversioned} rows without one")
    if found.unnamed or found.repeated:
        raise ValueError(f"license list {found.version}: {found.unnamed} rows without an id, {found.repeated} repeated ids")
    return found.version


def refreshed_licenses(stored: DataFrame, edition: DataFrame) -> DataFrame:
    """Rewrites every license of the edition; licenses dropped upstream stay."""
    return upsert(stored, edition, ["license_id"])


def license_ref(store: Store, at: Checkpoint | None = None) -> DataFrame:
    at = at or store.checkpoint(SOURCE)
    return store.read(TABLE, at.folders.get(TABLE, []), schemas.LICENSE_REF)


def sync_licenses(store: Store, list_documents: DataFrame, floors: Sequence[Floor] = FLOORS) -> RunResult:
    """Stores a new edition of the list; an edition already stored is left alone.

    The refreshed list is written, measured in that pass and published only if
    it reaches every floor.  Below one the run fails and the old list stands.
    """

    def work(before: Checkpoint, run: Run) -> RunResult:
        edition = parse_license_list(list_documents)
        require_rows(edition, "license list")
        version = edition_version(edition)
        profile = list_profile(edition).first().asDict()
        if not is_new_edition(version, before.watermark):
            return RunResult(before.watermark, before.folders, metrics={"rewritten": False})
        rows = edition.withColumn("synced_at", F.current_timestamp())
        batch = rows.select(*schemas.LICENSE_REF.names)
        refreshed = refreshed_licenses(license_ref(store, before), batch)
        measured = store.write_checked(TABLE, run.id, refreshed, floors)
        return RunResult(
            version,
            {TABLE: [run.id]},
            inserted=profile["license_count"],
            pages=1,
            metrics={**profile, **measured, "rewritten": True},
        )

    return run_job(store, SOURCE, work)
