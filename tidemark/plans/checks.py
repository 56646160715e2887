"""Checks over the stored tables, and the ledger's upkeep."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import ledger, quality
from tidemark.operators.verdicts import CLASSES
from tidemark.operators.versions import PACKAGE_KEYS, VERSION_KEYS
from tidemark.plans import catalog, enrichment, licenses
from tidemark.plans.store import Store
from tidemark.sources.catalog import identity_mismatches


def _set(name: str, columns: list[str]) -> dict[str, Column]:
    return {f"{name}_{c}_set": F.col(c).isNotNull() for c in columns}


def table_report(store: Store) -> DataFrame:
    """Row floors, keys, required columns, value sets and the unknown share."""
    packages, versions = catalog.package_state(store), catalog.version_state(store)
    listed, verdicts = licenses.license_ref(store), enrichment.license_verdicts(store)
    known = {"license_verdict_class_known": F.col("classification").isin(*CLASSES)}
    return quality.report(
        [
            quality.nonempty(packages, "package_state_nonempty"),
            quality.osi_floor(listed, "license_ref_osi_floor"),
            quality.unknown_ratio(verdicts, "license_verdict_unknown_ratio"),
            quality.key_uniqueness(packages, PACKAGE_KEYS, "package_state_key"),
            quality.key_uniqueness(versions, VERSION_KEYS, "version_state_key"),
            quality.key_uniqueness(listed, ["license_id"], "license_ref_key"),
            quality.key_uniqueness(verdicts, ["package_id"], "license_verdict_key"),
            quality.violations(packages, _set("package_state", ["package_id", "synced_at"])),
            quality.violations(
                versions,
                _set(
                    "version_state",
                    ["package_id", "version", "purl", "listed", "deprecated", "synced_at"],
                ),
            ),
            quality.violations(
                listed,
                _set(
                    "license_ref",
                    ["license_id", "is_osi_approved", "see_also_urls", "synced_at"],
                ),
            ),
            quality.violations(
                verdicts,
                {
                    **_set("license_verdict", ["package_id", "classification", "classified_at"]),
                    **known,
                },
            ),
            quality.count_check(
                identity_mismatches(catalog.catalog_log(store)), "catalog_identity"
            ),
            quality.count_check(catalog.rejects(store), "catalog_rejects"),
        ]
    )


def freshness_report(store: Store, now: Column | None = None) -> DataFrame:
    at = F.current_timestamp() if now is None else now
    return ledger.freshness(store.runs(), quality.MAX_AGE_HOURS, at)


def fail_zombies(store: Store, now: datetime | None = None, since: str = "started_at") -> int:
    """Settles catalog runs that are running for too long as failed; returns how many.

    Runs are few and open ones fewer: one per job that was lost.
    """
    at = now or datetime.now(timezone.utc)
    swept = ledger.sweep_zombies(
        store.runs(), F.lit(at).cast("timestamp"), since=since, source=catalog.SOURCE
    )
    events = swept.filter("swept").drop("swept", "duration_ms", "event_at")
    return store.append_run_events(events, at)
