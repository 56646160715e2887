"""Incremental verdicts: judge the packages past the cursor and those that a new license list touches.

The table is what the last fold stored plus the verdicts of the runs since, so a
run costs what it judges and not what the table holds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark import schemas
from tidemark.functions.cursors import INITIAL, decode_cursor, encode_cursor
from tidemark.operators.cursors import rows_past
from tidemark.operators.merge import upsert
from tidemark.operators.quality import Floor, require_rows, row_floor
from tidemark.operators.verdicts import (
    CLASSES,
    apply_verdicts,
    changed_licenses,
    distinct_signals,
    signal_verdicts,
    touched_rows,
    with_signal,
)
from tidemark.plans.catalog import package_state
from tidemark.plans.licenses import SOURCE as LIST
from tidemark.plans.licenses import TABLE as LICENSES
from tidemark.plans.licenses import license_ref
from tidemark.plans.store import Checkpoint, Run, RunResult, Store, run_job

SOURCE = "license_verdict"
FOLD, REFRESH = "license_verdict_fold", "license_verdict_refresh"
TABLE, BATCH, SIGNALS = "license_verdict", "license_verdict_batch", "signal_verdict"
CHOSEN = "license_verdict_chosen"  # the packages of a run
DELTA = "license_verdict_delta"  # runs whose verdicts the table does not hold yet, beside its folder in the checkpoint
JUDGED_BY = "judged_by"  # the license lists that stored verdicts may rest on, beside them in the checkpoint
FLOORS = (row_floor("license_verdict_nonempty"),)

_BATCH_SCHEMA = StructType([*schemas.LICENSE_VERDICT, StructField("signal", StringType())])


def license_verdicts(store: Store, at: Checkpoint | None = None) -> DataFrame:
    """What the last fold stored, with the runs since: a package's last verdict counts."""
    at = at or store.checkpoint(SOURCE)
    stored = store.read(TABLE, at.folders.get(TABLE, []), schemas.LICENSE_VERDICT)
    runs = at.folders.get(DELTA, [])
    if not runs:
        return stored
    since = store.read(BATCH, runs, _BATCH_SCHEMA).drop("signal")
    if len(runs) > 1:
        since = last_verdicts(since)
    return upsert(stored, since, ["package_id"]) if at.folders.get(TABLE) else since


def last_verdicts(rows: DataFrame) -> DataFrame:
    """The verdict of each package that was given last."""
    order = F.struct("classified_at", "source_synced_at")
    return rows.groupBy("package_id").agg(F.max_by(F.struct(*rows.columns), order).alias("row")).select("row.*")


def judge_signals(
    store: Store, name: str, signalled: DataFrame, licenses: DataFrame
) -> DataFrame:
    """Stores the verdict of each distinct signal."""
    store.write(SIGNALS, name, signal_verdicts(distinct_signals(signalled), licenses))
    return store.read(SIGNALS, [name], schemas.SIGNAL_VERDICT)


def verdict_rows(judged: DataFrame) -> DataFrame:
    """Verdict table rows, with the signal each rests on."""
    return judged.select(
        "package_id",
        F.col("license").alias("license_expression"),
        "license_url",
        "spdx_id",
        "spdx_normalized",
        "is_osi_approved",
        "classification",
        F.concat_ws(": ", "reason", "reason_term").alias("reasoning"),
        F.current_timestamp().alias("classified_at"),
        F.col("synced_at").alias("source_synced_at"),
        "signal",
    )


def _license_list(store: Store) -> tuple[list[str], DataFrame]:
    """The folder of the list that stands, and the list."""
    at = store.checkpoint(LIST)
    licenses = license_ref(store, at)
    require_rows(licenses, "license list")
    return at.folders[LICENSES], licenses


def _judge(store: Store, run: Run, chosen: DataFrame, licenses: DataFrame) -> dict[str, Any]:
    """Stores the verdicts of packages (package_id, license, license_url, synced_at) under the run's name.

    The packages are evaluated once, into a folder of their own; an empty one
    costs no more.  Returns the tally of that pass and the last position.
    """
    declared = chosen.select("package_id", "license", "license_url", "synced_at")
    asked = Observation()
    signalled = with_signal(declared, "license", "license_url").observe(asked, F.count(F.lit(1)).alias("n"))
    store.write(CHOSEN, run.id, signalled)
    if not asked.get["n"]:
        return {}
    kept = store.read(CHOSEN, [run.id], signalled.schema)
    verdicts = judge_signals(store, run.id, kept, licenses)
    seen = Observation()
    last = F.max(F.struct("source_synced_at", "package_id"))
    rows = verdict_rows(apply_verdicts(kept, verdicts)).observe(
        seen,
        F.count(F.lit(1)).alias("rows_classified"),
        last.alias("last"),
        *[F.count_if(F.col("classification") == c).alias(c) for c in CLASSES],
        *[
            F.count_if(F.col("signal") == s).alias(f"signal_{s}")
            for s in ("expression", "url", "none")
        ],
    )
    store.write(BATCH, run.id, rows)
    return dict(seen.get)


def classify_packages(store: Store, all_packages: bool = False) -> RunResult:
    """Judges packages synced after the cursor.

    A run writes the verdicts that it gives and nothing else; ``fold_verdicts``
    brings them into the table from time to time.  A new license list does not
    touch older verdicts: ``refresh_verdicts`` judges those again that it
    changes, ``all_packages`` every package.
    """

    def work(before: Checkpoint, run: Run) -> RunResult:
        listed, licenses = _license_list(store)
        packages = package_state(store)
        if before.watermark != INITIAL and not all_packages:
            cursor = decode_cursor(F.lit(before.watermark))
            at, row_id = cursor.getField("at"), cursor.getField("row_id")
            packages = rows_past(packages, "synced_at", "package_id", at, row_id)
        tally = _judge(store, run, packages, licenses)
        if not tally:
            return RunResult(before.watermark, before.folders, metrics={"rows_classified": 0})
        end = tally.pop("last")
        one = store.spark.createDataFrame(
            [(end.source_synced_at, end.package_id)], "at timestamp, id string"
        )
        cursor = one.select(encode_cursor(F.col("at"), F.col("id")).alias("c")).first().c
        return RunResult(
            cursor,
            {
                **before.folders,
                DELTA: [*before.folders.get(DELTA, []), run.id],
                JUDGED_BY: list(dict.fromkeys([*before.folders.get(JUDGED_BY, []), *listed])),
            },
            inserted=tally["rows_classified"],
            pages=1,
            metrics={**tally, "watermark": cursor},
        )

    return run_job(store, SOURCE, work)


def fold_verdicts(store: Store, floors: Sequence[Floor] = FLOORS) -> None:
    """Stores the table anew with the verdicts since, and forgets the runs that gave them.

    The table is published only if it reaches the floors; below one the old
    table and the runs' verdicts stand.
    """

    def work(own: Checkpoint, run: Run) -> RunResult:
        before = store.checkpoint(SOURCE)
        if not before.folders.get(DELTA):
            return RunResult(own.watermark, own.folders)
        measured = store.write_checked(TABLE, run.id, license_verdicts(store, before), floors)
        store.change_folders(SOURCE, before.folders, {**before.folders, TABLE: [run.id], DELTA: []})
        return RunResult(own.watermark, own.folders, metrics=measured)

    run_job(store, FOLD, work)


def refresh_verdicts(store: Store) -> RunResult:
    """Judges again the packages that a change of the license list can touch.

    The list that stands is compared with every one that stored verdicts rest on.
    Changed licenses find the signals that name them, and those the verdicts that
    rest on them; no other package is judged.
    """

    def work(own: Checkpoint, run: Run) -> RunResult:
        listed, licenses = _license_list(store)
        before = store.checkpoint(SOURCE)
        earlier = [name for name in before.folders.get(JUDGED_BY, []) if name not in listed]
        if not earlier:
            return RunResult(own.watermark, own.folders, metrics={"rows_classified": 0})
        changes = [changed_licenses(store.read(LICENSES, [name], schemas.LICENSE_REF), licenses) for name in earlier]
        given = license_verdicts(store, before).select(
            "package_id", F.col("license_expression").alias("license"), "license_url", F.col("source_synced_at").alias("synced_at")
        )
        touched = touched_rows(given, "license", "license_url", reduce(DataFrame.union, changes))
        tally = _judge(store, run, touched, licenses)
        tally.pop("last", None)
        given_again = [run.id] if tally else []
        after = {DELTA: [*before.folders.get(DELTA, []), *given_again], JUDGED_BY: listed}
        store.change_folders(SOURCE, before.folders, {**before.folders, **after})
        return RunResult(
            store.checkpoint(LIST).watermark,
            own.folders,
            updated=tally.get("rows_classified", 0),
            metrics={"rows_classified": 0, **tally},
        )

    return run_job(store, REFRESH, work)
