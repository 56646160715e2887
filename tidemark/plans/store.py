"""Stored tables: Parquet folders below one root, committed by checkpoint rows.

    <root>/<table>/batch=<name>/   the rows of one write; no other write touches them
    <root>/sync_checkpoint/        one row per commit; a source's last row counts
    <root>/run_ledger/             one row per event of a run

A job writes its folders first and the checkpoint row naming them last.  A job
that dies in between leaves folders no checkpoint names, and its retry starts
from the old checkpoint: delivery is at least once, and every write is keyed or
idempotent.

A commit changes the folders that stand when it is made, not those its job
began with, so what another job committed in between stays.  Two jobs that
replace one table conflict, and the later one fails.  Parquet has no
compare-and-swap: only the moment between that last look and the append of the
checkpoint row is unguarded.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import schemas
from tidemark.functions.cursors import INITIAL
from tidemark.operators.ledger import current_checkpoints, current_runs
from tidemark.operators.quality import Floor, require_floors, watched


#: Entries of a checkpoint to which jobs append folders of their own.
LOGS = ("catalog_log", "streamed", "license_verdict_delta", "judged_by")


@dataclass(frozen=True)
class Checkpoint:
    watermark: str = INITIAL
    folders: dict[str, list[str]] = field(default_factory=dict)
    status: str = "completed"
    rows: int = 0


@dataclass
class RunResult:
    watermark: str
    folders: dict[str, list[str]]
    status: str = "completed"
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    pages: int = 0
    metrics: dict[str, Any] = field(default_factory=dict)


class CommitConflict(RuntimeError):
    """Another job replaced a table that this one was replacing; run it again."""


def rebased(
    before: dict[str, list[str]], after: dict[str, list[str]], now: dict[str, list[str]]
) -> dict[str, list[str]]:
    """The folders that stand now, changed as a job changed those it began with.

    A log's folders are removed and added one by one; any other entry is
    replaced as a whole.
    """
    out = dict(now)
    for table in {*before, *after}:
        old, new, current = (folders.get(table, []) for folders in (before, after, now))
        if new == old:
            continue
        gone = [name for name in old if name not in new]
        if current != old and (table not in LOGS or not set(gone) <= set(current)):
            raise CommitConflict(f"{table}: {current} stand, the job began with {old}")
        kept = [name for name in current if name not in gone] if table in LOGS else []
        out[table] = kept + [name for name in new if name not in kept and (table not in LOGS or name not in old)]
    return out


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def write(self, table: str, name: str, rows: DataFrame) -> None:
        """Writes one folder.  Overwriting only ever replaces a failed or replayed write."""
        rows.write.mode("overwrite").parquet(f"{self.root}/{table}/batch={name}")

    def write_checked(self, table: str, name: str, rows: DataFrame, floors: Sequence[Floor]) -> dict[str, Any]:
        """Writes one folder and fails if it lies below a floor, measured in the same pass.

        Nothing names the folder yet, so what was published before stands.
        """
        rows, seen = watched(rows, floors)
        self.write(table, name, rows)
        measured = seen.get if seen else {}
        require_floors(floors, measured)
        return measured

    def read(self, table: str, names: Sequence[str], schema: StructType) -> DataFrame:
        """The rows of the named folders; columns a folder lacks are null."""
        if not names:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}")
        paths = [f"{self.root}/{table}/batch={name}" for name in names]
        return reader.parquet(*paths).select(*schema.names)

    def write_partitioned(self, table: str, name: str, rows: DataFrame, column: str) -> None:
        """Writes one folder with a folder inside for each value of a column."""
        rows.write.mode("overwrite").partitionBy(column).parquet(f"{self.root}/{table}/batch={name}")

    def partitions(self, table: str, name: str, column: str) -> set[int]:
        """The values that have a folder."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}/batch={name}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = (entry.getPath().getName().partition("=") for entry in files.listStatus(path) if entry.isDirectory())
        return {int(value) for key, _, value in found if key == column}

    def write_bucketed(
        self, table: str, name: str, rows: DataFrame, keys: Sequence[str], buckets: int, floors: Sequence[Floor] = ()
    ) -> None:
        """Writes one folder bucketed and sorted by key, and fails below a floor.

        Rows already partitioned by the keys into as many parts give one file per
        bucket.  Spark buckets tables only, so one is named for the time of the write.
        """
        handle = self._handle(table, name)
        rows, seen = watched(rows, floors)
        rows.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option(
            "path", f"{self.root}/{table}/batch={name}"
        ).saveAsTable(handle)
        self.spark.sql(f"DROP TABLE {handle}")
        require_floors(floors, seen.get if seen else {})

    @contextmanager
    def bucketed(
        self, table: str, name: str, schema: StructType, keys: Sequence[str], buckets: int
    ) -> Iterator[DataFrame]:
        """A folder as a bucketed table: joins on the keys need no shuffle of it."""
        handle, columns = self._handle(table, name), ", ".join(keys)
        # A job that died here may have left the name in a shared catalog.
        self.spark.sql(f"DROP TABLE IF EXISTS {handle}")
        self.spark.sql(
            f"CREATE TABLE {handle} ({schema.toDDL()}) USING parquet "
            f"CLUSTERED BY ({columns}) SORTED BY ({columns}) INTO {buckets} BUCKETS "
            f"LOCATION '{self.root}/{table}/batch={name}'"
        )
        try:
            yield self.spark.table(handle)
        finally:
            self.spark.sql(f"DROP TABLE {handle}")

    def _handle(self, table: str, name: str) -> str:
        digest = hashlib.sha256(f"{self.root}/{table}/{name}".encode()).hexdigest()
        return f"tidemark_{table}_{digest[:16]}"

    def _rows(self, table: str, schema: StructType) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")

    def _append(self, table: str, schema: StructType, **values: Any) -> None:
        row = self.spark.range(0, 1, 1, 1).select(
            *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema]
        )
        row.write.mode("append").parquet(f"{self.root}/{table}")

    # --- checkpoints ---------------------------------------------------------

    def checkpoints(self) -> DataFrame:
        return current_checkpoints(self._rows("sync_checkpoint", schemas.SYNC_CHECKPOINT))

    def checkpoint(self, source: str) -> Checkpoint:
        row = self.checkpoints().filter(F.col("source") == source).first()
        if row is None:
            return Checkpoint()
        folders = json.loads(row.metadata or "{}")
        return Checkpoint(row.watermark, folders, row.last_sync_status, row.rows_synced)

    def commit(
        self, source: str, watermark: str, folders: dict[str, list[str]], status: str, rows: int
    ) -> None:
        self._append(
            "sync_checkpoint",
            schemas.SYNC_CHECKPOINT,
            source=source,
            watermark=watermark,
            last_sync_at=_now(),
            last_sync_status=status,
            rows_synced=rows,
            metadata=json.dumps(folders),
        )

    def change_folders(
        self, source: str, before: dict[str, list[str]], after: dict[str, list[str]]
    ) -> None:
        """Names other folders for a source and leaves its progress as it is."""
        at = self.checkpoint(source)
        self.commit(source, at.watermark, rebased(before, after, at.folders), at.status, at.rows)

    # --- runs ----------------------------------------------------------------

    def run_events(self) -> DataFrame:
        """Every row of the ledger, heartbeats included."""
        return self._rows("run_ledger", schemas.RUN_EVENT)

    def runs(self) -> DataFrame:
        return current_runs(self.run_events())

    def log_run(self, **values: Any) -> None:
        self._append("run_ledger", schemas.RUN_EVENT, event_at=_now(), **values)

    def append_run_events(self, rows: DataFrame, at: datetime) -> int:
        """Appends a row per given run, as of ``at``; returns how many."""
        events = rows.withColumn("event_at", F.lit(at).cast("timestamp"))
        seen = Observation()
        counted = events.select(*schemas.RUN_EVENT.names).observe(
            seen, F.count(F.lit(1)).alias("n")
        )
        counted.write.mode("append").parquet(f"{self.root}/run_ledger")
        return seen.get["n"]


def _now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass(frozen=True)
class Run:
    """An open run; ``heartbeat`` records progress without settling it."""

    store: Store
    opened: dict[str, Any]

    @property
    def id(self) -> str:
        return self.opened["id"]

    def heartbeat(self, inserted: int = 0, updated: int = 0, deleted: int = 0, pages: int = 0,
                  watermark: str | None = None) -> None:
        self.store.log_run(
            **self.opened,
            status="running",
            rows_inserted=inserted,
            rows_updated=updated,
            rows_deleted=deleted,
            pages_processed=pages,
            watermark_after=watermark,
            last_heartbeat_at=_now(),
        )

    def settle(self, result: RunResult, error: Exception | None = None) -> None:
        at = _now()
        self.store.log_run(
            **self.opened,
            status=result.status,
            completed_at=at,
            rows_inserted=result.inserted,
            rows_updated=result.updated,
            rows_deleted=result.deleted,
            pages_processed=result.pages,
            watermark_after=result.watermark,
            error_message=None if error is None else str(error),
            error_details=None if error is None else json.dumps({"type": type(error).__name__}),
            last_heartbeat_at=at,
        )


Work = Callable[[Checkpoint, Run], RunResult]


def run_job(store: Store, source: str, work: Work, external_run_id: str | None = None) -> RunResult:
    """The frame of every incremental job.

    Read the checkpoint, open a run, work, settle the run, move the checkpoint
    last.  A failure settles the run as failed and leaves the checkpoint where
    it stands.
    """
    before = store.checkpoint(source)
    run = Run(
        store,
        {
            "id": str(uuid.uuid4()),
            "source": source,
            "external_run_id": external_run_id,
            "started_at": _now(),
            "watermark_before": before.watermark,
        },
    )
    run.heartbeat()
    try:
        result = work(before, run)
        result.folders = rebased(before.folders, result.folders, store.checkpoint(source).folders)
    except Exception as error:
        failed = RunResult(before.watermark, before.folders, status="failed")
        run.settle(failed, error)
        now = store.checkpoint(source)
        store.commit(source, now.watermark, now.folders, "failed", 0)
        raise
    run.settle(result)
    rows = result.inserted + result.updated + result.deleted
    store.commit(source, result.watermark, result.folders, result.status, rows)
    return result
