"""The catalog job as a stream over landed pages."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.operators.cursors import low_watermark
from tidemark.operators.events import after_watermark
from tidemark.plans.catalog import (
    LOG,
    REFS,
    SOURCE,
    Leaves,
    append_events,
    is_after,
    require_dated,
    require_readable,
    watermark_key,
    written,
)
from tidemark.plans.store import Checkpoint, Run, RunResult, Store, run_job
from tidemark.sources.catalog import page_states, parse_index, parse_leaves, parse_pages

STREAMED = "streamed"  # the last batch of each stream, beside the folders in the checkpoint
AHEAD = "pages_ahead"  # pages read that the watermark has not passed


def _without_holes(store: Store, name: str, index: DataFrame, read: DataFrame, watermark: str) -> str:
    """The watermark by the index, and a new folder of the pages read that lie ahead of it."""
    pages = parse_index(index)
    require_dated(pages)
    low = low_watermark(after_watermark(pages, F.col("commit"), watermark_key(watermark)), read)
    watermark = watermark if low is None else low
    at = watermark_key(watermark)
    passed = pages.filter(F.lit(False) if at is None else F.col("commit") <= at)
    passed = passed.select(F.col("page_url").alias("_page"), F.col("commit").alias("_passed"))
    ahead = read.join(passed, (F.col("page_url") == F.col("_page")) & (F.col("commit") <= F.col("_passed")), "left_anti")
    store.write(AHEAD, name, ahead)
    return watermark


def stream_pages(
    store: Store,
    landing: str,
    leaves_for: Leaves,
    checkpoint: str,
    files_per_batch: int | None = None,
    one_per_file: bool = True,
    index: Callable[[], DataFrame] | None = None,
) -> StreamingQuery:
    """Ingests page documents as their files land, until none is left.

    ``leaves_for`` returns leaf documents holding those of a batch of references,
    so a batch reads its own days of leaves and not the whole landing area.  The log
    folder is named by stream and batch: a replayed batch overwrites itself.  A page
    that cannot be read fails its batch before anything is stored.

    ``index`` returns the index documents as they stand.  With it the watermark stays
    before the first page of the index that has not been read, however late it
    lands, so a batch job that goes on from there misses nothing; pages beyond are
    applied as they come, and what a later job reads again changes nothing.  Without
    it the watermark is the newest commit read.
    """
    spark = store.spark
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    reader = spark.readStream.format("text").schema("value string").option("wholetext", one_per_file)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def ingest(documents: DataFrame, batch_id: int) -> None:
        refs = parse_pages(documents)
        name = f"stream-{stream}-{batch_id:012d}"

        def work(before: Checkpoint, run: Run) -> RunResult:
            if name in before.folders.get(STREAMED, []):
                return RunResult(before.watermark, before.folders)
            require_readable(documents)
            others = [n for n in before.folders.get(STREAMED, []) if not n.startswith(f"stream-{stream}-")]
            store.write(REFS, name, refs)  # a replayed batch overwrites them, too
            stored = store.read(REFS, [name], refs.schema)
            seen = append_events(store, name, stored, parse_leaves(leaves_for(stored)))
            totals = written(store, name)
            log = [*before.folders.get(LOG, []), name]
            newest, watermark = seen["watermark"], before.watermark
            folders = {**before.folders, LOG: log, STREAMED: [*others, name]}
            if index is not None:
                now = page_states(documents).filter("readable").select("page_url", "commit")
                ahead = store.read(AHEAD, before.folders.get(AHEAD, []), schemas.PAGES_READ)
                watermark = _without_holes(store, name, index(), ahead.unionByName(now), watermark)
                folders[AHEAD] = [name]
            # Files land in any order; the watermark never goes back.
            elif newest is not None and is_after(spark, newest.commit_text, watermark):
                watermark = newest.commit_text
            return RunResult(
                watermark,
                folders,
                inserted=totals["versions"],
                updated=totals["packages"],
                deleted=totals["deletes_attempted"],
                metrics={**seen, **totals},
            )

        run_job(store, SOURCE, work)

    return (
        reader.load(landing)
        .writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
