"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes; a chunk ends where the hash is the smallest
among its neighbours on both sides, so cuts depend on nearby bytes only and an
insertion moves none beyond them.  Of equal chunks the first stays, by doc_id
(null last), the text's hash and place; later ones go.

Defined results: null text is empty and has no chunks.  Cuts fall between
characters.  Rows equal in doc_id and text count as one document and come out
alike.  Extra columns stay in `row`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import binaries, merge_spans, outside, random_table, sliding_min

#: A cut's hash is the smallest of this many on either side: the least bytes of a chunk, half the usual.
NEIGHBOURS = 32
#: Stretches without a cut (one repeated byte, say) are cut at this many bytes.
MAX_CHUNK = 1024
#: Chunks of a task that are compared with each other before the shuffle.
BLOCK_CHUNKS = 1 << 20
GEAR = random_table(9, np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """h = 2h + GEAR[byte] at every byte; 32 bits, so the last 32 bytes count.  Summed by doubling the window."""
    h = GEAR[data]
    for step in (1, 2, 4, 8, 16):
        if step < len(h):
            h = np.concatenate([h[:step], h[step:] + (h[:-step] << np.uint32(step))])
    return h


def chunk_starts(data: np.ndarray) -> np.ndarray:
    """Where the chunks begin; the first at 0."""
    n, w = len(data), NEIGHBOURS
    if not n:
        return np.empty(0, np.int64)
    cuts = np.empty(0, np.int64)
    if n > 2 * w + 1:
        h = gear_hashes(data)
        low = sliding_min(h, w)
        middle = h[w : n - w]
        # smaller than all before it, and than none after it larger: of equal ones the first
        cuts = np.flatnonzero((middle < low[: n - 2 * w]) & (middle <= low[w + 1 : n - w + 1])) + w + 1
    edges = np.concatenate([[0], cuts, [n]])
    for k in np.flatnonzero(np.diff(edges) > MAX_CHUNK).tolist():
        cuts = np.concatenate([cuts, np.arange(edges[k] + MAX_CHUNK, edges[k + 1], MAX_CHUNK)])
    for _ in range(3):  # a character has at most three continuation bytes
        cuts = cuts[cuts < n]
        cuts = cuts + ((data[cuts] & 0xC0) == 0x80)
    cuts = np.unique(cuts)
    return np.concatenate([[0], cuts[cuts < n]]).astype(np.int64)


def _block(parts: list[tuple]) -> pa.RecordBatch:
    """Of a block's chunks, the first of each digest (to be compared further) and all others (which go)."""
    last, doc, key, seq, a, b = (np.concatenate([p[i] for p in parts]) for i in range(6))
    order = np.lexsort((seq, key, doc, last, b, a))
    last, doc, key, seq, a, b = (x[order] for x in (last, doc, key, seq, a, b))
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    same = (doc == doc[first]) & (key == key[first]) & (seq == seq[first]) & (last == last[first])
    keep = new | ~same  # a repeated row's chunk is the first itself
    return pa.RecordBatch.from_arrays(
        [pa.array(x[keep]) for x in (a, b, new, last, doc, key, seq)], ["a", "b", "open", "last", "doc", "key", "seq"]
    )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, held = [], 0
    for batch in batches:
        docs = batch.column(0)
        null = docs.is_null().to_numpy(zero_copy_only=False)
        ids = docs.fill_null(0).to_numpy(zero_copy_only=False)
        keys = batch.column(1).to_numpy(zero_copy_only=False)
        digest = xxhash.xxh3_128_digest
        for i, data in enumerate(binaries(batch.column(2))):
            starts = chunk_starts(data)
            k = len(starts)
            if not k:
                continue
            raw, edges = data.tobytes(), [*starts.tolist(), len(data)]
            found = np.frombuffer(b"".join([digest(raw[s:e]) for s, e in zip(edges[:-1], edges[1:], strict=True)]), "<i8")
            parts.append((
                np.full(k, null[i]), np.full(k, ids[i]), np.full(k, keys[i]), np.arange(k, dtype=np.int32), found[0::2], found[1::2],
            ))
            held += k
            if held >= BLOCK_CHUNKS:
                yield _block(parts)
                parts, held = [], 0
    if parts:
        yield _block(parts)


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of later copies; the rows come sorted by digest and then by place."""
    held = None  # digest and place of the run that the last batch ended in
    for batch in batches:
        a, b, open_, last, doc, key, seq = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(a):
            continue
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        if held is not None and held[0] == (a[0], b[0]):
            new[0] = False
        at = np.maximum.accumulate(np.where(new, np.arange(len(a)), -1))
        place = [np.where(at >= 0, x[at], h) for x, h in zip((last, doc, key, seq), held[1] if held else (last[0], doc[0], key[0], seq[0]), strict=True)]
        first = np.logical_and.reduce([x == f for x, f in zip((last, doc, key, seq), place, strict=True)])
        held = ((a[-1], b[-1]), tuple(f[-1] for f in place))
        goes = ~(open_ & first)
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[goes], mask=last[goes]), pa.array(key[goes]), pa.array(seq[goes])], ["doc_id", "key", "seq"]
        )


def later_chunks(docs: DataFrame) -> DataFrame:
    """doc_id, key and the numbers of the chunks that equal an earlier one.

    A task sends a digest once for each block of its chunks, so a frequent chunk
    is a row a block.  Chunks already known to be later ones are dealt at random.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"), F.col("text").cast("binary"))
    chunks = rows.mapInArrow(_chunks, "a long, b long, open boolean, last boolean, doc long, key long, seq int")
    salt = F.when(F.col("open"), F.lit(0)).otherwise(F.xxhash64("doc", "key", "seq"))
    dealt = (
        chunks.withColumn("a", F.when(F.col("open"), F.col("a")).otherwise(salt))
        .withColumn("b", F.when(F.col("open"), F.col("b")).otherwise(F.lit(0)))
        .repartition("a", "b")
        .sortWithinPartitions("a", "b", "last", "doc", "key", "seq")
    )
    return (
        dealt.mapInArrow(_later, "doc_id long, key long, seq int")
        .groupBy("doc_id", "key")
        .agg(F.collect_set("seq").alias("later"))
    )


def _cut():
    @F.pandas_udf("kept binary, n_bytes long, n_chunks long, n_removed long, n_spans long")
    def cut(texts: pd.Series, later: pd.Series) -> pd.DataFrame:
        out = []
        for raw, gone in zip(texts, later, strict=True):
            data = np.frombuffer(raw or b"", np.uint8)
            edges = np.append(chunk_starts(data), len(data))
            gone = np.empty(0, np.int64) if gone is None else np.asarray(gone, np.int64)
            lo, hi = merge_spans(edges[gone], edges[gone + 1]) if len(gone) else (gone, gone)
            out.append((outside(data, lo, hi), len(data), len(edges) - 1, int((hi - lo).sum()), len(lo)))
        return pd.DataFrame(out, columns=["kept", "n_bytes", "n_chunks", "n_removed", "n_spans"])

    return cut


def dedup_chunks(docs: DataFrame) -> DataFrame:
    """`row`, kept_text, n_bytes, n_chunks, n_removed (bytes) and n_spans (stretches removed)."""
    later = later_chunks(docs).select(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), "later")
    keyed = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("key"))
    joined = keyed.join(later, F.col("row.doc_id").cast("long").eqNullSafe(F.col("_doc")) & (F.col("key") == F.col("_key")), "left")
    cut = joined.select("row", _cut()(F.col("row.text").cast("binary"), F.col("later")).alias("cut"))
    return cut.select(
        "row",
        F.when(F.col("row.text").isNotNull(), F.col("cut.kept").cast("string")).alias("kept_text"),
        "cut.n_bytes", "cut.n_chunks", "cut.n_removed", "cut.n_spans",
    )
