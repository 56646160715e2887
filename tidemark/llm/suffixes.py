"""Substring dedup: bytes covered by a long string that starts elsewhere too.

Texts are cut into pieces so that equal long strings meet: each string of
MIN_BYTES bytes belongs to the smallest hash among its 128-byte substrings, and
the neighbouring strings of one smallest hash form a piece.  Pieces of a hash
that occurs once hold nothing repeated.  The others are gathered by hash, equal
pieces once, into blocks.  A hash with more than GROUP_BYTES of pieces is split by
its strings' second smallest hash, and what is still larger by the strings' digests,
so equal strings meet all the same.  Each block gets a Burrows-Wheeler transform, and its
common prefixes are derived by increasing value: boundaries between suffixes
that share k bytes give, one step backward, those that share k + 1.  At
MIN_BYTES the search stops; what has no boundary by then shares that many.

Defined results: null text is empty.  Strings never cross documents.  Rows of
equal text are documents of their own: each holds what the other repeats.
Extra columns stay in `row`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import binaries, merge_spans, outside, random_table, ranges, sliding_min
from tidemark.llm.common import settled

MIN_BYTES = 400
#: Length of the substrings whose hashes deal the strings out; a power of two.
GRAM = 128
#: The most strings in a piece.
PIECE_STARTS = 512
#: Bytes of pieces transformed together; the last group may reach beyond it.
BLOCK_BYTES = 1 << 20
#: The most bytes of distinct pieces that one hash gathers in a task.
GROUP_BYTES = 1 << 20
BYTES = random_table(6, np.uint64)
BASE = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each `gram` neighbouring bytes, mixed so that smallest ones lie anywhere."""
    h, base = BYTES[data], BASE
    width = 1
    while width < gram:
        h = h[:-width] * np.uint64(base) + h[width:]
        base = base * base & 0xFFFFFFFFFFFFFFFF
        width *= 2
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def pieces(data: np.ndarray, least: int, gram: int) -> list[tuple[int, int, int, bool]]:
    """(smallest hash, first start, starts, whether the hash occurs twice in it) of each piece of a text."""
    if len(data) < least:
        return []
    h = gram_hashes(data, gram)
    window = least - gram + 1
    low = sliding_min(h, window)
    first = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    out = []
    for s, e in zip(first.tolist(), [*first[1:].tolist(), len(low)], strict=True):
        value = low[s]
        for at in range(s, e, PIECE_STARTS):
            n = min(PIECE_STARTS, e - at)
            out.append((int(value), at, n, int(np.count_nonzero(h[at : at + n + window - 1] == value)) > 1))
    return out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _pieces(batches: Iterator[pa.RecordBatch], least: int, gram: int) -> Iterator[pa.RecordBatch]:
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        k1s, k2s = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows = []
        for k1, k2, data in zip(k1s, k2s, binaries(batch.column(2)), strict=True):
            if len(data) < least or (k1, k2) in seen:
                continue
            seen.add((k1, k2))
            raw = data.tobytes()
            rows += [
                (_signed(value), _signed(xxhash.xxh3_64_intdigest(raw[s : s + n + least - 1])), k1, k2, s, n, twice)
                for value, s, n, twice in pieces(data, least, gram)
            ]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PIECE_TYPES, strict=True)], PIECE_NAMES
            )


PIECE_NAMES = ["anchor", "digest", "k1", "k2", "start", "n", "twice"]
PIECE_TYPES = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.bool_()]


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first `depth` symbols at least; symbols below 512, zeros beyond the end."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(7, symbols.dtype)]).astype(np.int64)
    key = np.zeros(n, np.int64)
    for i in range(7):
        key = key << 9 | padded[i : i + n]
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    head = np.r_[True, ordered[1:] != ordered[:-1], True]  # where suffixes equal so far begin
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head[:-1], np.arange(n), 0))
    have = 7
    while have < depth:
        tied = np.flatnonzero(~(head[:-1] & head[1:]))  # the others have their place
        if not len(tied):
            break
        at = order[tied]
        after = np.where(at + have < n, rank[np.minimum(at + have, n - 1)] + 1, 0)
        key = rank[at] * np.int64(n + 1) + after
        by_key = np.argsort(key, kind="stable")
        at, key = at[by_key], key[by_key]
        new = np.r_[True, key[1:] != key[:-1]]
        order[tied], head[tied] = at, new
        rank[at] = np.maximum.accumulate(np.where(new, tied, 0))
        have *= 2
    return order


def shared_intervals(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order, and the rows at which an interval of suffixes sharing `depth` symbols begins.

    Breadth first by the length of the common prefix.  `first` holds for each row
    the head of its interval, the rows that share the current length with it, and
    `stop` for each head where its interval ends.  Two neighbouring occurrences
    p < q of one symbol in the transform lead to neighbouring rows; if an interval
    of both is split between them, those rows share one symbol more than the rows
    at the split.  Only intervals that the last step split can hold such pairs.
    """
    n = len(symbols)
    order = suffix_order(symbols, depth)
    transform = symbols[order - 1]
    by_symbol = np.argsort(transform, kind="stable")
    target = np.empty(n, np.int64)  # where a row's suffix with the symbol before it lies
    target[by_symbol] = np.arange(n)
    same = np.r_[False, transform[by_symbol][1:] == transform[by_symbol][:-1]]
    before = np.full(n, -1, np.int64)  # the same symbol's last occurrence
    before[by_symbol[same]] = by_symbol[np.flatnonzero(same) - 1]
    edge = np.zeros(n, bool)
    edge[0] = True
    first, stop = np.zeros(n, np.int64), np.zeros(n, np.int64)
    stop[0] = n
    fresh = np.flatnonzero(~same)[1:]  # rows where the first symbol changes share nothing
    for _ in range(depth):
        if not len(fresh):
            break
        edge[fresh] = True
        lo = first[fresh]
        lo = lo[np.r_[True, lo[1:] != lo[:-1]]]
        hi = stop[lo]
        q = ranges(lo, hi - lo)
        heads = q[edge[q]]
        last = np.r_[heads[1:], 0]
        ends = np.searchsorted(heads, lo)[1:] - 1
        last[ends], last[-1] = hi[:-1], hi[-1]
        stop[heads] = last
        own = np.repeat(heads, last - heads)
        first[q] = own
        p = before[q]
        found = target[q[(p >= np.repeat(lo, hi - lo)) & (p < own)]]
        fresh = np.sort(found[~edge[found]])
    return order, np.flatnonzero(edge)


def repeated_starts(texts: list[bytes], many: list[bool], least: int) -> list[np.ndarray]:
    """For each piece, the starts of strings found at another start or in a piece that occurs more than once."""
    sizes = np.array([len(t) for t in texts])
    begin = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(int(sizes.sum()) + len(texts), np.int16)
    for at, text in zip(begin.tolist(), texts, strict=True):
        symbols[at : at + len(text)] = np.frombuffer(text, np.uint8).astype(np.int16) + 1
    order, heads = shared_intervals(symbols, least)
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    place = np.arange(len(symbols)) - begin[owner]
    valid = place <= sizes[owner] - least  # a whole string fits
    weight = np.where(valid, 1 + np.array(many, np.int64)[owner], 0)[order]
    total = np.add.reduceat(weight, heads)
    repeats = np.repeat(total > 1, np.diff(np.append(heads, len(order)))) & (weight > 0)
    hit = np.sort(order[repeats])
    return np.split(place[hit], np.searchsorted(hit, begin[1:]))


def _blocks(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Repeated strings of the pieces, which come sorted by anchor and digest."""

    def done(rows: list[tuple]) -> pa.RecordBatch:
        anchors, digests, many, texts = zip(*rows, strict=True)
        out = []
        for anchor, digest, starts in zip(anchors, digests, repeated_starts(list(texts), list(many), least), strict=True):
            lo, hi = merge_spans(starts, starts + least)
            out += [(anchor, digest, a, b) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
        return pa.RecordBatch.from_pylist(
            [dict(zip(SPAN_NAMES, r, strict=True)) for r in out],
            pa.schema(list(zip(SPAN_NAMES, [pa.int64(), pa.int64(), pa.int32(), pa.int32()], strict=True))),
        )

    held, size = [], 0
    for batch in batches:
        for anchor, digest, many, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[-1][:2] == (anchor, digest):
                continue  # the same piece of a repeated row
            if size >= BLOCK_BYTES and held[-1][0] != anchor:
                yield done(held)
                held, size = [], 0
            held.append((anchor, digest, many, raw))
            size += len(raw)
    if held:
        yield done(held)


SPAN_NAMES = ["anchor", "digest", "lo", "hi"]


def _split(batches: Iterator[pa.RecordBatch], least: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Parts of pieces: neighbouring strings of one second smallest hash."""
    for batch in batches:
        rows = []
        for anchor, digest, many, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            h = gram_hashes(np.frombuffer(raw, np.uint8), gram)
            h[h.view(np.int64) == anchor] = np.iinfo(np.uint64).max
            low = sliding_min(h, least - gram + 1)
            first = np.flatnonzero(np.r_[True, low[1:] != low[:-1]]).tolist()
            for s, e in zip(first, [*first[1:], len(low)], strict=True):
                part = raw[s : e + least - 1]
                group = xxhash.xxh3_64_intdigest(low[s].tobytes(), anchor & 0xFFFFFFFFFFFFFFFF)
                rows.append((_signed(group), _signed(xxhash.xxh3_64_intdigest(part)), anchor, digest, s, many, part))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PART_TYPES, strict=True)], PART_NAMES
            )


PART_NAMES = ["group", "part", "anchor", "digest", "offset", "many", "raw"]
PART_TYPES = [pa.int64()] * 4 + [pa.int32(), pa.bool_(), pa.binary()]


def _strings(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """128 bits of each string of the parts."""
    for batch in batches:
        for group, part, many, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            n = len(raw) - least + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([xxhash.xxh3_128_digest(raw[i : i + least]) for i in range(n)], pa.binary()), pa.array([group] * n, pa.int64()),
                    pa.array([part] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([many] * n, pa.bool_()),
                ],
                ["string", "group", "part", "start", "many"],
            )


def _compared(pieces_: DataFrame, least: int) -> DataFrame:
    """anchor, digest, lo and hi of the repeated strings of pieces, those of one anchor in one task."""
    return (
        pieces_.repartition("anchor")
        .sortWithinPartitions("anchor", "digest")
        .mapInArrow(lambda it: _blocks(it, least), "anchor long, digest long, lo int, hi int")
    )


def _too_large(pieces_: DataFrame, group: str, size: Column) -> DataFrame:
    """The groups of more than GROUP_BYTES."""
    large = pieces_.groupBy(group).agg(F.sum(size).alias("bytes")).filter(F.col("bytes") > GROUP_BYTES)
    return settled(large.select(group), "suffix-large")


def _compared_split(pieces_: DataFrame, least: int, gram: int) -> DataFrame:
    """The same for anchors whose pieces are too many for a task."""
    parts = settled(
        pieces_.mapInArrow(
            lambda it: _split(it, least, gram), "group long, part long, anchor long, digest long, offset int, many boolean, raw binary"
        ),
        "suffix-parts",
    )
    place = F.xxhash64("anchor", "digest", "offset")
    distinct = settled(
        parts.groupBy("group", "part").agg((F.max("many") | (F.min(place) != F.max(place))).alias("many"), F.min("raw").alias("raw")),
        "suffix-distinct",
    )
    large = _too_large(distinct, "group", F.octet_length("raw"))
    names = [F.col("group").alias("anchor"), F.col("part").alias("digest"), "many", "raw"]
    small = _compared(distinct.join(large, "group", "left_anti").select(*names), least).toDF("_group", "_part", "lo", "hi")
    strings = settled(
        distinct.join(large, "group", "left_semi")
        .select("group", "part", "many", "raw")
        .mapInArrow(lambda it: _strings(it, least), "string binary, group long, part long, start int, many boolean"),
        "suffix-strings",
    )
    place = F.xxhash64("group", "part", "start")
    again = (
        strings.groupBy("string")
        .agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.max("many").alias("many"))
        .filter((F.col("lo") != F.col("hi")) | F.col("many"))
        .select("string")
    )
    single = strings.join(again, "string", "left_semi").select(
        F.col("group").alias("_group"), F.col("part").alias("_part"), F.col("start").alias("lo"), (F.col("start") + least).alias("hi")
    )
    return (
        parts.drop("many", "raw")
        .join(small.unionByName(single), (F.col("group") == F.col("_group")) & (F.col("part") == F.col("_part")))
        .select("anchor", "digest", (F.col("offset") + F.col("lo")).alias("lo"), (F.col("offset") + F.col("hi")).alias("hi"))
    )


def _slices():
    @F.pandas_udf("array<struct<anchor:long,digest:long,many:boolean,raw:binary>>")
    def slices(texts: pd.Series, wanted: pd.Series) -> pd.Series:
        return pd.Series([
            [{"anchor": w["anchor"], "digest": w["digest"], "many": w["many"], "raw": raw[w["start"] : w["start"] + w["size"]]} for w in ws]
            for raw, ws in zip(texts, wanted, strict=True)
        ])

    return slices


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.struct("*").alias("row"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(6), text).alias("k2"), text.cast("binary").alias("text")
    )


def _raw(keyed: DataFrame, texts: DataFrame, chosen: DataFrame, least: int) -> DataFrame:
    """anchor, digest, many and the bytes of the chosen pieces."""
    wanted = (
        chosen.select("one.k1", "one.k2", F.struct("anchor", "digest", "many", "one.start", (F.col("one.n") + (least - 1)).alias("size")).alias("w"))
        .groupBy("k1", "k2")
        .agg(F.collect_list("w").alias("wanted"))
        .join(texts.drop("copies"), ["k1", "k2"])
    )
    # one document of each text, so that copies are not read for their pieces
    source = keyed.join(
        wanted.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "doc", "wanted"),
        (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")) & F.col("row.doc_id").eqNullSafe(F.col("doc")),
    )
    return source.select(F.explode(_slices()(F.col("text"), F.col("wanted"))).alias("p")).select("p.*")


def repeated_spans(docs: DataFrame, least: int = MIN_BYTES, gram: int = GRAM) -> DataFrame:
    """k1, k2 (128 bits of a text) and `spans`, half-open byte ranges that repeated strings cover.

    A text that occurs twice has one span without end.
    """
    keyed = _keyed(docs)
    texts = settled(
        keyed.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies"), F.min("row.doc_id").alias("doc")), "suffix-texts"
    )
    found = settled(
        keyed.select("k1", "k2", "text").mapInArrow(
            lambda it: _pieces(it, least, gram), "anchor long, digest long, k1 long, k2 long, start int, n int, twice boolean"
        ),
        "suffix-pieces",
    )
    place = F.xxhash64("k1", "k2", "start")
    anchors = (
        found.groupBy(F.col("anchor").alias("_anchor"))
        .agg(
            F.min(place).alias("lo"), F.max(place).alias("hi"), F.min("digest").alias("d_lo"), F.max("digest").alias("d_hi"), F.max("twice").alias("any")
        )
        .filter((F.col("lo") != F.col("hi")) | F.col("any"))
        .select("_anchor", ((F.col("d_lo") != F.col("d_hi")) | F.col("any")).alias("mixed"))
    )
    shared = settled(found.join(anchors, F.col("anchor") == F.col("_anchor")).drop("_anchor", "twice"), "suffix-shared")
    # pieces that are all equal need no comparison: they share their whole length
    equal = shared.filter(~F.col("mixed")).select("k1", "k2", F.col("start").alias("lo"), (F.col("start") + F.col("n") + (least - 1)).alias("hi"))
    mixed = shared.filter("mixed")
    chosen = settled(
        mixed.groupBy("anchor", "digest").agg(F.min(F.struct("k1", "k2", "start", "n")).alias("one"), (F.min(place) != F.max(place)).alias("many")),
        "suffix-chosen",
    )
    large = _too_large(chosen, "anchor", F.col("one.n") + (least - 1))
    if large.isEmpty():
        hits = _compared(_raw(keyed, texts, chosen, least), least)
    else:
        hits = _compared(_raw(keyed, texts, chosen.join(large, "anchor", "left_anti"), least), least).unionByName(
            _compared_split(_raw(keyed, texts, chosen.join(large, "anchor", "left_semi"), least), least, gram)
        )
    hits = hits.toDF("_anchor", "_digest", "_lo", "_hi")
    compared = mixed.join(hits, (F.col("anchor") == F.col("_anchor")) & (F.col("digest") == F.col("_digest"))).select(
        "k1", "k2", (F.col("start") + F.col("_lo")).alias("lo"), (F.col("start") + F.col("_hi")).alias("hi")
    )
    whole = texts.filter("copies > 1").select("k1", "k2", F.lit(0).alias("lo"), F.lit(2**31 - 1).alias("hi"))
    return (
        equal.unionByName(compared)
        .unionByName(whole)
        .groupBy("k1", "k2")
        .agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    )


def _cut(least: int):
    @F.pandas_udf("kept binary, n_bytes long, n_removed long, n_spans long")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for raw, found in zip(texts, spans, strict=True):
            data = np.frombuffer(raw, np.uint8)
            found = [] if found is None or len(data) < least else list(found)
            lo, hi = merge_spans(
                np.array([x["lo"] for x in found], np.int64), np.minimum(np.array([x["hi"] for x in found], np.int64), len(data))
            )
            out.append((outside(data, lo, hi), len(data), int((hi - lo).sum()), len(lo)))
        return pd.DataFrame(out, columns=["kept", "n_bytes", "n_removed", "n_spans"])

    return cut


def remove_repeats(docs: DataFrame, least: int = MIN_BYTES, gram: int = GRAM) -> DataFrame:
    """`row`, kept (bytes), n_bytes, n_removed and n_spans (maximal removed runs)."""
    spans = repeated_spans(docs, least, gram).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "spans")
    joined = _keyed(docs).join(spans, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left")
    return joined.select("row", _cut(least)(F.col("text"), F.col("spans")).alias("cut")).select("row", "cut.*")
