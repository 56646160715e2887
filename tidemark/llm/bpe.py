"""Byte-level BPE encoding and decoding over overlapping chunks.

Long texts are cut into chunks that overlap; tasks pre-tokenise and encode the
chunks apart.  A split depends on the text from its own start on, so where two
neighbouring chunks share a boundary inside the overlap they agree from there
on, and the one is stitched to the other.  Where they share none, the text from
the last sure boundary on is split anew.  Decoding concatenates the tokens' bytes.

Defined results: null text is empty and has no tokens.  Repeated rows are
encoded alike.  Special tokens are ordinary text.  Extra columns stay in `row`.
"""

from __future__ import annotations

import base64
import functools
from array import array
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import settled

#: Characters of a chunk, and of the overlap with the next one.
CHUNK = 1 << 15
OVERLAP = 1 << 10
#: Pieces whose ids a Python worker remembers, twice.
REMEMBERED = 1 << 17
#: Texts whose ids leave a task together.
OUT_ROWS = 128
#: Bytes up to which a piece is merged by looking through all its pairs.
SHORT = 64


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """The vocabulary of a rank file: lines of a token in base 64 and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines.splitlines() if x.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: of all neighbouring parts, the pair of lowest rank is joined, the leftmost first, as long as one has a rank."""
    if piece in ranks:
        return [ranks[piece]]
    return (_merge_short if len(piece) <= SHORT else _merge_long)(piece, ranks)


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Looks through all pairs each time, which is quickest for words."""
    rank, none = ranks.get, 1 << 32
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [rank(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pairs and (lowest := min(pairs)) < none:
        i = pairs.index(lowest)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = rank(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = rank(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Keeps the pairs in a heap, so a long piece costs n log n."""
    n = len(piece)
    end = list(range(1, n + 1))  # where the part starting here ends; 0: no part starts here
    prev = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        middle = end[i]
        if not middle or middle >= n or not end[middle] or end[middle] != stop:
            continue  # one of the parts has changed since
        end[i], end[middle] = stop, 0
        if stop < n:
            prev[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heappush(heap, (r, i, end[stop]))
        if (j := prev[i]) >= 0 and (r := ranks.get(piece[j:stop])) is not None:
            heappush(heap, (r, j, stop))
    return [ranks[piece[i : end[i]]] for i in range(n) if end[i]]


class Codec(dict):
    """Little-endian ids of each piece of text, made when first asked for.

    Pieces asked for lately are remembered: when the table is full it becomes
    the old one, and what is asked for again moves back.
    """

    def __init__(self, vocabulary: bytes, pattern: str):
        super().__init__()
        self.ranks = read_ranks(vocabulary)
        self.split = regex.compile(pattern).findall
        self.old: dict[str, bytes] = {}
        self.tokens = np.full(max(self.ranks.values(), default=-1) + 1, b"", object)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(piece)
        if ids is None:
            ids = array("I", merge(piece.encode("utf-8", "surrogatepass"), self.ranks)).tobytes()
        self[piece] = ids
        return ids

    def encode(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.tokens[np.frombuffer(ids, "<u4")].tolist())


@functools.cache
def codec(vocabulary: bytes, pattern: str) -> Codec:
    """One for each Python worker and vocabulary."""
    return Codec(vocabulary, pattern)


def _shared(df: DataFrame, path: str) -> Broadcast[bytes]:
    """The rank file, read on the driver: executors need not have it.  Some hundred kilobytes."""
    with open(path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def stitch(chunks: list[tuple[list[str], int]], split: Callable[[str], list[str]]) -> list[str]:
    """The pieces of a text from the pieces of its chunks (pieces, start of the chunk), in order.

    Pieces that touch the end of a chunk are not sure unless the text ends there.
    """
    whole, ends = list(chunks[0][0]), np.cumsum([len(p) for p in chunks[0][0]]) + chunks[0][1]
    for pieces, start in chunks[1:]:
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]) + start
        limit = int(ends[-1]) if len(ends) else start
        # a piece next to the chunk's end could go on, and one before it could give it a blank
        sure = ends[:-2]
        common = np.intersect1d(sure[sure >= start], bounds)
        if len(common):
            cut = int(common[0])
            keep = int(np.searchsorted(ends, cut)) + 1
            after = int(np.searchsorted(bounds, cut))
            whole = whole[:keep] + pieces[after:]
            ends = np.concatenate([ends[:keep], bounds[after + 1 :]])
        else:
            keep = len(sure)
            begin = int(ends[keep - 1]) if keep else chunks[0][1]
            rest = "".join(whole[keep:]) + "".join(pieces)[limit - start :]
            again = split(rest)
            whole = whole[:keep] + again
            ends = np.concatenate([ends[:keep], np.cumsum([len(p) for p in again]) + begin]).astype(np.int64)
    return whole


CODED = "ids binary, decoded binary"


def _both(c: Codec, pieces: list[list[str]], back: bool) -> pd.DataFrame:
    """The ids of each text, and what they decode to if asked for."""
    ids = [c.encode(p) for p in pieces]
    return pd.DataFrame({"ids": ids, "decoded": [c.decode(x) for x in ids] if back else None}, dtype=object)


def _coded(rows: DataFrame, held: Broadcast[bytes], pattern: str, back: bool) -> DataFrame:
    """row, ids and decoded of rows (row); what comes out goes on in small parts, so a task holds one batch of texts and little else."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(held.value, pattern)
        for batch in batches:
            texts = batch.column(0).field("text")
            for at in range(0, len(batch), OUT_ROWS):
                ids = [c.encode(c.split(t or "")) for t in texts.slice(at, OUT_ROWS).to_pylist()]
                decoded = pa.array([c.decode(x) for x in ids], pa.binary()) if back else pa.nulls(len(ids), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, OUT_ROWS), pa.array(ids, pa.binary()), decoded], ["row", "ids", "decoded"])

    schema = T.StructType([rows.schema["row"]]).add("ids", T.BinaryType()).add("decoded", T.BinaryType())
    return rows.mapInArrow(coded, schema)


def _pieces(pattern: str):
    @F.pandas_udf("array<int>")
    def pieces(texts: pd.Series) -> pd.Series:
        split = regex.compile(pattern).findall
        return pd.Series([np.array([len(p) for p in split(t)], np.int32) for t in texts], dtype=object)

    return pieces


def _stitched(held: Broadcast[bytes], pattern: str, back: bool):
    @F.pandas_udf(CODED)
    def stitched(chunks: pd.Series) -> pd.DataFrame:
        c = codec(held.value, pattern)

        def texts():
            for rows in chunks:
                parts = []
                for r in rows:
                    edges = np.concatenate([[0], np.cumsum(np.asarray(r["sizes"], np.int64))]).tolist()
                    parts.append(([r["chunk"][a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)], int(r["start"])))
                yield stitch(parts, c.split)

        return _both(c, texts(), back)

    return stitched


def decode(coded: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Adds `decoded`, the bytes that a column of little-endian 32-bit ids stands for."""
    held = _shared(coded, path)

    @F.pandas_udf("binary")
    def back(column: pd.Series) -> pd.Series:
        c = codec(held.value, pattern)
        return pd.Series([c.decode(x or b"") for x in column], dtype=object)

    return coded.withColumn("decoded", back(ids))


def _encoded(docs: DataFrame, path: str, pattern: str, chunk: int, overlap: int, back: bool) -> DataFrame:
    held = _shared(docs, path)
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"))
    short = _coded(rows.filter(F.char_length(text) <= chunk), held, pattern, back)
    # stored with a number, as the chunks of equal rows must not be mixed up
    long = settled(
        rows.filter(F.char_length(text) > chunk).withColumn("number", F.monotonically_increasing_id()), "bpe-long"
    )
    starts = F.sequence(F.lit(0), F.char_length(text) - 1, F.lit(chunk))
    chunks = (
        long.select("number", F.explode(starts).alias("start"), text.alias("text"))
        .select("number", "start", F.substring("text", F.col("start") + 1, F.lit(chunk + overlap)).alias("chunk"))
        .repartition("number", "start")
        .withColumn("sizes", _pieces(pattern)("chunk"))
    )
    whole = (
        chunks.groupBy(F.col("number").alias("_number"))
        .agg(F.array_sort(F.collect_list(F.struct("start", "chunk", "sizes"))).alias("chunks"))
        .select("_number", _stitched(held, pattern, back)("chunks").alias("coded"))
    )
    joined = long.join(whole, F.col("number") == F.col("_number")).select("row", "coded.*")
    return short.unionByName(joined)


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """`row` and `ids`: the ids of each text as little-endian 32-bit integers.

    A text within one chunk is encoded where it was read.  A longer one is dealt
    out by chunk; only its chunks' pieces are gathered to be stitched.
    """
    return _encoded(docs, path, pattern, chunk, overlap, False).select("row", "ids")


def encode_and_decode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """`row`, ids, n_tokens and decoded (bytes), the ids turned back where they were made."""
    return _encoded(docs, path, pattern, chunk, overlap, True).select(
        "row", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "decoded"
    )
