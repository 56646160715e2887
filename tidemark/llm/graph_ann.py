"""Approximate nearest neighbours by a robust-pruned directed graph for each shard.

Vectors are dealt out to shards of a few thousand; within one, points are added
in batches: a greedy beam search over the graph so far proposes neighbours, and
relaxed distance pruning keeps diverse edges.  Queries run a beam search in each
shard, and the best of all shards count.  Nearness is cosine, so graphs are
built on unit vectors; scores are recomputed in double precision from the
vectors as they came.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part.  Vectors of different lengths never meet.  Equal
vectors are one node that keeps its smallest ids: more than k of them can't be
among any k nearest, the query's own row left aside.  Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import settled

DEGREE = 32
BEAM = 64
#: Edges to points this much nearer to a kept neighbour than to the point itself are dropped.
ALPHA = 1.2
SHARD_ROWS = 4096
BATCH = 256
QUERY_BLOCK = 512


def beam_search(points: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The `beam` nearest points found for each query and their similarities (-inf where there are fewer).

    `edges` has a row of neighbours for each point, filled up with -1.  All
    queries advance together: each expands its nearest point not yet expanded.
    """
    m, n = len(queries), len(points)
    rows = np.arange(m)[:, None]
    ids = np.full((m, beam), n, np.int64)
    sims = np.full((m, beam), -np.inf, np.float32)
    done = np.ones((m, beam), bool)
    seen = np.zeros((m, n + 1), bool)
    ids[:, 0], sims[:, 0], done[:, 0] = entry, queries @ points[entry], False
    seen[:, [entry, n]] = True
    live = np.arange(m)
    while len(live):
        best = np.argmax(~done[live], 1)  # beams are sorted: the first one open is the nearest
        done[live, best] = True
        near = edges[ids[live, best]]
        near = np.where(near < 0, n, near)
        fresh = ~seen[live[:, None], near]
        seen[live[:, None], near] = True
        sim = np.einsum("qd,qkd->qk", queries[live], points[np.minimum(near, n - 1)])
        sim[~fresh] = -np.inf
        all_ids = np.concatenate([ids[live], np.where(fresh, near, n)], 1)
        all_sims = np.concatenate([sims[live], sim], 1)
        all_done = np.concatenate([done[live], ~fresh], 1)
        order = np.argsort(-all_sims, 1, kind="stable")[:, :beam]
        at = np.arange(len(live))[:, None]
        ids[live], sims[live], done[live] = all_ids[at, order], all_sims[at, order], all_done[at, order]
        live = live[~done[live].all(1)]
    del rows
    return ids, sims


def robust_prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to `degree` diverse neighbours of each point, from rows of candidates (-1: none).

    The nearest candidate stays, and those that it lies nearer to, by the factor
    alpha, than the point does go; and so on.
    """
    m, _ = candidates.shape
    ordered = np.sort(candidates, 1)
    repeat = np.concatenate([np.zeros((m, 1), bool), ordered[:, 1:] == ordered[:, :-1]], 1)
    valid = (ordered >= 0) & ~repeat & (ordered != own[:, None])
    vectors = points[np.maximum(ordered, 0)]
    base = points[own]
    far = np.where(valid, np.maximum(0, 2 - 2 * np.einsum("md,mcd->mc", base, vectors)), np.inf)
    out = np.full((m, degree), -1, np.int64)
    rows = np.arange(m)
    for k in range(degree):
        best = np.argmin(far, 1)
        ok = np.isfinite(far[rows, best])
        if not ok.any():
            break
        out[ok, k] = ordered[rows, best][ok]
        apart = np.maximum(0, 2 - 2 * np.einsum("md,mcd->mc", vectors[rows, best], vectors))
        far[(alpha * alpha * apart <= far) & ok[:, None]] = np.inf  # squared distances
        far[rows, best] = np.inf
    return out


def build_graph(points: np.ndarray) -> tuple[np.ndarray, int]:
    """Edges of a graph over unit vectors, and the point where searches start."""
    n = len(points)
    edges = np.full((n, DEGREE), -1, np.int64)
    entry = int(np.argmax(points @ points.mean(0)))
    order = np.random.default_rng(10).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    for alpha in (1.0, ALPHA):
        at, size = (1, 1) if alpha == 1.0 else (0, BATCH)
        while at < n:
            batch = order[at : at + size]
            found, _ = beam_search(points, edges, entry, points[batch], BEAM)
            found = np.where(found == n, -1, found)
            found[found == batch[:, None]] = -1
            edges[batch] = robust_prune(points, batch, np.concatenate([found, edges[batch]], 1), DEGREE, alpha)
            _add_reverse(points, edges, batch, alpha)
            at += size
            size = min(BATCH, max(size, at))
    return edges, entry


def _add_reverse(points: np.ndarray, edges: np.ndarray, batch: np.ndarray, alpha: float) -> None:
    """Edges back to the batch from the neighbours it chose; those with too many are pruned again."""
    heads, tails = edges[batch].ravel(), np.repeat(batch, edges.shape[1])
    tails, heads = tails[heads >= 0], heads[heads >= 0]
    known = (edges[heads] == tails[:, None]).any(1)
    order = np.argsort(heads[~known], kind="stable")
    heads, tails = heads[~known][order], tails[~known][order]
    if not len(heads):
        return
    first = np.flatnonzero(np.r_[True, heads[1:] != heads[:-1]])
    count = np.diff(np.append(first, len(heads)))
    own = heads[first]
    free = (edges[own] < 0).sum(1)
    fits = count <= free
    slot = np.arange(len(heads)) - np.repeat(first, count)
    easy = np.repeat(fits, count)
    edges[heads[easy], np.repeat(edges.shape[1] - free, count)[easy] + slot[easy]] = tails[easy]
    for at in np.flatnonzero(~fits).tolist():
        more = tails[first[at] : first[at] + count[at]]
        edges[own[at]] = robust_prune(points, own[at : at + 1], np.concatenate([edges[own[at]], more])[None], edges.shape[1], alpha)[0]


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)  # no overflow in the squares
    return (scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))).astype(np.float32)


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Double-precision cosines of a vector with rows."""
    dots = vectors @ query
    return dots / (np.sqrt((vectors * vectors).sum(1)) * np.sqrt((query * query).sum()))


def search_shard(vectors: np.ndarray, queries: np.ndarray, take: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query, the nearest `take` rows that the shard's graph finds, with their cosines."""
    points = _unit(vectors)
    edges, entry = build_graph(points)
    units = _unit(queries)
    for at in range(0, len(queries), QUERY_BLOCK):
        found, _ = beam_search(points, edges, entry, units[at : at + QUERY_BLOCK], BEAM)
        for i, row in enumerate(found):
            row = row[row < len(points)]
            score = cosines(queries[at + i], vectors[row])
            best = np.lexsort((row, -score))[:take]
            yield at + i, row[best], score[best]


def _valid(vector):
    return (
        vector.isNotNull()
        & (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )


def _searcher(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard, a shard's nodes before its queries."""

        def done(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            nodes = [r for r in rows if r[1] is None]
            asked = [r for r in rows if r[1] is not None]
            if not nodes or not asked:
                return
            ids = [r[2] for r in nodes]
            out = []
            queries = np.array([r[3] for r in asked], np.float64)
            # one more, as the query's own row may be the only one of its node
            for q, found, score in search_shard(np.array([r[3] for r in nodes], np.float64), queries, k + 1):
                own = asked[q][1]
                out += [(own, i, float(s)) for at, s in zip(found.tolist(), score, strict=True) for i in ids[at] if i != own]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.float64()), strict=True)],
                    ["query_id", "vec_id", "score"],
                )

        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[-1][0] != row[0]:
                    yield from done(held)
                    held = []
                held.append(row)
        if held:
            yield from done(held)

    return search


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found for each query.

    `vectors` and `queries` have vec_id and embedding; a query's own id is left
    out.  Every query meets every shard: the graph of a shard is searched by
    blocks of queries.
    """
    def cleaned(df: DataFrame) -> DataFrame:
        wide = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
        return wide.filter(F.col("vec_id").isNotNull() & _valid(F.col("v")))

    # of equal vectors the smallest ids; map tasks keep no more than these either
    few = Window.partitionBy("v").orderBy("vec_id")
    nodes = settled(
        cleaned(vectors)
        .dropDuplicates()
        .withColumn("turn", F.row_number().over(few))
        .filter(F.col("turn") <= k + 1)
        .groupBy("v")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .withColumn("dim", F.size("v")),
        "ann-nodes",
    )
    sizes = nodes.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("shards"))
    dealt = nodes.join(sizes, "dim").select(
        F.struct("dim", F.pmod(F.xxhash64("v"), F.col("shards")).cast("int").alias("n")).alias("shard"),
        F.lit(None).cast("long").alias("query_id"), "ids", "v",
    )
    asked = (
        cleaned(queries).dropDuplicates(["vec_id"]).withColumn("dim", F.size("v")).join(sizes, "dim")
        .withColumn("n", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
        .select(F.struct("dim", "n").alias("shard"), F.col("vec_id").alias("query_id"), F.lit(None).cast("array<long>").alias("ids"), "v")
    )
    rows = (
        dealt.unionByName(asked)
        .select(F.concat_ws("-", "shard.dim", "shard.n").alias("shard"), "query_id", "ids", "v")
        .repartition("shard")
        .sortWithinPartitions(F.col("shard"), F.col("query_id").asc_nulls_first())
    )
    found = rows.mapInArrow(_searcher(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
