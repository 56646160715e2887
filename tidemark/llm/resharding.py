"""Resharding by minimum-cost flow.

From the old shards' bytes and the new shards' capacities a flow decides how
many bytes go from where to where, moving as few as possible.  Inside an old
shard the documents are laid out in a fixed order and cut where its flows end;
only shards that gain or lose documents are written again.

Defined results: null text counts as empty; a document's size is its UTF-8
bytes plus 1.  Rows equal in doc_id and text tie and may swap slots.  An empty
table has no moves.  Extra columns stay in `row`.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import hex_fraction, row_key, settled

SHARDS = 16
BLOCK_DOCS = 4096


def min_cost_flow(n: int, edges: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow on each edge (from, to, capacity, cost >= 0) of a cheapest maximum flow.

    Successive shortest paths with potentials.  The graph has a node for each
    shard, so its size follows the number of shards and not the data.
    """
    to, left, cost, out = [], [], [], [[] for _ in range(n)]
    for a, b, cap, price in edges:
        for u, v, c, p in ((a, b, cap, price), (b, a, 0, -price)):
            out[u].append(len(to))
            to.append(v), left.append(c), cost.append(p)
    height = [0] * n
    while True:
        far, via, heap = [None] * n, [-1] * n, [(0, source)]
        far[source] = 0
        while heap:
            d, u = heapq.heappop(heap)
            if d > far[u]:
                continue
            for e in out[u]:
                v, way = to[e], d + cost[e] + height[u] - height[to[e]]
                if left[e] > 0 and (far[v] is None or way < far[v]):
                    far[v], via[v] = way, e
                    heapq.heappush(heap, (way, v))
        if far[sink] is None:
            return [left[2 * i + 1] for i in range(len(edges))]
        height = [h + (f if f is not None else far[sink]) for h, f in zip(height, far, strict=True)]
        path, v = [], sink
        while v != source:
            path.append(via[v])
            v = to[via[v] ^ 1]
        step = min(left[e] for e in path)
        for e in path:
            left[e] -= step
            left[e ^ 1] += step


def transfers(old: list[int], capacity: list[int]) -> list[tuple[int, int, int]]:
    """(old shard, new shard, bytes) of a cheapest resharding.

    Bytes that stay in the shard of their own number are free, a moved byte
    costs 1.  Moves pass through one hub, so there is an edge for each shard and
    not for each pair.
    """
    m, n = len(old), len(capacity)
    start, hub, end = m + n, m + n + 1, m + n + 2
    edges = [(start, i, size, 0) for i, size in enumerate(old)]
    edges += [(m + j, end, room, 0) for j, room in enumerate(capacity)]
    stay = len(edges)
    edges += [(i, m + i, old[i], 0) for i in range(min(m, n))]
    leave = len(edges)
    edges += [(i, hub, size, 1) for i, size in enumerate(old)]
    enter = len(edges)
    edges += [(hub, m + j, room, 0) for j, room in enumerate(capacity)]
    flow = min_cost_flow(m + n + 3, edges, start, end)
    moves = [(i, i, flow[stay + i]) for i in range(min(m, n)) if flow[stay + i]]
    wants = [[j, flow[enter + j]] for j in range(n) if flow[enter + j]]
    for i in range(m):
        gives = flow[leave + i]
        while gives:
            part = min(gives, wants[-1][1])
            moves.append((i, wants[-1][0], part))
            gives -= part
            wants[-1][1] -= part
            if not wants[-1][1]:
                wants.pop()
    return sorted(moves)


def _running(df: DataFrame, group: str, value: Column, name: str) -> DataFrame:
    """Adds the sum of `value` over the earlier rows of the group, in the order of `key`.

    Blocks are ranges of that order and hold a few thousand rows.  Sums within
    blocks and over the blocks of a group replace a window over a whole group.
    """
    sized = df.withColumn("_v", value)
    counts = sized.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS).alias("_n")).withColumnRenamed(group, "_g")
    dealt = (
        sized.join(F.broadcast(counts), F.col(group) == F.col("_g"))  # a row for each shard
        .withColumn("_block", F.floor(hex_fraction(F.col("key")) * F.col("_n")).cast("long"))
        .drop("_g", "_n")
    )
    earlier = Window.partitionBy("_bg").orderBy("_bb").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        dealt.groupBy(F.col(group).alias("_bg"), F.col("_block").alias("_bb"))
        .agg(F.sum("_v").alias("_sum"))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    )
    inside = Window.partitionBy(group, "_block").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.withColumn("_inside", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
        .join(blocks.drop("_sum"), (F.col(group) == F.col("_bg")) & (F.col("_block") == F.col("_bb")))
        .withColumn(name, (F.col("_before") + F.col("_inside")).cast("long"))
        .drop("_v", "_block", "_bg", "_bb", "_before", "_inside")
    )


def reshard(docs: DataFrame, old: Column, shards: int = SHARDS) -> DataFrame:
    """doc_id, key, size, text_crc32, old (its number), shard and slot of every document.

    `old` names the shard a document lies in now; names are numbered in order.
    Shard capacities are equal.  A document goes where its first byte falls.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    features = settled(
        docs.select(
            old.alias("old_name"),
            F.col("doc_id").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            row_key(F.col("doc_id"), F.col("text")).alias("key"),
        ),
        "reshard",
    )
    spark = docs.sparkSession
    # a row for each old shard: as many as the table has files
    names = sorted(((r[0], r[1]) for r in features.groupBy("old_name").agg(F.sum("size")).collect()), key=lambda r: (r[0] is not None, r[0] or ""))
    sizes = [size for _, size in names]
    total = sum(sizes)
    capacity = [total * (j + 1) // shards - total * j // shards for j in range(shards)]
    cuts, at = [], {}
    for i, j, part in transfers(sizes, capacity):
        cuts.append((i, j, at.get(i, 0), at.get(i, 0) + part))
        at[i] = at.get(i, 0) + part
    numbers = spark.createDataFrame([(name, i) for i, (name, _) in enumerate(names)], "name string, old int")
    moves = spark.createDataFrame(cuts, "cut_old int, shard int, lo long, hi long")
    numbered = features.join(F.broadcast(numbers), F.col("old_name").eqNullSafe(F.col("name"))).drop("old_name", "name")
    offset = _running(numbered, "old", F.col("size"), "offset")
    # at most a row for each old and each new shard
    placed = offset.join(
        F.broadcast(moves), (F.col("old") == F.col("cut_old")) & (F.col("offset") >= F.col("lo")) & (F.col("offset") < F.col("hi"))
    ).select("doc_id", "key", "size", "text_crc32", "old", "shard")
    return _running(settled(placed, "reshard-placed"), "shard", F.lit(1), "slot")


def rewrite(docs: DataFrame, placed: DataFrame, path: str) -> list[int]:
    """Writes the shards that gain or lose documents below `path`, by number; returns the numbers left as they are.

    `docs` are the documents that `placed` was made from.
    """
    counts = placed.groupBy("shard").agg(F.max((F.col("old") != F.col("shard")).cast("int")).alias("gains"))
    loses = placed.filter(F.col("old") != F.col("shard")).select(F.col("old").alias("lost")).distinct()
    state = counts.join(loses, F.col("shard") == F.col("lost"), "left").select(
        "shard", ((F.col("gains") == 1) | F.col("lost").isNotNull()).alias("changed")
    )
    rows = state.collect()  # a row for each shard
    changed = [r["shard"] for r in rows if r["changed"]]
    places = placed.filter(F.col("shard").isin(changed)).select(
        F.col("key").alias("_key"), "shard", "slot", F.row_number().over(Window.partitionBy("key").orderBy("slot")).alias("_turn")
    )
    # rows equal in doc_id and text share a key: they are told apart by a number
    keyed = docs.select(F.struct("*").alias("row"), row_key(F.col("doc_id"), F.col("text")).alias("key")).withColumn(
        "turn", F.row_number().over(Window.partitionBy("key").orderBy("key"))
    )
    keyed.join(places, (F.col("key") == F.col("_key")) & (F.col("turn") == F.col("_turn"))).select(
        "row", "shard", "slot"
    ).repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return sorted(r["shard"] for r in rows if not r["changed"])
