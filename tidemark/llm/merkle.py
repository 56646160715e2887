"""Merkle manifest of a table: cogrouped subtree exchange.

Every row is a leaf.  The leaves of a source, in order of doc_id, are the lowest
nodes of the source's tree; 16 neighbours make a node of the next level, until
one is left.  The sources' tops are the lowest nodes of the root's tree.

A superblock holds 16^3 neighbours of one tree.  Going up, each superblock is
reduced to its top in one task, and the tops are the nodes of the next table: a
tree of any size takes a few rounds, and a large source is dealt over many tasks.
Going down, each superblock's nodes are cogrouped with the one row that holds
the outer nodes its proofs need, at most 15 a level; the task finishes the local
levels, joins local and outer siblings to a proof for each node, and at the
leaves folds what a checker would fold.

Defined results: null columns are `-` in the leaf; null text stays null when
tampered with.  In a source, null doc_id comes first and rows of equal doc_id
are in order of their leaves, so equal rows are neighbours with proofs of their
own.  Extra columns are not read; an empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ranked, settled

FANOUT = 16
#: Levels that one superblock spans.
LEVELS = 3
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: The siblings of a node on its way up: for each level their digests joined, those to the left and those to the right.
PATH = "lefts array<string>, rights array<string>"
Path = list[tuple[str, str]]


def _hash(joined: str) -> str:
    return hashlib.sha256(joined.encode("ascii")).hexdigest()


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(text: Column) -> Column:
    """The leaf of a row whose text is `text`."""
    return F.sha2(F.concat(*(_field(text if c == "text" else F.col(c)) for c in FIELDS)), 256)


# -- one superblock ----------------------------------------------------------


def runs(level: list[str]) -> list[list[str]]:
    return [level[i : i + FANOUT] for i in range(0, len(level), FANOUT)]


def local_levels(nodes: list[str], span: int | None) -> list[list[str]]:
    """The nodes and the `span` levels above them; None: the tree has no other superblock, and ends with the top of this one."""
    levels = [nodes]
    while (len(levels[-1]) > 1) if span is None else (len(levels) <= span):
        levels.append([_hash("".join(run)) for run in runs(levels[-1])])
    return levels


def local_paths(levels: list[list[str]]) -> list[Path]:
    """For each lowest node the siblings at each level but the top's own."""
    sides = []
    for level in levels[:-1]:
        at: Path = []
        for run in runs(level):
            joined, width = "".join(run), len(run[0])
            at.extend((joined[: i * width], joined[(i + 1) * width :]) for i in range(len(run)))
        sides.append(at)
    return [[at[i // FANOUT**k] for k, at in enumerate(sides)] for i in range(len(levels[0]))]


def proof_digest(path: Path) -> str:
    return _hash("".join(left + right for left, right in path))


def fold(digest: str, path: Path) -> str:
    """The root that follows from a digest and its siblings."""
    for left, right in path:
        digest = _hash(left + digest + right)
    return digest


def _local(nodes: pd.DataFrame) -> list[list[str]]:
    span = nodes["span"].iloc[0]
    return local_levels(nodes["digest"].tolist(), int(span) if span else None)


def _top(nodes: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("idx")
    first = nodes.iloc[0]
    return pd.DataFrame({"tree": [first["tree"]], "idx": [first["block"]], "digest": [_local(nodes)[-1][0]]})


def _paths(nodes: pd.DataFrame, outer: pd.DataFrame) -> tuple[pd.DataFrame, list[Path]]:
    nodes = nodes.sort_values("idx")
    local = local_paths(_local(nodes))
    above = list(zip(outer["lefts"].iloc[0], outer["rights"].iloc[0], strict=True))
    return nodes, [path + above for path in local]


def _node_paths(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    nodes, paths = _paths(nodes, outer)
    sides = {side: [[step[k] for step in path] for path in paths] for k, side in enumerate(("lefts", "rights"))}
    return pd.DataFrame({"tree": nodes["tree"], "idx": nodes["idx"], **sides})


def _checked(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    nodes, paths = _paths(nodes, outer)
    tampered = nodes["tampered"].where(nodes["tampered"].notna(), nodes["digest"])
    return pd.DataFrame(
        {
            "tree": nodes["tree"], "idx": nodes["idx"], "doc_id": nodes["doc_id"], "leaf": nodes["digest"],
            "proof_sha256": [proof_digest(p) for p in paths],
            "folded_root": [fold(d, p) for d, p in zip(tampered, paths, strict=True)],
        }
    )


# -- trees -------------------------------------------------------------------


def placed(rows: DataFrame, group: list[str], order: list[str], purpose: str) -> DataFrame:
    """Adds `idx`, the place of each row in its group from 0, and `n_nodes`, the rows of the group; stored.

    Rows are sorted over all tasks; what a task holds of a group is counted, and
    only these counts, one for each group and task, go through a window.
    """
    numbered = ranked(rows, [*group, *order], "_at", purpose).withColumn("_task", F.shiftright("_at", 33))
    own = Window.partitionBy(*(f"_{c}" for c in group))
    ahead = own.orderBy("_held_by").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        numbered.groupBy(*(F.col(c).alias(f"_{c}") for c in group), F.col("_task").alias("_held_by"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_from"))
        .withColumns({"_before": F.coalesce(F.sum("_n").over(ahead), F.lit(0).cast("long")), "n_nodes": F.sum("_n").over(own)})
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group]
    found = numbered.join(counts, [*same, F.col("_task") == F.col("_held_by")])
    return settled(
        found.select(*rows.columns, (F.col("_at") - F.col("_from") + F.col("_before")).alias("idx"), "n_nodes"), f"{purpose}-placed"
    )


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """Adds the superblock and the levels it spans, 0 where it is the only one of its tree."""
    width = FANOUT**levels
    return nodes.withColumns(
        {"block": F.floor(F.col("idx") / width), "span": F.when(F.col("n_nodes") > width, levels).otherwise(0)}
    )


def _tops(nodes: DataFrame, levels: int, purpose: str) -> tuple[list[DataFrame], DataFrame]:
    """The tables of nodes (tree, idx, digest, n_nodes) from the given one up, and the trees' tops (tree, digest)."""
    tables, tops = [nodes], None
    while True:
        below = _blocks(tables[-1], levels)
        reduced = below.select("tree", "idx", "digest", "block", "span").groupBy("tree", "block").applyInPandas(
            _top, "tree long, idx long, digest string"
        )
        sizes = below.filter(F.col("idx") == 0).select(F.col("tree").alias("_tree"), F.ceil(F.col("n_nodes") / FANOUT**levels).alias("n_nodes"))
        made = settled(reduced.join(sizes, F.col("tree") == F.col("_tree")).drop("_tree"), f"{purpose}-nodes")
        ended = made.filter("n_nodes = 1").select("tree", "digest")
        tops = ended if tops is None else tops.union(ended)
        made = made.filter("n_nodes > 1")
        if made.isEmpty():
            return tables, tops
        tables.append(made)


def _cogrouped(nodes: DataFrame, outer: DataFrame, levels: int, function: Callable, schema: str) -> DataFrame:
    """`function` of each superblock's nodes and its row of outer nodes."""
    # both sides may come from one table, so the keys of one get names of their own
    outer = outer.select(F.col("tree").alias("_tree"), F.col("block").alias("_block"), "lefts", "rights")
    return _blocks(nodes, levels).groupBy("tree", "block").cogroup(outer.groupBy("_tree", "_block")).applyInPandas(function, schema)


def _descended(tables: list[DataFrame], tops: DataFrame, levels: int, purpose: str) -> DataFrame:
    """The outer nodes (tree, block, lefts, rights) of the lowest table's superblocks; `tops`: those of each tree's top.

    A tree joins in at the table in which it has one superblock.
    """
    outer = None
    for nodes in reversed(tables):
        ending = nodes.filter((F.col("idx") == 0) & (F.col("n_nodes") <= FANOUT**levels)).select(F.col("tree").alias("_tree"))
        joining = tops.join(ending, F.col("tree") == F.col("_tree")).select("tree", F.lit(0).cast("long").alias("block"), "lefts", "rights")
        outer = joining if outer is None else outer.union(joining)
        if nodes is not tables[0]:
            found = _cogrouped(nodes, outer, levels, _node_paths, f"tree long, idx long, {PATH}")
            outer = settled(found.withColumnRenamed("idx", "block"), f"{purpose}-outer").select("tree", "block", "lefts", "rights")
    return outer


def manifest(docs: DataFrame, tampered: Column | None = None, touched: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    `tampered` is the text that a checker meets in the rows where `touched`
    holds; the root is folded from that and from the original siblings.  A superblock spans `levels`.
    """
    kept = docs.select(*FIELDS, (F.lit(None).cast("string") if tampered is None else F.when(touched, leaf(tampered))).alias("tampered"))
    leaves = placed(kept.select("source", "doc_id", leaf(F.col("text")).alias("digest"), "tampered"), ["source"], ["doc_id", "digest"], "merkle-leaves")
    sources = placed(leaves.filter("idx = 0").select("source").withColumn("_one", F.lit(0)), ["_one"], ["source"], "merkle-sources")
    trees = sources.select(F.col("source").alias("_source"), F.col("idx").alias("tree"))
    low = settled(leaves.join(trees, F.col("source").eqNullSafe(F.col("_source"))).drop("_source"), "merkle-lowest")
    tables, subroots = _tops(low, levels, "merkle-source")
    subroots = settled(subroots, "merkle-subroots")

    whole = settled(
        subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), "digest").join(sources.select(F.col("idx").alias("_idx"), "n_nodes"), F.col("idx") == F.col("_idx")).drop("_idx"),
        "merkle-root",
    )
    upper, root = _tops(whole, levels, "merkle-root")
    top = root.first()  # one digest, or none where no row is
    nothing = F.array().cast("array<string>")
    above = _descended(upper, root.select("tree", nothing.alias("lefts"), nothing.alias("rights")), levels, "merkle-root")
    of_source = _cogrouped(whole, above, levels, _node_paths, f"tree long, idx long, {PATH}")
    paths = settled(of_source.select(F.col("idx").alias("tree"), "lefts", "rights"), "merkle-source-paths")

    outer = _descended(tables, paths, levels, "merkle-source")
    schema = "tree long, idx long, doc_id string, leaf string, proof_sha256 string, folded_root string"
    # pandas holds integers with nulls as floats, so doc_id passes as text
    nodes = low.select("tree", "idx", "n_nodes", "digest", "tampered", F.col("doc_id").cast("string"))
    found = _cogrouped(nodes, outer, levels, _checked, schema)
    tops = subroots.select(F.col("tree").alias("_tree"), F.col("digest").alias("subroot"))
    named = trees.join(tops, F.col("tree") == F.col("_tree")).select(F.col("tree").alias("_of"), F.col("_source").alias("source"), "subroot")
    return (
        found.join(named, F.col("tree") == F.col("_of"))
        .withColumn("root", F.lit(top["digest"] if top else None).cast("string"))
        .select(
            F.col("doc_id").cast(docs.schema["doc_id"].dataType), "source", "leaf", "subroot", "root", "proof_sha256", "folded_root",
            (F.col("folded_root") == F.col("root")).alias("verified"),
        )
    )


def lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
