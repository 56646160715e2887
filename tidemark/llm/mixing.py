"""Mixing sources to target weights by Sainte-Laguë apportionment.

Targets share a multiple of all words by weight, capped at twice a source.  The
words are handed out as equal blocks: quotas for the sources, then for the
shards of each source, both by highest quotients; within a shard the blocks are
laid over its documents in seeded order and the quota takes the first of them.
Built-in expressions only.

Defined results: null text has size 0 and takes nothing; the null source comes
last.  Rows equal in doc_id and text are documents of their own that tie, so
which of them takes a partial block cannot be told apart.  Shards hold a few
thousand documents, so a source with a third of all rows is split like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import hex_fraction, row_key, settled, words

SHARE = 1.5
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 2
BLOCK_WORDS = 8
SHARD_DOCS = 4096


def source_targets(sources: DataFrame) -> DataFrame:
    """Adds `target` to rows (source, source_size); one row for each source passes here, no documents.

    With caps in order of cap / weight, the sources before some place are full
    and the rest share what is left by weight; the place is the first whose
    level stays below its own cap.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_ratio = Window.orderBy("ratio", "place")
    whole = Window.partitionBy()
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.col("place") - 1, F.lit(len(WEIGHTS))))
    return (
        sources.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("cap", MAX_REPEAT * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("turn", F.row_number().over(by_ratio))
        .withColumn("full", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.lit(SHARE) * F.sum("source_size").over(whole) - F.col("full")) / F.col("open"))
        .withColumn("first", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("turn", "level"))).over(whole))
        .withColumn(
            "target",
            F.when(F.col("turn") < F.col("first.turn"), F.col("cap").cast("double"))
            .otherwise(F.col("weight") * F.col("first.level")),
        )
        .select("source", "source_size", "n_docs", "target")
    )


def sainte_lague(votes: DataFrame, group: list[str], keys: list[str]) -> DataFrame:
    """Adds `quota`: the `seats` of each group handed to its rows by the highest quotients votes / (2k + 1).

    Rounding votes * seats / all votes is the same method with a divisor that
    may miss the number of seats by less than one a row; the difference is
    settled by sorting the quotients around that point, so the work follows the
    rows and not the seats.  Ties go to the smaller keys.
    """
    in_group = Window.partitionBy(*group)
    start = (
        votes.withColumn("_sum", F.sum("votes").over(in_group))
        .withColumn("_rows", F.count(F.lit(1)).over(in_group))
        .withColumn("_base", F.when(F.col("_sum") > 0, F.floor(F.col("votes") * F.col("seats") / F.col("_sum") + 0.5)).otherwise(0).cast("long"))
        .withColumn("_miss", F.when(F.col("_sum") > 0, F.col("seats") - F.sum("_base").over(in_group)).otherwise(0))
    )
    reach = F.ceil((F.abs("_miss") + F.col("_rows")) * F.col("votes") / F.col("_sum")).cast("int") + 2
    steps = start.filter((F.col("_miss") != 0) & (F.col("votes") > 0)).withColumn("_step", F.explode(F.sequence(F.lit(0), reach)))
    quotient = F.when(F.col("_miss") > 0, F.col("votes") / (2 * (F.col("_base") + F.col("_step")) + 1)).otherwise(
        F.col("votes") / (2 * (F.col("_base") - F.col("_step")) - 1)
    )
    best = Window.partitionBy(*group).orderBy(
        F.when(F.col("_miss") > 0, -F.col("_q")).otherwise(F.col("_q")), *keys, "_step"
    )
    changed = (
        steps.filter((F.col("_miss") > 0) | (F.col("_step") < F.col("_base")))
        .withColumn("_q", quotient)
        .withColumn("_turn", F.row_number().over(best))
        .filter(F.col("_turn") <= F.abs("_miss"))
        .groupBy(*(F.col(k).alias(f"_{k}") for k in [*group, *keys]))
        .agg(F.sum(F.signum("_miss")).cast("long").alias("_change"))
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in [*group, *keys]]
    return start.join(changed, same, "left").select(
        *votes.columns, (F.col("_base") + F.coalesce("_change", F.lit(0))).alias("quota")
    )


def _features(docs: DataFrame, *more: str) -> DataFrame:
    """Size and key of each document; with `row` asked for, the document itself as well."""
    kept = [F.struct("*").alias("row")] if "row" in more else []
    return docs.select(
        *kept,
        F.col("doc_id").alias("doc_id"),
        F.col("source").alias("source"),
        F.size(words(F.col("text"))).cast("long").alias("size"),
        row_key(F.col("doc_id"), F.col("text")).alias("key"),
    )


def in_shards(features: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds each source's values and the shard, a range of the seeded order."""
    held = sources.select(F.col("source").alias("_source"), *(c for c in sources.columns if c != "source"))
    return (
        features.join(held, F.col("source").eqNullSafe(F.col("_source")), "left")
        .drop("_source")
        .withColumn("shard", F.floor(hex_fraction(F.col("key")) * F.ceil(F.col("n_docs") / SHARD_DOCS)).cast("long"))
    )


def shard_quotas(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row for each source (its target and quota), and one for each shard (the words to take from it)."""
    sources = features.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = settled(source_targets(sources), "mix-targets")
    votes = targets.withColumn("votes", F.col("target")).withColumn(
        "seats", F.floor(F.sum("target").over(Window.partitionBy()) / BLOCK_WORDS + 0.5)
    )
    seated = settled(
        sainte_lague(votes, [], ["source"]).select("source", "source_size", "n_docs", "target", "quota"), "mix-sources"
    )
    shards = (
        in_shards(features, seated)
        .groupBy("source", "shard")
        .agg(F.sum("size").alias("shard_size"), F.first("quota").alias("seats"))
        .withColumn("votes", F.col("shard_size"))
    )
    quotas = sainte_lague(shards, ["source"], ["shard"]).select(
        F.col("source").alias("_source"),
        F.col("shard").alias("_shard"),
        "shard_size",
        F.least(F.col("quota") * BLOCK_WORDS, MAX_REPEAT * F.col("shard_size")).alias("quota_words"),
    )
    return seated, settled(quotas, "mix-shards")


def _taken(features: DataFrame, seated: DataFrame, quotas: DataFrame) -> DataFrame:
    order = Window.partitionBy("source", "shard").orderBy("key", "doc_id")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rounds = F.when(F.col("shard_size") > 0, F.floor(F.col("quota_words") / F.col("shard_size"))).otherwise(F.lit(0))
    rest = F.col("quota_words") - F.col("rounds") * F.col("shard_size")
    return (
        in_shards(features, seated.drop("quota"))
        .withColumn("before", before)
        .join(quotas, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")))
        .withColumn("rounds", rounds)
        .withColumn("partial", F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before"))))
        .withColumn("taken", (F.col("rounds") * F.col("size") + F.col("partial")).cast("long"))
    )


def mixed(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target and `taken`, the words the mix takes of each document."""
    features = settled(_features(docs), "mix")
    return _taken(features, *shard_quotas(features)).select(
        "doc_id", "source", "size", "source_size", "target", "taken"
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of `docs`: whole copies, and a shortened copy where a quota ends inside.

    Documents of which nothing is taken go.  A shortened copy holds the first
    taken words, one blank between them.
    """
    seated, quotas = shard_quotas(settled(_features(docs), "mix"))
    taken = _taken(_features(docs, "row"), seated, quotas).filter(F.col("taken") > 0)
    copies = F.array_repeat(F.lit(None).cast("long"), F.floor(F.col("taken") / F.col("size")).cast("int"))
    left = F.col("taken") % F.col("size")
    parts = taken.withColumn(
        "part", F.explode(F.concat(copies, F.when(left > 0, F.array(left)).otherwise(F.array().cast("array<long>"))))
    )
    short = F.array_join(F.slice(words(F.col("row.text")), 1, F.col("part").cast("int")), " ")
    return parts.select(
        *(
            F.when(F.col("part").isNull(), F.col("row.text")).otherwise(short).alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c)
            for c in docs.columns
        )
    )
