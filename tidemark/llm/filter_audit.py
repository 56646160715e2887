"""Filter interaction audit by the Hart-Mas-Colell potential.

Five filters drop documents.  For every part of the corpus the removal game is
worth, to a coalition of filters, the documents that at least one of them drops.
The potential of a coalition is what it is worth plus the potentials without each
of its members, divided by its size; a filter's Shapley value is the potential of
all five less the potential without it.  As the part of a step in any order is
the difference of two coalitions, 32 coalitions answer all 120 orders.

Documents count by the set of filters that they fail, at most 32 rows for each
part, so what follows the counting does not grow with the corpus.  Built-in
expressions only.

Defined results: null text is empty; null source and the empty one are one part.
A filter without words to look at (none, or an empty text) fails A only.  Rows
equal in text: those of the smallest doc_id pass E, null doc_id coming last, so
rows that repeat it pass together.  A document with several labels has a label
where one of them says so; a null doc_id has none.  Extra columns are not read;
an empty table has no parts.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import words

FILTERS = "ABCDE"
COALITIONS = 1 << len(FILTERS)
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITAL_PERCENT = 5
#: What is counted of the documents: all, those labelled good, those labelled toxic.
COUNTED = ["n", "good", "toxic"]


def _of_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, doc_id, digest of the text, the filters of one document that it fails as bits, and its counts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = docs.select(
        F.coalesce(F.col("source"), F.lit("")).alias("part"), F.col("doc_id").alias("doc_id"), text.alias("text")
    ).select("part", "doc_id", "text", words(F.col("text")).alias("ws"))
    capitals = F.char_length("text") - F.char_length(F.regexp_replace("text", "[A-Z]+", ""))
    fails = [
        F.size("ws") < MIN_WORDS,
        100 * F.size(F.array_distinct("ws")) < MIN_DISTINCT_PERCENT * F.size("ws"),
        100 * capitals > MAX_CAPITAL_PERCENT * F.char_length("text"),
        F.col("text").rlike(r"[#$%&*|]"),
    ]
    mask = sum((F.when(f, F.lit(1 << i)).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    measured = plain.select("part", "doc_id", F.sha2("text", 256).alias("digest"), mask.alias("mask"))
    known = labels.groupBy(F.col("doc_id").alias("_doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")
    )
    return measured.join(known, F.col("doc_id") == F.col("_doc_id"), "left").select(
        "part", "doc_id", "digest", "mask", F.lit(1).cast("long").alias("n"),
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("good", "toxic")),
    )


def failure_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (the filters failed, as bits) and the counts of its documents.

    Copies of a text fail the same filters but for E, so they are counted for
    each text and part, combined where they are read; what meets at one text is
    a row for each part, not a row for each copy.
    """
    rows = _of_rows(docs, labels)
    place = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc_id"))
    same_id = rows.groupBy("digest", "part", "doc_id").agg(F.min("mask").alias("mask"), *(F.sum(c).alias(c) for c in COUNTED))
    copies = same_id.groupBy("digest", "part").agg(
        F.min("mask").alias("mask"),
        F.min(F.struct(place.alias("place"), *COUNTED)).alias("first"),
        *(F.sum(c).alias(c) for c in COUNTED),
    )
    smallest = copies.groupBy(F.col("digest").alias("_digest")).agg(F.min("first.place").alias("place"))
    own = F.col("first.place") == F.col("place")
    passing = [F.when(own, F.col(f"first.{c}")).otherwise(F.lit(0).cast("long")) for c in COUNTED]
    pieces = [
        F.struct(F.col("mask").alias("mask"), *(p.alias(c) for p, c in zip(passing, COUNTED, strict=True))),
        F.struct(
            F.col("mask").bitwiseOR(F.lit(1 << FILTERS.index("E"))).alias("mask"),
            *((F.col(c) - p).alias(c) for p, c in zip(passing, COUNTED, strict=True)),
        ),
    ]
    return (
        copies.join(smallest, F.col("digest") == F.col("_digest"))
        .select("part", F.explode(F.array(*pieces)).alias("piece"))
        .select("part", "piece.*")
        .groupBy("part", "mask")
        .agg(*(F.sum(c).alias(c) for c in COUNTED))
    )


def worths(sets: DataFrame) -> DataFrame:
    """For each part its total and, as arrays by coalition, the documents (all, good, toxic) that the coalition drops."""
    met = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    by_coalition = (
        sets.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit(COALITIONS - 1))))
        .groupBy("part", "coalition")
        .agg(F.sum("n").alias("total"), *(F.sum(F.when(met, F.col(c)).otherwise(F.lit(0).cast("long"))).alias(c) for c in COUNTED))
    )
    lined = F.array_sort(F.collect_list(F.struct("coalition", *COUNTED)))  # 32 rows
    return (
        by_coalition.groupBy("part")
        .agg(F.max("total").alias("total"), lined.alias("lined"))
        .select("part", "total", *(F.col(f"lined.{c}").alias(c) for c in COUNTED))
    )


def potentials(worth: Column) -> Column:
    """The potential of each coalition times the factorial of its size, which keeps it whole.

    Of size * P(S) = worth(S) + sum of P(S without i), both sides times
    (size - 1)!.  Subsets have smaller numbers, so one pass in order suffices.
    """

    def next_one(made: Column, s: Column) -> Column:
        size = F.bit_count(s)
        scale = F.element_at(F.array(*(F.lit(factorial(k)).cast("long") for k in range(len(FILTERS)))), size.cast("int"))
        below = [
            F.when(s.bitwiseAND(F.lit(1 << i)) != 0, F.get(made, s.bitwiseAND(F.lit(COALITIONS - 1 - (1 << i))))).otherwise(F.lit(0).cast("long"))
            for i in range(len(FILTERS))
        ]
        return F.concat(made, F.array(scale * F.get(worth, s) + sum(below[1:], below[0])))

    return F.aggregate(F.sequence(F.lit(1), F.lit(COALITIONS - 1)), F.array(F.lit(0).cast("long")), next_one)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, the filter of the step, and what it does there, for all 120 orders.

    kept and removed: after and by this step; redundant: fail the filter but
    were removed earlier; unique_fails: fail this filter only; good_lost and
    toxic_lost: labelled documents removed here; shapley: what the filter
    removes, summed over all orders.
    """
    n_filters, everything = len(FILTERS), F.lit(COALITIONS - 1)
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    bits = [F.when(F.instr(F.col("earlier"), c) > 0, F.lit(1 << i)).otherwise(0) for i, c in enumerate(FILTERS)]
    steps = (
        worths(failure_sets(docs, labels))
        .withColumn("potential", potentials(F.col("n")))
        .withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n_filters))))
        .withColumn("filter", letter)
        .withColumn("earlier", F.substring("filter_order", F.lit(1), F.col("step") - 1))
        .withColumn("own", F.pow(F.lit(2), F.instr(F.lit(FILTERS), F.col("filter")) - 1).cast("int"))
        .withColumn("before", sum(bits[1:], bits[0]))
        .withColumn("after", F.col("before").bitwiseOR(F.col("own")))
        .withColumn("others", everything.bitwiseAND(everything - F.col("own")))
    )

    def more(counts: str) -> Column:
        return F.get(counts, F.col("after")) - F.get(counts, F.col("before"))

    # n! P(all) - n (n - 1)! P(all but one): the value over all n! orders
    shapley = F.get("potential", everything) - n_filters * F.get("potential", F.col("others"))
    return steps.select(
        "part", "filter_order", "step", "filter",
        (F.col("total") - F.get("n", F.col("after"))).alias("kept"),
        more("n").alias("removed"),
        (F.get("n", F.col("own")) - more("n")).alias("redundant"),
        (F.get("n", everything) - F.get("n", F.col("others"))).alias("unique_fails"),
        more("good").alias("good_lost"),
        more("toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    )
