"""Line dedup by a suffix array over line numbers, built by prefix doubling.

Every line with a word becomes a number, equal lines the same one.  Doubling
ranks the suffixes of all documents' line sequences by their first lines, up to
`min_lines` and then twice, four times ... as many, each round by one
distributed sort of the runs that still repeat, until none does.  Suffixes of
equal rank form an interval whose longest common prefix has at least the round's
number of lines.  The interval's first suffix, by doc_id (null last) and place,
stays; of the others the common lines go.  What goes of a document is the union
of its maximal repeated runs that some earlier place has as well.

A run counts if it has `min_lines` lines, or one line of `min_words` words.
Built-in expressions only.

Defined results: null text has no lines.  Lines without a word are no part of a
sequence and stay, unless all others go: then the text becomes empty.  Rows
equal in doc_id and text count as one document and come out alike.  Extra
columns stay in `row`; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import forget, ranked, settled, text_key

MIN_LINES = 2
#: A line of so many words is a run of its own.
MIN_WORDS = 5


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _worded(lines: Column) -> Column:
    """Places of the lines with a word."""
    return F.filter(
        F.transform(lines, lambda x, i: F.when(x.rlike(r"[^\x20\x09-\x0D]"), i)), lambda i: i.isNotNull()
    )


def line_rows(docs: DataFrame, min_words: int) -> DataFrame:
    """doc_id, key, seq, 128 bits of content and whether it has `min_words` words, for each line with a word."""
    lines = F.filter(_lines(F.col("text")), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # from the start and without a way back: no line is read more than once
    several = rf"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++){{{min_words - 1}}}[^\x20\x09-\x0D]"
    hashed = F.transform(
        lines, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), x.rlike(several).alias("long"))
    )
    return docs.select(
        F.col("doc_id").alias("doc_id"), text_key(F.col("text")).alias("key"), F.posexplode(hashed).alias("seq", "line")
    ).select("doc_id", "key", "seq", "line.a", "line.b", "line.long")


def _repeated(rows: DataFrame, names: list[str]) -> DataFrame:
    """The values of `names` found at two places or more.  Map tasks combine, so a frequent value is a row a task."""
    place = F.xxhash64("doc_id", "key", "seq")
    return rows.groupBy(*names).agg(F.min(place).alias("lo"), F.max(place).alias("hi")).filter("lo <> hi").drop("lo", "hi")


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("key"), F.col("seq"))


def _named(rows: DataFrame, names: list[str]) -> DataFrame:
    """Rows whose value of `names` repeats, with its rank in place of the value, and whether they are a later copy.

    The first places are stored before they are joined: a join of what was just
    grouped by the rank would keep that grouping, and a rank that many rows have
    could not be split.
    """
    ranks = ranked(_repeated(rows, names), names, "place", "line-ranks").select(*(F.col(n).alias(f"_{n}") for n in names), "place")
    same = [F.col(n) == F.col(f"_{n}") for n in names]
    held = settled(rows.join(ranks, same).select("doc_id", "key", "seq", "long", F.col("place").alias("rank")), "line-intervals")
    first = settled(held.groupBy(F.col("rank").alias("_rank")).agg(F.min(_place()).alias("first")), "line-first")
    return settled(
        held.join(first, F.col("rank") == F.col("_rank")).select(*held.columns, (_place() != F.col("first")).alias("later")), "line-suffixes"
    )


def suffix_rounds(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> list[tuple[int, DataFrame]]:
    """(n, suffixes that share their first n lines with another one) for n = 1, 2 ... min_lines, twice as many ...

    A suffix has doc_id, key, seq, long (of its first line), rank of its interval
    and later.  The last round is the last in which anything repeats.
    """
    # stored: the first round reads them twice, and cutting texts into lines costs most
    lines = settled(line_rows(docs, min_words), "line-rows")
    rounds = [(1, _named(lines, ["a", "b"]))]
    forget(lines)
    while True:
        length, suffixes = rounds[-1]
        step = min(length, min_lines - length) if length < min_lines else length
        ahead = Window.partitionBy("doc_id", "key").orderBy("seq").rangeBetween(step, step)
        pairs = suffixes.withColumn("next", F.max("rank").over(ahead)).filter(F.col("next").isNotNull())
        longer = _named(pairs, ["rank", "next"])
        if longer.isEmpty():
            return rounds
        rounds.append((length + step, longer))


def later_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, key, `later` (the places, among lines with a word, of the lines in later copies) and longest_shared."""
    rounds = suffix_rounds(docs, min_lines, min_words)
    of_one = F.when(F.col("later") & F.col("long"), 1) if min_lines > 1 else F.when(F.col("later"), 1)
    # every line in a later copy repeats, so the first round has a row for it
    starts = rounds[0][1].select("doc_id", "key", "seq", F.coalesce(of_one, F.lit(0)).alias("n_shared"))
    for length, suffixes in rounds[1:]:
        if length >= min_lines:
            starts = starts.union(suffixes.filter("later").select("doc_id", "key", "seq", F.lit(length).alias("n_shared")))
    shared = starts.groupBy("doc_id", "key", "seq").agg(F.max("n_shared").alias("n_shared"))
    reach = F.max(F.col("seq") + F.col("n_shared")).over(
        Window.partitionBy("doc_id", "key").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        shared.withColumn("reach", reach)
        .filter(F.col("reach") > F.col("seq"))
        .groupBy("doc_id", "key")
        .agg(F.array_sort(F.collect_list("seq")).alias("later"), F.max("n_shared").cast("long").alias("longest_shared"))
    )


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """`row`, kept_text, n_lines (with a word), n_removed, n_runs (stretches of removed lines) and longest_shared.

    longest_shared is the largest number of lines, of those that rounds look at,
    which a place of the document has in common with an earlier one; 0 if none goes.
    """
    later = settled(later_lines(docs, min_lines, min_words), "line-later").select(
        F.col("doc_id").alias("_doc_id"), F.col("key").alias("_key"), "later", "longest_shared"
    )
    keyed = docs.select(F.struct("*").alias("row"), text_key(F.col("text")).alias("key"))
    joined = keyed.join(later, F.col("row.doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("key") == F.col("_key")), "left")
    lines, worded, later_ = F.col("lines"), F.col("worded"), F.col("later")
    split = joined.select("row", "later", "longest_shared", _lines(F.col("row.text")).alias("lines")).withColumn("worded", _worded(lines))
    gone = F.transform(later_, lambda s: F.get(worded, s))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    text = F.col("row.text")
    return split.select(
        "row",
        F.when(later_.isNull(), text)
        .when(F.size(later_) == F.size(worded), F.lit(""))
        .otherwise(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
        .alias("kept_text"),
        F.size(worded).cast("long").alias("n_lines"),
        F.coalesce(F.size(later_), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size(F.filter(later_, lambda s, i: (i == 0) | (s != F.get(later_, i - 1) + 1))), F.lit(0)).cast("long").alias("n_runs"),
        F.coalesce("longest_shared", F.lit(0).cast("long")).alias("longest_shared"),
    )


def without_repeats(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with later copies cut out; those of which nothing is left go."""
    kept = dedup_lines(docs, min_lines, min_words).filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return kept.select(*(F.col("kept_text").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
