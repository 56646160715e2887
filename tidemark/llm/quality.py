"""Quality rules by distribution divergence.

Each document's histogram of character classes and of its language's common
words is compared with the language's reference, made of all documents of that
language which pass the base rule, by the Jensen-Shannon distance.  Built-in
expressions only.

Defined results: null text has no words and fails the base rule.  A document
that passes it is part of its language's reference, so every listed language
that has documents to judge has one, however small the table.  A document whose
language is null or not listed is not judged by divergence, and neither is one
below MIN_WORDS.  Rows are judged one by one, so repeated rows come out alike;
extra columns stay in `row`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLANKS, words

# Frequent function words of each language.
COMMON_WORDS = {
    "de": ["der", "die", "das", "und", "in", "zu", "den", "von", "mit", "ist", "ein", "eine", "auf", "für", "nicht", "sich", "des", "dem", "im", "auch"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "as", "be", "by", "this", "are", "from", "or"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no", "una", "su", "al", "es"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "au", "sur", "pas", "avec"],
}
# What a character can be; what is left over is the last class.
BLANK_CLASS = r"\x20\x09-\x0D"
SYMBOLS = r"#*$%&|<>"
CHARACTER_CLASSES = ["a-z", BLANK_CLASS, r"^\x00-\x7F", "A-Z", r""".,;:!?'"()\-""", "0-9", SYMBOLS]

MIN_WORDS = 50
MAX_CHARACTER_DISTANCE = 0.18
MAX_WORD_DISTANCE = 0.30


def _stripped(df: DataFrame) -> DataFrame:
    """Adds `left0`, `left1` ...: the text without the first class of characters, without the first two, and so on.

    Most characters go in the first step, so counting the classes by what each
    step takes costs little more than one pass over the text.
    """
    before = "text"
    for i, members in enumerate(CHARACTER_CLASSES):
        df = df.withColumn(f"left{i}", F.regexp_replace(F.col(before), f"[{members}]+", ""))
        before = f"left{i}"
    return df


def base_measures(text: Column, ws: Column, repeats: Column) -> list[Column]:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def taken(members: str) -> Column:
        i = CHARACTER_CLASSES.index(members)
        return F.char_length(f"left{i - 1}") - F.char_length(f"left{i}")

    return [
        F.size(ws).cast("long").alias("n_words"),
        (F.char_length(text) - taken(BLANK_CLASS)).cast("long").alias("word_chars"),
        taken(SYMBOLS).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeats.alias("n_repeat_words"),
    ]


def histograms(text: Column, lang: Column, ws: Column) -> list[Column]:
    """Counts of the character classes, and what is needed to count the common words of `lang`."""
    sizes = [F.char_length(text), *(F.char_length(f"left{i}") for i in range(len(CHARACTER_CLASSES)))]
    counts = [a - b for a, b in zip(sizes, sizes[1:], strict=False)]
    forms = sorted({f for ws_ in COMMON_WORDS.values() for w in ws_ for f in (w, w.capitalize())})
    hits = F.transform(F.filter(ws, lambda w: w.isin(forms)), F.lower)
    # one blank on either side of each hit, so that a word counts once for each place
    joined = F.concat(F.lit(" "), F.array_join(hits, "  "), F.lit(" "))
    mine = F.coalesce(
        *(F.when(lang == k, F.array(*map(F.lit, v))) for k, v in COMMON_WORDS.items()), F.array().cast("array<string>")
    )
    return [
        F.array(*counts, sizes[-1]).alias("char_counts"),
        joined.alias("joined"),
        mine.alias("mine"),
    ]


def word_counts(joined: Column, mine: Column) -> Column:
    """How often each word of `mine` stands in `joined`."""
    return F.transform(
        mine,
        lambda w: (
            (F.octet_length(joined) - F.octet_length(F.replace(joined, F.concat(F.lit(" "), w, F.lit(" ")), F.lit(""))))
            / (F.octet_length(w) + 2)
        ).cast("int"),
    )


def _with_rest(found: Column, n_words: Column) -> Column:
    return F.concat(found, F.array(n_words.cast("int") - F.aggregate(found, F.lit(0), lambda a, x: a + x)))


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two histograms over the same bins: 0 alike, 1 disjoint."""

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)

    def half(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(F.lit(2.0) * x / (x + y))).otherwise(F.lit(0.0))

    def share(xs: Column) -> Column:
        return F.zip_with(xs, F.array_repeat(total(xs), F.size(xs)), lambda x, t: x / t)

    terms = F.zip_with(share(counts), share(reference), lambda x, y: half(x, y) + half(y, x))
    return F.sqrt(F.greatest(F.lit(0.0), total(terms) / 2))


def _features(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.struct("*").alias("row"), text.alias("text"), F.col("lang").alias("lang")).select(
        "row", "text", "lang", words(F.col("text")).alias("ws")
    )


def _counted(features: DataFrame, *more: Column) -> DataFrame:
    text, lang, ws = F.col("text"), F.col("lang"), F.col("ws")
    counted = _stripped(features).select("row", "lang", F.size(ws).alias("size"), *more, *histograms(text, lang, ws))
    # two steps, as what is used twice in one step is made twice
    found = counted.withColumn("found", word_counts(F.col("joined"), F.col("mine")))
    return found.withColumn("word_counts", _with_rest(F.col("found"), F.col("size")))


def _apart(measured: DataFrame) -> DataFrame:
    """The same measures, where a filter on them is not pushed into the steps above.

    Pushed down, it would repeat them for every element that they look at.
    """
    names = [c for c in measured.columns if c not in ("row", "lang", "joined", "mine", "found")]
    held = F.explode(F.array(F.struct(*names))).alias("held")
    return measured.select("row", "lang", held).select("row", "lang", "held.*")


def language_references(docs: DataFrame) -> DataFrame:
    """One row for each listed language, over all its documents that pass the base rule.

    Words are summed.  Of each character class the median of the documents' shares
    is taken, so that long or odd documents cannot pull the reference to
    themselves; shares are whole thousandths, so a median holds some thousand counts
    at most, and one is added to each, so that no class is impossible.
    """
    listed = _features(docs).filter(F.col("lang").isin(*COMMON_WORDS) & (F.size("ws") >= MIN_WORDS))
    counted = _apart(_counted(repeated_words(listed), F.col("n_repeat_words")).withColumnRenamed("size", "n_words"))
    counted = counted.filter(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    n_chars, n_common = len(CHARACTER_CLASSES) + 1, len(next(iter(COMMON_WORDS.values()))) + 1
    def thousandths(i: int) -> Column:
        total = F.aggregate("char_counts", F.lit(0).cast("long"), lambda a, x: a + x)
        return F.floor(F.lit(1000) * F.get("char_counts", F.lit(i)) / total)

    sums = counted.groupBy("lang").agg(
        *(F.percentile(thousandths(i), 0.5).alias(f"c{i}") for i in range(n_chars)),
        *(F.sum(F.get("word_counts", F.lit(i))).alias(f"w{i}") for i in range(n_common)),
    )
    return sums.select(
        F.col("lang").alias("ref_lang"),
        F.array(*(F.col(f"c{i}") + 1 for i in range(n_chars))).alias("ref_chars"),
        F.array(*(F.col(f"w{i}") for i in range(n_common))).alias("ref_words"),
    )


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > 50 * n_words)


def repeated_words(ws: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words inside 3-word windows that the text holds twice or more.

    Windows are compared by 64-bit hashes within one text.  Equal hashes meet by
    sorting, and only in texts that hold a window twice.
    """
    w, tri = F.col("ws"), F.col("tri")
    hashed = ws.withColumn(
        "tri",
        F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)),
        ),
    )
    placed = hashed.withColumn(
        "tri",
        F.when(
            F.size(F.array_distinct(tri)) < F.size(tri),
            F.sort_array(F.transform(tri, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    twice = F.filter(
        tri,
        lambda x, k: (x["h"] == F.get(tri, k - 1)["h"]) | (x["h"] == F.get(tri, k + 1)["h"]),
    )
    places = F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    return placed.withColumn("n_repeat_words", F.coalesce(F.when(tri.isNotNull(), F.size(places)), F.lit(0)).cast("long"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """`row` (the document as it came), the base measures, both distances, base_failed and kept.

    The references have one row for each listed language, so they are broadcast.
    """
    text, ws = F.col("text"), F.col("ws")
    measured = _counted(repeated_words(_features(docs)), *base_measures(text, ws, F.col("n_repeat_words")))
    judged = (
        _apart(measured).join(F.broadcast(language_references(docs)), F.col("lang") == F.col("ref_lang"), "left")
        .withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
        .withColumn(
            "char_distance",
            F.when(~F.col("base_failed") & F.col("ref_lang").isNotNull(), js_distance(F.col("char_counts"), F.col("ref_chars"))),
        )
        .withColumn(
            "word_distance",
            F.when(~F.col("base_failed") & F.col("ref_lang").isNotNull(), js_distance(F.col("word_counts"), F.col("ref_words"))),
        )
    )
    close = F.coalesce(F.col("char_distance") <= MAX_CHARACTER_DISTANCE, F.lit(True)) & F.coalesce(
        F.col("word_distance") <= MAX_WORD_DISTANCE, F.lit(True)
    )
    return judged.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "char_distance", "word_distance", "base_failed", (~F.col("base_failed") & close).alias("kept"),
    )
