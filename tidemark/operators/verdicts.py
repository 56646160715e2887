"""License verdicts: open_source, proprietary or unknown.

A verdict depends only on the declared signal: the license expression if there
is one, else the license URL.  Millions of packages share few signals, so each
distinct signal is parsed and judged once and the verdicts are joined back; rows
only get a label.  Every step is a join or a grouped aggregate: neither the
license list nor the distinct signals have to fit anywhere, and small ones are
broadcast by Spark.

Skew: distinct signals are combined before their shuffle.  Rows that have no key
for a join get one of their own, so they spread instead of meeting at null.  All
joins have plain shuffles on both sides (a grouped side is joined on a text it
was not grouped by), which lets adaptive execution split a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.license_text import (
    collapse_whitespace,
    plain_words,
    words_combinator,
    words_terms,
)
from tidemark.functions.payload import signal_label
from tidemark.functions.urls import is_vendor_eula, normalize_url
from tidemark.operators.licenses import url_index

CLASSES = ("open_source", "proprietary", "unknown")
VERDICT_COLUMNS = (
    "classification",
    "spdx_id",
    "is_osi_approved",
    "spdx_normalized",
    "reason",
    "reason_term",
)


SIGNAL = ["signal", "signal_value"]


def with_signal(packages: DataFrame, expression: str, url: str) -> DataFrame:
    """Adds what a verdict rests on: ``signal`` is expression, url or none, and
    ``signal_value`` the declared text as it stands."""
    labelled = packages.withColumn("signal", signal_label(F.col(expression), F.col(url)))
    return labelled.withColumn(
        "signal_value",
        F.when(F.col("signal") == "expression", F.col(expression))
        .when(F.col("signal") == "url", F.col(url))
        .otherwise(F.lit("")),
    )


def distinct_signals(signalled: DataFrame) -> DataFrame:
    return signalled.select(*SIGNAL).distinct()


def _own_key(key: Column) -> Column:
    """The key, or for rows without one a key that nothing matches."""
    return F.coalesce(key, F.concat(F.lit("\x00"), F.col("signal"), F.col("signal_value")))


def _url_text(url_key: Column) -> Column:
    return F.concat(F.lit("url:"), url_key)


def _first(position: Column, value: Column, where: Column) -> Column:
    return F.min(F.when(where, F.struct(position, value)))


def signal_terms(signals: DataFrame, licenses: DataFrame) -> DataFrame:
    """One row per signal and license it names, with the list's opinion of it.

    A URL names the license its canonical form is indexed under.  A signal that
    names none keeps one row with a null ``term``.  The list holds each id once.
    """
    by_expression = F.col("signal") == "expression"
    url_key = F.when(F.col("signal") == "url", normalize_url(F.col("signal_value")))
    parsed = (
        signals.withColumns(
            {"words": F.when(by_expression, plain_words(F.col("signal_value"))), "url_key": url_key}
        )
        .withColumns(
            {"terms": words_terms(F.col("words")), "combinator": words_combinator(F.col("words"))}
        )
        .withColumn(
            "url_text", _own_key(F.when(F.col("url_key") != "", _url_text(F.col("url_key"))))
        )
    )
    index = url_index(licenses).select(
        _url_text(F.col("url_key")).alias("url_text"), F.col("license_id").alias("url_license")
    )
    named = parsed.join(index, "url_text", "left")
    terms = named.select(
        *SIGNAL,
        "combinator",
        F.posexplode_outer(F.coalesce("terms", F.array("url_license"))).alias("at", "term"),
    ).withColumn("license_id", _own_key(F.col("term")))
    opinions = licenses.select(
        "license_id", F.coalesce("is_osi_approved", F.lit(False)).alias("approved")
    )
    return terms.join(opinions, "license_id", "left").drop("license_id")


def signal_verdicts(signals: DataFrame, licenses: DataFrame) -> DataFrame:
    """Verdict per distinct signal."""
    at, term, approved = F.col("at"), F.col("term"), F.col("approved")
    listed = approved.isNotNull()
    unlisted = term.isNotNull() & approved.isNull()
    custom = F.lower(term).startswith("licenseref")
    facts = (
        signal_terms(signals, licenses)
        .groupBy(*SIGNAL)
        .agg(
            F.first("combinator").alias("combinator"),
            _first(at, term, term.isNotNull()).getField("term").alias("first_term"),
            _first(at, term, unlisted).getField("term").alias("first_unlisted"),
            F.coalesce(F.bool_or(unlisted & ~custom), F.lit(False)).alias("has_foreign"),
            _first(at, term, listed & approved).getField("term").alias("first_approved"),
            _first(at, term, listed & ~approved).getField("term").alias("first_refused"),
        )
    )
    judged = facts.withColumn("vendor_eula", is_vendor_eula(F.col("signal_value"))).withColumn(
        "reason", F.expr(_REASON)
    )
    return judged.select(
        *SIGNAL,
        F.expr(_CLASS).alias("classification"),
        F.expr(_LICENSE).alias("spdx_id"),
        F.expr(_APPROVED).alias("is_osi_approved"),
        F.when(F.col("signal") == "expression", collapse_whitespace(F.col("signal_value"))).alias(
            "spdx_normalized"
        ),
        "reason",
        F.expr(_REASON_TERM).alias("reason_term"),
    )


# The first rule that holds decides; all else follows from the reason.
_REASON = """CASE
  WHEN signal = 'none' THEN 'no_signal'
  WHEN signal = 'url' THEN CASE
    WHEN first_approved IS NOT NULL OR first_refused IS NOT NULL THEN 'url_known'
    WHEN vendor_eula THEN 'url_eula'
    ELSE 'url_unrecognised' END
  WHEN first_term IS NULL THEN 'expr_unparsed'
  WHEN has_foreign THEN 'term_unrecognised'
  WHEN first_unlisted IS NOT NULL THEN 'custom_ref'
  WHEN combinator = 'AND' AND first_refused IS NOT NULL THEN 'and_blocked'
  WHEN combinator = 'AND' THEN 'and_all_approved'
  WHEN first_approved IS NOT NULL THEN 'any_approved'
  ELSE 'none_approved' END"""

_CLASS = """CASE
  WHEN reason IN ('and_all_approved', 'any_approved') THEN 'open_source'
  WHEN reason = 'url_known' AND first_approved IS NOT NULL THEN 'open_source'
  WHEN reason IN ('custom_ref', 'and_blocked', 'none_approved', 'url_known', 'url_eula')
    THEN 'proprietary'
  ELSE 'unknown' END"""

_LICENSE = """CASE reason
  WHEN 'custom_ref' THEN first_unlisted
  WHEN 'and_blocked' THEN first_refused
  WHEN 'and_all_approved' THEN first_term
  WHEN 'any_approved' THEN first_approved
  WHEN 'none_approved' THEN first_term
  WHEN 'url_known' THEN first_term END"""

_APPROVED = """CASE
  WHEN reason IN ('and_all_approved', 'any_approved') THEN true
  WHEN reason = 'url_known' THEN first_approved IS NOT NULL
  WHEN reason IN ('custom_ref', 'and_blocked', 'none_approved', 'url_eula') THEN false END"""

_REASON_TERM = """CASE reason
  WHEN 'term_unrecognised' THEN first_unlisted
  WHEN 'custom_ref' THEN first_unlisted
  WHEN 'and_blocked' THEN first_refused
  WHEN 'any_approved' THEN first_approved
  WHEN 'none_approved' THEN first_term
  WHEN 'url_known' THEN first_term END"""


def apply_verdicts(signalled: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Joins verdicts back to the rows they were judged for.

    Verdicts of measured small size go to every task.  Otherwise both sides
    shuffle on one text key.  That key is not the one the verdicts were grouped
    by, so their side gets a shuffle of its own, without which Spark could not
    split a hot signal.  Rows without a signal all have the same verdict; they
    meet no key and are spread by their own values.
    """
    key, silent = F.concat_ws(":", "signal", "signal_value"), F.col("signal") == "none"
    judged = verdicts.filter(~silent).select(key.alias("_signal_key"), *VERDICT_COLUMNS)
    own = F.concat(F.lit("\x00"), F.xxhash64(*signalled.columns).cast("string"))
    keyed = signalled.withColumn("_signal_key", F.when(silent, own).otherwise(key)).drop("signal_value")
    constant = {"classification": F.lit("unknown"), "reason": F.lit("no_signal")}
    filled = {name: F.when(silent, value).otherwise(F.col(name)) for name, value in constant.items()}
    return keyed.join(judged, "_signal_key", "left").withColumns(filled).drop("_signal_key")


def classify(
    packages: DataFrame,
    licenses: DataFrame,
    *,
    expression: str = "license",
    url: str = "license_url",
) -> DataFrame:
    """Packages with their signal and verdict columns; every package keeps a row."""
    signalled = with_signal(packages, expression, url)
    return apply_verdicts(signalled, signal_verdicts(distinct_signals(signalled), licenses))


# --- what a new license list touches ------------------------------------------------


def _opinions(licenses: DataFrame) -> DataFrame:
    """What verdicts read of a license: its approval and the canonical links."""
    links = F.filter(F.transform(F.coalesce("see_also_urls", F.array().cast("array<string>")), normalize_url), lambda k: k != "")
    return licenses.select(
        "license_id", F.coalesce("is_osi_approved", F.lit(False)).alias("approved"), F.array_sort(F.array_distinct(links)).alias("links")
    )


def changed_licenses(earlier: DataFrame, current: DataFrame) -> DataFrame:
    """license_id and the canonical links, old and new, of the licenses that verdicts may see otherwise now."""
    old = _opinions(earlier).select("license_id", F.struct("approved", "links").alias("old"))
    new = _opinions(current).select("license_id", F.struct("approved", "links").alias("new"))
    nothing = F.array().cast("array<string>")
    return (
        old.join(new, "license_id", "full_outer")
        .filter(~F.col("old").eqNullSafe(F.col("new")))
        .select("license_id", F.array_union(F.coalesce("old.links", nothing), F.coalesce("new.links", nothing)).alias("links"))
    )


def named_keys(signals: DataFrame) -> DataFrame:
    """SIGNAL columns and one ``name_key`` a row: ids that an expression names, or the canonical form of a URL."""
    by_expression = F.col("signal") == "expression"
    words = F.when(by_expression, plain_words(F.col("signal_value")))
    ids = F.transform(words_terms(F.col("words")), lambda t: F.concat(F.lit("id:"), t))
    url = F.when(F.col("signal") == "url", F.array(_url_text(normalize_url(F.col("signal_value")))))
    return signals.withColumn("words", words).select(*SIGNAL, F.explode(F.array_distinct(F.coalesce(ids, url))).alias("name_key"))


def touched_signals(signals: DataFrame, changed: DataFrame) -> DataFrame:
    """The distinct signals that name a changed license, by id or by a link of it."""
    by_link = changed.select(F.explode("links").alias("link")).select(_url_text(F.col("link")).alias("name_key"))
    by_id = changed.select(F.concat(F.lit("id:"), "license_id").alias("name_key"))
    keys = by_id.union(by_link).distinct()
    return named_keys(signals).join(keys, "name_key", "left_semi").select(*SIGNAL).distinct()


def touched_rows(rows: DataFrame, expression: str, url: str, changed: DataFrame) -> DataFrame:
    """The rows whose verdict the changed licenses can alter; others are sure to keep theirs.

    A URL that several licenses link to goes to the smallest id; it is touched
    when any of them changes, before or after.  Joined on a text that the
    signals were not grouped by, so that a hot signal can be split.
    """
    signalled = with_signal(rows, expression, url)
    named = touched_signals(distinct_signals(signalled.filter(F.col("signal") != "none")), changed)
    key = F.concat_ws(":", *SIGNAL)
    found = signalled.withColumn("_signal_key", key).join(named.select(key.alias("_signal_key")), "_signal_key", "left_semi")
    return found.select(*rows.columns)


def class_tally(verdicts: DataFrame) -> DataFrame:
    return verdicts.agg(
        F.count(F.lit(1)).alias("rows_classified"),
        *[F.count_if(F.col("classification") == c).alias(c) for c in CLASSES],
    )


def signal_tally(signalled: DataFrame) -> DataFrame:
    return signalled.agg(
        *[
            F.count_if(F.col("signal") == s).alias(f"signal_{s}")
            for s in ("expression", "url", "none")
        ]
    )
