"""License list, terms and verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import functions as tf
from tidemark.operators import cursors, merge, quality
from tidemark.operators import licenses as lic
from tidemark.operators import verdicts as vd
from tidemark.operators.versions import deprecated_per_package
from tidemark.plans.licenses import is_new_edition, refreshed_licenses
from tidemark.plans.workload.registry import query, table
from tidemark.plans.workload.standins import (
    LICENSES,
    PACKAGES,
    licenses,
    packages,
)

# --- SQL pieces ------------------------------------------------------------------
# Terms in SQL: number the words of an expression; a word is inside an exception
# clause when no name lies between the last WITH and it.

_TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_COLLAPSED = rf"regexp_replace({_TRIM.format('license')}, '\s+', ' ', 'g')"

_WORDS = rf"""signalled AS (
  SELECT *, CASE WHEN regexp_matches(coalesce(license, ''), '\S') THEN 'expression'
                 WHEN license_url IS NOT NULL THEN 'url' ELSE 'none' END AS signal
  FROM packages),
words AS (
  SELECT package_id, unnest(list) AS word, generate_subscripts(list, 1) AS i FROM (
    SELECT package_id,
           regexp_extract_all(license, '(?i)\b(?:and|or|with)\b|[a-z0-9.+-]+') AS list
    FROM signalled WHERE signal = 'expression'
      AND NOT regexp_matches(license, '[^\s()A-Za-z0-9.+-]')) AS lists),
marked AS (
  SELECT *, upper(word) IN ('AND', 'OR', 'WITH') AS is_op FROM words),
counted AS (
  SELECT *, count(*) FILTER (WHERE NOT is_op) OVER (PARTITION BY package_id ORDER BY i
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS names_before
  FROM marked),
clauses AS (
  SELECT *, max(CASE WHEN upper(word) = 'WITH' THEN names_before END)
              OVER (PARTITION BY package_id ORDER BY i) AS names_at_with
  FROM counted),
kept AS (
  SELECT * FROM clauses WHERE names_at_with IS NULL OR names_before <> names_at_with),
terms AS (
  SELECT package_id, i, rtrim(word, '+') AS term FROM kept WHERE NOT is_op),
joins AS (
  SELECT package_id, CASE WHEN count(DISTINCT upper(word)) = 2 THEN 'MIXED'
                          ELSE max(upper(word)) END AS combinator
  FROM kept WHERE is_op GROUP BY package_id)"""

_KEY_OF = r"""CASE WHEN regexp_matches({0}, '^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]') THEN
  rtrim(regexp_replace(regexp_replace(lower(regexp_extract(trim({0}), '://([^/?#]*)', 1)),
                                      '^www\.', '')
        || regexp_extract(trim({0}), '://[^/?#]*([^?#]*)', 1), ';[^/]*$', ''), '/') ELSE '' END"""

_URL_INDEX = f"""url_index AS (
  SELECT url_key, min(license_id) AS license_id
  FROM (SELECT license_id, {_KEY_OF.format('url')} AS url_key FROM links) AS k
  WHERE url_key <> '' GROUP BY url_key)"""


def _verdict_sql(name: str, approved: str = "l.is_osi_approved") -> str:
    """CTEs ending in ``name``: package_id and its verdict columns."""
    return f"""{name}_facts AS (
  SELECT s.package_id, s.signal, s.license, s.license_url, j.combinator,
         count(t.term) AS n_terms,
         arg_min(t.term, t.i) AS first_term,
         arg_min(t.term, t.i) FILTER (WHERE t.term IS NOT NULL AND l.license_id IS NULL) AS first_unlisted,
         count(*) FILTER (WHERE t.term IS NOT NULL AND l.license_id IS NULL
                          AND NOT starts_with(lower(t.term), 'licenseref')) AS n_foreign,
         arg_min(t.term, t.i) FILTER (WHERE {approved}) AS first_ok,
         arg_min(t.term, t.i) FILTER (WHERE NOT {approved}) AS first_bad
  FROM signalled AS s LEFT JOIN terms AS t ON t.package_id = s.package_id
  LEFT JOIN licenses AS l ON l.license_id = t.term
  LEFT JOIN joins AS j ON j.package_id = s.package_id
  GROUP BY ALL),
{name}_cases AS (
  SELECT f.*, l.license_id AS url_license, {approved} AS url_ok,
    CASE WHEN f.signal = 'none' THEN 'no_signal'
         WHEN f.signal = 'url' AND l.license_id IS NOT NULL THEN 'url_known'
         WHEN f.signal = 'url' AND regexp_matches(f.license_url,
           '(?i)^\\s*https?://(go\\.microsoft\\.com/fwlink|aka\\.ms/(deprecateLicenseUrl|pexunj))')
           THEN 'url_eula'
         WHEN f.signal = 'url' THEN 'url_unrecognised'
         WHEN n_terms = 0 THEN 'expr_unparsed'
         WHEN n_foreign > 0 THEN 'term_unrecognised'
         WHEN first_unlisted IS NOT NULL THEN 'custom_ref'
         WHEN combinator = 'AND' AND first_bad IS NOT NULL THEN 'and_blocked'
         WHEN combinator = 'AND' THEN 'and_all_approved'
         WHEN first_ok IS NOT NULL THEN 'any_approved'
         ELSE 'none_approved' END AS reason
  FROM {name}_facts AS f
  LEFT JOIN url_index AS u ON f.signal = 'url' AND u.url_key = {_KEY_OF.format('f.license_url')}
  LEFT JOIN licenses AS l ON l.license_id = u.license_id),
{name} AS (
  SELECT package_id, signal, reason,
    CASE WHEN reason IN ('and_all_approved', 'any_approved') OR (reason = 'url_known' AND url_ok)
           THEN 'open_source'
         WHEN reason IN ('expr_unparsed', 'term_unrecognised', 'url_unrecognised', 'no_signal')
           THEN 'unknown' ELSE 'proprietary' END AS classification,
    CASE reason WHEN 'url_known' THEN url_license WHEN 'custom_ref' THEN first_unlisted
         WHEN 'and_blocked' THEN first_bad WHEN 'and_all_approved' THEN first_term
         WHEN 'any_approved' THEN first_ok WHEN 'none_approved' THEN first_term END AS spdx_id,
    CASE WHEN reason = 'url_known' THEN url_ok
         WHEN reason IN ('and_all_approved', 'any_approved') THEN true
         WHEN reason IN ('custom_ref', 'and_blocked', 'none_approved', 'url_eula') THEN false
    END AS is_osi_approved,
    CASE WHEN signal = 'expression' THEN {_COLLAPSED} END AS spdx_normalized
  FROM {name}_cases)"""


_INPUTS = f"WITH {PACKAGES}, {LICENSES}, {_URL_INDEX}, {_WORDS}"
_VERDICTS = f"{_INPUTS}, {_verdict_sql('verdicts')}"
_VERDICT_COLUMNS = [
    "package_id",
    "signal",
    "reason",
    "classification",
    "spdx_id",
    "is_osi_approved",
    "spdx_normalized",
]
_SELECTED = ", ".join(_VERDICT_COLUMNS)


def _verdicts(spark: SparkSession, sf_dir: str, only: str = "true") -> DataFrame:
    """Verdicts of the packages whose signal is as asked; the others are left out before any is parsed."""
    signalled = vd.with_signal(packages(spark, sf_dir), "license", "license_url")
    chosen = signalled.filter(only).drop(*vd.SIGNAL)
    return vd.classify(chosen, licenses(spark, sf_dir))


# --- terms -------------------------------------------------------------------------


@query(rf"""{_INPUTS}
SELECT s.package_id, {_COLLAPSED} AS collapsed, j.combinator, count(t.term) AS n_terms,
       coalesce(string_agg(t.term, '|' ORDER BY t.i), '') AS terms
FROM signalled AS s LEFT JOIN terms AS t ON t.package_id = s.package_id
LEFT JOIN joins AS j ON j.package_id = s.package_id
WHERE s.signal = 'expression' GROUP BY s.package_id, s.license, j.combinator""")
def expr_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = packages(spark, sf_dir).filter(~tf.is_blank(F.col("license")))
    words = declared.select(
        "package_id",
        tf.collapse_whitespace(F.col("license")).alias("collapsed"),
        tf.plain_words(F.col("license")).alias("words"),
    )
    terms = words.select(
        "package_id",
        "collapsed",
        tf.words_combinator(F.col("words")).alias("combinator"),
        tf.words_terms(F.col("words")).alias("list"),
    )
    return terms.select(
        "package_id",
        "collapsed",
        "combinator",
        F.size("list").cast("bigint").alias("n_terms"),
        F.array_join("list", "|").alias("terms"),
    )


@query(f"""{_INPUTS}
SELECT t.term, l.license_id IS NOT NULL AS is_listed, l.is_osi_approved,
       count(DISTINCT s.license) AS n_expressions
FROM terms AS t JOIN signalled AS s ON s.package_id = t.package_id
LEFT JOIN licenses AS l ON l.license_id = t.term GROUP BY ALL""")
def term_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of all distinct expressions against the list, unlisted ones included."""
    signals = vd.with_signal(packages(spark, sf_dir), "license", "license_url").filter(
        F.col("signal") == "expression"
    )
    distinct = vd.distinct_signals(signals)
    terms = vd.signal_terms(distinct, licenses(spark, sf_dir)).filter(F.col("term").isNotNull())
    return terms.groupBy(
        "term",
        F.col("approved").isNotNull().alias("is_listed"),
        F.col("approved").alias("is_osi_approved"),
    ).agg(F.count_distinct("signal_value").alias("n_expressions"))


# --- verdicts ----------------------------------------------------------------------


@query(f"{_VERDICTS} SELECT {_SELECTED} FROM verdicts WHERE signal = 'expression'")
def classify_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = _verdicts(spark, sf_dir, "signal = 'expression'")
    return verdicts.select(*_VERDICT_COLUMNS)


@query(f"{_VERDICTS} SELECT {_SELECTED} FROM verdicts WHERE signal <> 'expression'")
def classify_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = _verdicts(spark, sf_dir, "signal <> 'expression'")
    return verdicts.select(*_VERDICT_COLUMNS)


@query(f"""{_VERDICTS} SELECT count(*) AS rows_classified,
  count(*) FILTER (WHERE classification = 'open_source') AS open_source,
  count(*) FILTER (WHERE classification = 'proprietary') AS proprietary,
  count(*) FILTER (WHERE classification = 'unknown') AS unknown FROM verdicts""")
def verdict_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vd.class_tally(_verdicts(spark, sf_dir))


@query(f"""{_INPUTS} SELECT count(*) FILTER (WHERE signal = 'expression') AS signal_expression,
  count(*) FILTER (WHERE signal = 'url') AS signal_url,
  count(*) FILTER (WHERE signal = 'none') AS signal_none FROM signalled""")
def signal_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vd.signal_tally(vd.with_signal(packages(spark, sf_dir), "license", "license_url"))


@query(f"WITH {PACKAGES} SELECT package_id, license_url FROM packages")
def license_url_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License URL of each package's raw payload: text and non-blank, or null."""
    return packages(spark, sf_dir).select("package_id", "license_url")


@query(f"""{_VERDICTS} SELECT count(*) FILTER (WHERE classification = 'unknown') AS unknown_count,
  count(*) AS total_count,
  round(100.0 * count(*) FILTER (WHERE classification = 'unknown') / count(*), 2) AS unknown_pct,
  100.0 * count(*) FILTER (WHERE classification = 'unknown') / count(*) <= 60.0 AS passed
FROM verdicts""")
def unknown_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = quality.unknown_counts(_verdicts(spark, sf_dir))
    return share.select(
        "unknown_count",
        "total_count",
        F.round("pct", 2).alias("unknown_pct"),
        (F.col("pct") <= quality.UNKNOWN_WARN_PCT).alias("passed"),
    )


# The earlier list edition approves nothing.
_AFTER = "(p.synced_at, p.package_id) > (DATE '2024-01-20', 'pkg-5')"


@query(f"""WITH {PACKAGES}, {LICENSES}, {_URL_INDEX}, {_WORDS},
{_verdict_sql('fresh')},
{_verdict_sql('stale', "CASE WHEN l.license_id IS NOT NULL THEN false END")}
SELECT p.package_id,
  CASE WHEN {_AFTER} THEN f.classification ELSE s.classification END AS classification,
  CASE WHEN {_AFTER} THEN f.reason ELSE s.reason END AS reason,
  CASE WHEN {_AFTER} THEN f.spdx_id ELSE s.spdx_id END AS spdx_id
FROM packages AS p JOIN fresh AS f ON f.package_id = p.package_id
JOIN stale AS s ON s.package_id = p.package_id""")
def enrich_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of packages past the cursor replace the stored ones.

    Rows before the cursor keep the verdict an earlier list edition gave them.
    """
    rows, current = packages(spark, sf_dir), licenses(spark, sf_dir)
    earlier = current.withColumn("is_osi_approved", F.lit(False))
    columns = ["package_id", "classification", "reason", "spdx_id"]
    stored = vd.classify(rows, earlier).select(*columns)
    at, row_id = F.lit("2024-01-20").cast("date"), F.lit("pkg-5")
    candidates = cursors.rows_past(rows, "synced_at", "package_id", at, row_id)
    batch = vd.classify(candidates, current).select(*columns)
    return merge.upsert(stored, batch, ["package_id"])


# In the later edition one license changes its approval, one its link and one is gone.
_LATER = """licenses_later AS (
  SELECT license_id, CASE WHEN license_id = 'Lic-3.0' THEN NOT is_osi_approved ELSE is_osi_approved END AS is_osi_approved
  FROM licenses WHERE license_id <> 'Lic-7.0'),
links_later AS (
  SELECT license_id, CASE WHEN license_id = 'Lic-4.0' THEN url || 'moved' ELSE url END AS url FROM links WHERE license_id <> 'Lic-7.0')"""
_LATER_INDEX = _URL_INDEX.replace("url_index AS", "url_index_later AS").replace("FROM links", "FROM links_later")
_CHANGED = "('Lic-3.0', 'Lic-4.0', 'Lic-7.0')"


@query(f"""WITH {PACKAGES}, {LICENSES}, {_URL_INDEX}, {_LATER}, {_LATER_INDEX}, {_WORDS},
{_verdict_sql('stale')},
{_verdict_sql('fresh').replace('licenses AS l', 'licenses_later AS l').replace('url_index AS u', 'url_index_later AS u')},
changed_keys AS (
  SELECT {_KEY_OF.format('url')} AS url_key FROM links WHERE license_id IN {_CHANGED}
  UNION SELECT {_KEY_OF.format('url')} FROM links_later WHERE license_id IN {_CHANGED}),
named AS (
  SELECT package_id FROM terms WHERE term IN {_CHANGED}
  UNION SELECT package_id FROM signalled WHERE signal = 'url'
    AND {_KEY_OF.format('license_url')} IN (SELECT url_key FROM changed_keys WHERE url_key <> ''))
SELECT f.package_id, f.classification, f.reason, f.spdx_id, n.package_id IS NOT NULL AS judged_again
FROM fresh AS f LEFT JOIN named AS n ON n.package_id = f.package_id""")
def verdict_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts after a list edition that changes three licenses: only what names them is judged again, as if all were."""
    rows, earlier = packages(spark, sf_dir), licenses(spark, sf_dir)
    moved = F.transform("see_also_urls", lambda u: F.concat(u, F.lit("moved")))
    later = (
        earlier.filter(F.col("license_id") != "Lic-7.0")
        .withColumn("is_osi_approved", F.col("is_osi_approved") != (F.col("license_id") == "Lic-3.0"))
        .withColumn("see_also_urls", F.when(F.col("license_id") == "Lic-4.0", moved).otherwise(F.col("see_also_urls")))
    )
    columns = ["package_id", "classification", "reason", "spdx_id"]
    stored = vd.classify(rows, earlier).select(*columns, F.lit(False).alias("judged_again"))
    touched = vd.touched_rows(rows, "license", "license_url", vd.changed_licenses(earlier, later))
    again = vd.classify(touched, later).select(*columns, F.lit(True).alias("judged_again"))
    return merge.upsert(stored, again, ["package_id"])


# --- license list --------------------------------------------------------------------


@query(f"""WITH {LICENSES} SELECT count(*) AS license_count,
  count(*) FILTER (WHERE is_osi_approved) AS osi_count,
  count(*) FILTER (WHERE is_fsf_libre) AS fsf_count,
  count(*) FILTER (WHERE is_deprecated_id) AS deprecated_count,
  (SELECT count(*) FROM links) AS see_also_total FROM licenses""")
def list_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lic.list_profile(licenses(spark, sf_dir))


@query(f"""WITH {LICENSES} SELECT license_id, name FROM licenses WHERE is_osi_approved""")
def approved_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lic.approved_licenses(licenses(spark, sf_dir)).select("license_id", "name")


@query(f"""WITH {LICENSES} SELECT count(*) AS osi_count, count(*) >= 100 AS passed
FROM licenses WHERE is_osi_approved""")
def osi_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = quality.osi_floor(licenses(spark, sf_dir))
    return check.select(F.col("measured").cast("bigint").alias("osi_count"), "passed")


@query(f"""WITH {LICENSES} SELECT license_id, url FROM links
WHERE url = 'http://texts.example.org:8080/Nation/7?l=en'""")
def licenses_linking_to(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses whose link list contains one given URL."""
    url = F.lit("http://texts.example.org:8080/Nation/7?l=en")
    found = lic.licenses_linking_to(licenses(spark, sf_dir), url)
    return found.select("license_id", url.alias("url"))


@query(f"WITH {LICENSES}, {_URL_INDEX} SELECT url_key, license_id FROM url_index")
def url_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lic.url_index(licenses(spark, sf_dir)).select("url_key", "license_id")


@query(f"""WITH {PACKAGES}, {LICENSES}, {_URL_INDEX}
SELECT p.package_id, u.url_key, u.license_id FROM packages AS p
JOIN url_index AS u ON u.url_key = {_KEY_OF.format('p.license_url')}""")
def url_index_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lic.licenses_of_urls(packages(spark, sf_dir), "license_url", licenses(spark, sf_dir))
    return found.select("package_id", "url_key", "license_id")


@query(f"""WITH {LICENSES}
SELECT license_id, CASE WHEN s_nationkey >= 5 THEN NOT is_osi_approved ELSE is_osi_approved END
         AS is_osi_approved, CASE WHEN s_nationkey >= 5 THEN NULL ELSE name END AS name
FROM licenses""")
def list_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new edition rewrites the rows it has; rows it dropped stay.

    Version 3.10 follows 3.9: editions are told apart by equality, never order.
    A third load, of an edition already stored, is left out.
    """
    rows = licenses(spark, sf_dir)
    columns = ["license_id", "is_osi_approved", "name", "s_nationkey"]
    stored = rows.filter("s_nationkey < 20").select(*columns)
    edition = (
        rows.filter("s_nationkey >= 5")
        .withColumn("is_osi_approved", ~F.col("is_osi_approved"))
        .withColumn("name", F.lit(None).cast("string"))
        .select(*columns)
    )
    if is_new_edition("3.10", "3.9"):
        stored = refreshed_licenses(stored, edition)
    if is_new_edition("3.10", "3.10"):
        stored = refreshed_licenses(stored, rows.select(*columns))
    return stored.select("license_id", "is_osi_approved", "name")


# --- versions ----------------------------------------------------------------------------


@query("""SELECT p_brand AS package_id, count(*) AS n_deprecated FROM part
WHERE p_size % 3 = 0 GROUP BY p_brand""")
def deprecated_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deprecated versions per package; a deprecation block, even empty, deprecates."""
    message = F.when(F.col("p_size") % 2 == 0, F.col("p_type"))
    block = F.when(F.col("p_size") % 3 == 0, F.struct(message.alias("message")))
    part = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("package_id"), block.isNotNull().alias("deprecated")
    )
    return deprecated_per_package(part)
