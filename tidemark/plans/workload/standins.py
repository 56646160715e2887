"""Registry-shaped inputs derived from the star-schema tables.

Where one wording suits both Spark SQL and ANSI SQL the derivation is stated
once as text; only the operators under test are written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.payload import json_text_field
from tidemark.operators.events import event_order
from tidemark.plans.workload.registry import table

# --- catalog log ---------------------------------------------------------------

LOG_KEYS = ["package_id", "version"]
LOG_PAYLOAD = ["place", "value"]

LOG = """log AS (
  SELECT user_id AS package_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS version,
         ts AS commit_at, event_id AS place, value, event_type = 'error' AS is_delete
  FROM events)"""


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("user_id").alias("package_id"),
        F.get_json_object("props", "$.k").cast("int").alias("version"),
        F.col("ts").alias("commit_at"),
        F.col("event_id").alias("place"),
        "value",
        (F.col("event_type") == "error").alias("is_delete"),
    )


def log_order():
    return event_order(F.col("commit_at"), F.col("place"))


# --- packages ------------------------------------------------------------------

_NAME = "concat('Lic-', CAST({} AS STRING), '.0')"
_DIGITS = "CAST(p_partkey % 150 AS STRING)"

PACKAGES_TEXT = f"""
  SELECT concat('pkg-', CAST(p_partkey AS STRING)) AS package_id,
         p_name, p_size, p_partkey, DATE '2024-01-01' + p_size AS synced_at,
         CASE p_partkey % 24
           WHEN 0 THEN a
           WHEN 1 THEN concat(a, ' OR ', b)
           WHEN 2 THEN concat(a, ' AND ', b)
           WHEN 3 THEN concat(' ', a, '++ ')
           WHEN 4 THEN concat(a, ' WITH Linking-exception-2.0')
           WHEN 5 THEN concat('(', a, ' or ', b, ') AND ', c)
           WHEN 6 THEN concat('LicenseRef-Custom-', CAST(p_size AS STRING))
           WHEN 7 THEN concat(a, ' OR licenseref-own')
           WHEN 8 THEN concat('Unknown-', CAST(p_size AS STRING), ' OR ', a)
           WHEN 9 THEN concat(a, '/', b)
           WHEN 10 THEN 'AND (OR)'
           WHEN 11 THEN concat(' ', chr(9), chr(10))
           WHEN 12 THEN concat(a, ' ', b)
           WHEN 13 THEN lower(a)
           WHEN 14 THEN concat('OR-later AND ', a)
           WHEN 15 THEN concat(a, chr(9), 'AND', chr(10), '  ', b, ' and ', c)
           WHEN 16 THEN concat(a, ' WITH AND exc OR ', b)
           WHEN 17 THEN concat(a, ' WITH with x ', c, ' WITH')
           WHEN 18 THEN concat('LicenseRef-', CAST(p_size AS STRING), ' AND Unknown')
           WHEN 19 THEN concat('((', c, '))')
         END AS license,
         concat('{{{{"id":"', p_name, '"', CASE p_size % 11
           WHEN 0 THEN ''
           WHEN 1 THEN concat(',"licenseUrl":"http://licenses.example.org/id/', {_DIGITS}, '"')
           WHEN 2 THEN concat(',"licenseUrl":"HTTPS://Texts.Example.org:8080/Nation/',
                              CAST(p_partkey % 25 AS STRING), '/#top"')
           WHEN 3 THEN concat(',"licenseUrl":"https://go.Microsoft.com/fwlink/?LinkId=', {_DIGITS}, '"')
           WHEN 4 THEN ',"licenseUrl":"HTTP://aka.ms/deprecateLicenseUrl"'
           WHEN 5 THEN concat(',"licenseUrl":"https://example.com/', p_name, '/LICENSE"')
           WHEN 6 THEN ',"licenseUrl":"   "'
           WHEN 7 THEN concat(',"licenseUrl":"licenses.example.org/id/', {_DIGITS}, '"')
           WHEN 8 THEN concat(',"licenseUrl":" https://www.licenses.example.org/id/', {_DIGITS}, '///;v=2 "')
           WHEN 9 THEN concat(',"licenseUrl":', CAST(p_partkey AS STRING))
           ELSE ',"licenseUrl":null' END, '}}}}') AS raw_metadata
  FROM (SELECT p_partkey, p_name, p_size, {_NAME.format("p_partkey % 150")} AS a,
               {_NAME.format("p_size")} AS b,
               {_NAME.format("(p_partkey * 7 + p_size) % 60")} AS c FROM {{part}}) AS named"""

_URL_IS_TEXT = (
    "json_type(raw_metadata, '$.licenseUrl') = 'VARCHAR' "
    "AND regexp_matches(json_extract_string(raw_metadata, '$.licenseUrl'), '\\S')"
)

PACKAGES = f"""packages AS (
  SELECT *, CASE WHEN {_URL_IS_TEXT}
            THEN json_extract_string(raw_metadata, '$.licenseUrl') END AS license_url
  FROM ({PACKAGES_TEXT.format(part="part")}) AS p)"""


def packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(PACKAGES_TEXT, part=table(spark, sf_dir, "part"))
    return rows.withColumn("license_url", json_text_field(F.col("raw_metadata"), "licenseUrl"))


# --- license list ----------------------------------------------------------------

LICENSES_TEXT = """
  SELECT concat('Lic-', CAST(s_suppkey AS STRING), '.0') AS license_id, s_name AS name,
         s_acctbal >= 3000 AS is_osi_approved, s_nationkey % 2 = 0 AS is_fsf_libre,
         s_acctbal < 0 AS is_deprecated_id, s_nationkey,
         concat('https://licenses.example.org/', CAST(s_suppkey AS STRING)) AS reference_url,
         concat('https://www.Licenses.example.org/id/', CAST(s_suppkey AS STRING), '/') AS link_1,
         CASE WHEN s_nationkey % 3 <> 0 THEN
           concat('http://texts.example.org:8080/Nation/', CAST(s_nationkey AS STRING), '?l=en')
         END AS link_2,
         CASE WHEN s_suppkey % 5 = 0 THEN 'not a url' END AS link_3
  FROM {supplier}"""

LICENSES = f"""licenses AS ({LICENSES_TEXT.format(supplier="supplier")}),
links AS (
  SELECT license_id, link_1 AS url FROM licenses WHERE link_1 IS NOT NULL
  UNION ALL SELECT license_id, link_2 FROM licenses WHERE link_2 IS NOT NULL
  UNION ALL SELECT license_id, link_3 FROM licenses WHERE link_3 IS NOT NULL)"""


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(LICENSES_TEXT, supplier=table(spark, sf_dir, "supplier"))
    links = F.array_compact(F.array("link_1", "link_2", "link_3"))
    return rows.withColumn("see_also_urls", links).drop("link_1", "link_2", "link_3")


# --- runs ------------------------------------------------------------------------

RUNS_TEXT = """
  SELECT CAST(o_orderkey AS STRING) AS id, concat('src-', CAST(o_custkey AS STRING)) AS source,
         substr(o_orderpriority, 1, 1) AS lane,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running'
              ELSE 'partial' END AS status,
         o_orderdate AS started_at,
         CASE WHEN o_orderstatus <> 'O'
              THEN o_orderdate + (o_orderkey % 90000) * INTERVAL '1' SECOND END AS completed_at,
         o_orderdate + (o_custkey % 5000) * INTERVAL '1' HOUR AS last_heartbeat_at,
         CAST(NULL AS STRING) AS error_message,
         o_custkey AS rows_inserted, CAST(o_orderkey % 500 AS INT) AS pages_processed
  FROM {orders}"""

RUNS = f"runs AS ({RUNS_TEXT.format(orders='orders')})"


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RUNS_TEXT, orders=table(spark, sf_dir, "orders"))
