"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import functions as tf
from tidemark.operators import cursors
from tidemark.plans.workload.registry import query, table

_VERSION = """CASE p_partkey % 15
  WHEN 0 THEN CAST(p_size AS STRING)
  WHEN 1 THEN concat(CAST(p_size AS STRING), '.', CAST(p_partkey AS STRING))
  WHEN 2 THEN concat(CAST(p_size AS STRING), '.0.', CAST(p_partkey AS STRING))
  WHEN 3 THEN concat('1.', CAST(p_size AS STRING), '.3-beta.', CAST(p_partkey AS STRING))
  WHEN 4 THEN concat('1.', CAST(p_size AS STRING), '.3-rc-1+build-', CAST(p_partkey AS STRING))
  WHEN 5 THEN concat('1.2.', CAST(p_size AS STRING), '+sha.', CAST(p_partkey AS STRING))
  WHEN 6 THEN concat('1.2.3.', CAST(p_size AS STRING))
  WHEN 7 THEN concat('v', CAST(p_size AS STRING), '.0')
  WHEN 8 THEN concat('1.', CAST(p_partkey + 3000000000 AS STRING), '.7')
  WHEN 9 THEN concat(' ', CAST(p_size AS STRING), '.1 ')
  WHEN 10 THEN concat(CAST(p_size AS STRING), '.1-')
  WHEN 11 THEN concat(CAST(p_size AS STRING), '.1-a_b')
  WHEN 12 THEN concat('1..', CAST(p_size AS STRING))
  WHEN 13 THEN ''
END"""


# Cut at the first plus, what is before it at the first hyphen, and what is
# before that at the dots; every part is tested by itself.
@query(f"""WITH v AS (SELECT p_partkey, trim({_VERSION}) AS version FROM part),
built AS (SELECT *, strpos(version, '+') AS plus FROM v),
based AS (
  SELECT p_partkey, version, plus, CASE WHEN plus > 0 THEN left(version, plus - 1) ELSE version END AS base FROM built
), labelled AS (SELECT *, strpos(base, '-') AS hyphen FROM based),
parted AS (
  SELECT *, string_split(CASE WHEN hyphen > 0 THEN left(base, hyphen - 1) ELSE base END, '.') AS numbers,
    CASE WHEN hyphen > 0 THEN substr(base, hyphen + 1) END AS label,
    CASE WHEN plus > 0 THEN substr(version, plus + 1) END AS build
  FROM labelled
), tested AS (
  SELECT *, len(numbers) <= 3
    AND len(list_filter(numbers, lambda x: x = '' OR length(translate(x, '0123456789', '')) > 0)) = 0
    AND coalesce(regexp_full_match(label, '[.0-9A-Za-z-]+'), true)
    AND coalesce(regexp_full_match(build, '[.0-9A-Za-z-]+'), true) AS good
  FROM parted
)
SELECT p_partkey, version,
       CASE WHEN good THEN TRY_CAST(numbers[1] AS INTEGER) END AS major,
       CASE WHEN good THEN TRY_CAST(numbers[2] AS INTEGER) END AS minor,
       CASE WHEN good THEN TRY_CAST(numbers[3] AS INTEGER) END AS patch,
       CASE WHEN good THEN label END AS prerelease
FROM tested""")
def semver_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", F.expr(_VERSION).alias("version"))
    return part.select(
        "p_partkey",
        tf.strip_whitespace(F.col("version")).alias("version"),
        tf.version_parts(F.col("version")).alias("parts"),
    ).select("p_partkey", "version", "parts.*")


_NAME = "concat(p_name, CASE p_size % 4 WHEN 0 THEN '*~:' WHEN 1 THEN '.A_b-c' ELSE '' END)"
_RELEASE = "concat('1.', CAST(p_size AS STRING), '.0+b', CAST(p_partkey AS STRING))"


@query(f"""SELECT p_partkey, concat('pkg:nuget/',
       replace(replace({_NAME}, ' ', '%20'), '*', '%2A'), '@',
       replace({_RELEASE}, '+', '%2B')) AS purl FROM part""")
def purl_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", tf.package_url(F.expr(_NAME), F.expr(_RELEASE)).alias("purl"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(NULL AS VARCHAR) AS k_text,
       CASE WHEN event_type <> 'click' THEN event_type END AS kind
FROM events""")
def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number read as a number, a number refused as text, and a text field."""
    labelled = F.to_json(
        F.struct(F.when(F.col("event_type") != "click", F.col("event_type")).alias("kind"))
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        tf.json_text_field(F.col("props"), "k").alias("k_text"),
        tf.json_text_field(labelled, "kind").alias("kind"),
    )


@query(r"""WITH cut AS (
  SELECT page_id, url, regexp_replace(split_part(split_part(url, '#', 1), '?', 1),
                                      '^[a-z]+://', '') AS rest FROM pages)
SELECT page_id, url, rtrim(regexp_replace(lower(split_part(rest, '/', 1)), '^www\.', '')
       || substr(rest, length(split_part(rest, '/', 1)) + 1), '/') AS url_key FROM cut""")
def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", tf.normalize_url(F.col("url")).alias("url_key"))


_STAMP = "CAST(CAST(ts AS DATE) AS STRING)"
_INSTANT = f"""CASE event_id % 5
  WHEN 0 THEN {_STAMP}
  WHEN 1 THEN concat({_STAMP}, 'T10:20:30Z')
  WHEN 2 THEN concat({_STAMP}, 'T10:20:30.25+02:00')
  WHEN 3 THEN concat({_STAMP}, 'T10:20:30.123456')
  ELSE concat('on ', {_STAMP}) END"""


_MIDNIGHT = "epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP))"


@query(f"""SELECT event_id, CASE event_id % 5
  WHEN 0 THEN {_MIDNIGHT}
  WHEN 1 THEN {_MIDNIGHT} + 37230000000
  WHEN 2 THEN {_MIDNIGHT} + 30030250000
  WHEN 3 THEN {_MIDNIGHT} + 37230123456
  END AS micros FROM events""")
def instant_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date only, zoned, offset, zone-less and unreadable instants."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id", F.unix_micros(tf.parse_instant(F.expr(_INSTANT))).alias("micros")
    )


_TEXT = """concat(replace(CAST(date_trunc('second', ts) AS STRING), ' ', 'T'),
  CASE event_id % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '.5Z' ELSE '.25Z' END)"""


@query("""WITH c AS (
  SELECT user_id, date_trunc('second', ts) + CASE event_id % 3 WHEN 0 THEN INTERVAL '0' SECOND
           WHEN 1 THEN INTERVAL 500 MILLISECOND ELSE INTERVAL 250 MILLISECOND END AS instant,
         concat(strftime(ts, '%Y-%m-%dT%H:%M:%S'),
           CASE event_id % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '.5Z' ELSE '.25Z' END) AS commit_text
  FROM events)
SELECT user_id, commit_text FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY instant DESC, commit_text DESC) AS rk
  FROM c) AS r WHERE rk = 1""")
def commit_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last commit per package when times are texts of uneven length."""
    events = table(spark, sf_dir, "events").select("user_id", F.expr(_TEXT).alias("commit_text"))
    last = events.groupBy("user_id").agg(
        F.max(tf.commit_key(F.col("commit_text"))).alias("last")
    )
    return last.select("user_id", "last.commit_text")


CURSOR_AT, CURSOR_ID = "1998-05-10 00:00:00", 700


def _cursor():
    return F.lit(CURSOR_AT).cast("timestamp_ntz"), F.lit(CURSOR_ID).cast("bigint")


@query(f"""SELECT o_orderkey, o_orderdate, o_custkey FROM orders
WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '{CURSOR_AT}', {CURSOR_ID})
ORDER BY o_orderdate, o_orderkey LIMIT 100""")
def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    page = cursors.keyset_page(orders, "o_orderdate", "o_orderkey", *_cursor(), 100)
    return page.select("o_orderkey", "o_orderdate", "o_custkey")


@query(f"""SELECT count(*) AS candidates FROM orders
WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '{CURSOR_AT}', {CURSOR_ID})""")
def candidate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rows = cursors.rows_past(orders, "o_orderdate", "o_orderkey", *_cursor())
    return rows.agg(F.count(F.lit(1)).alias("candidates"))


@query("""SELECT o_custkey, max(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || 'Z') AS at_text,
       arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_id
FROM orders GROUP BY o_custkey""")
def cursor_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's last order written as a cursor and read back."""
    orders = table(spark, sf_dir, "orders")
    utc = F.to_timestamp(F.concat(F.col("o_orderdate").cast("string"), F.lit("Z")))
    last = orders.groupBy("o_custkey").agg(
        F.max(F.struct(utc.alias("at"), "o_orderkey")).alias("last")
    )
    cursor = tf.encode_cursor(F.col("last.at"), F.col("last.o_orderkey"))
    back = last.select("o_custkey", tf.decode_cursor(cursor).alias("back"))
    micros = F.unix_micros("back.at")
    text = F.date_format(
        (F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=micros / 1000000)),
        "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
    )
    return back.select(
        "o_custkey", text.alias("at_text"), F.col("back.row_id").cast("bigint").alias("last_id")
    )


@query("""SELECT o_orderkey, o_orderdate AS last_at FROM orders
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1""")
def cursor_last_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cursor a job that has read all rows leaves behind."""
    orders = table(spark, sf_dir, "orders")
    last = cursors.last_position(orders, "o_orderdate", "o_orderkey")
    return last.select(F.col("row_id").alias("o_orderkey"), F.col("at").alias("last_at"))
