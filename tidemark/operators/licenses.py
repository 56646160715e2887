"""The license reference list: profile, link index and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.urls import normalize_url


def list_profile(licenses: DataFrame) -> DataFrame:
    """One row of counts over the list."""
    return licenses.agg(
        F.count(F.lit(1)).alias("license_count"),
        F.count_if("is_osi_approved").alias("osi_count"),
        F.count_if("is_fsf_libre").alias("fsf_count"),
        F.count_if("is_deprecated_id").alias("deprecated_count"),
        F.coalesce(F.sum(F.size("see_also_urls").cast("bigint")), F.lit(0).cast("bigint")).alias(
            "see_also_total"
        ),
    )


def approved_licenses(licenses: DataFrame) -> DataFrame:
    return licenses.filter("is_osi_approved")


def see_also_links(licenses: DataFrame) -> DataFrame:
    """(license_id, url) pairs; licenses without links have none."""
    return licenses.select("license_id", F.explode("see_also_urls").alias("url"))


def url_index(licenses: DataFrame) -> DataFrame:
    """Canonical URL -> license.  A URL named by several goes to the smallest id."""
    return (
        see_also_links(licenses)
        .select("license_id", normalize_url(F.col("url")).alias("url_key"))
        .filter(F.col("url_key") != "")
        .groupBy("url_key")
        .agg(F.min("license_id").alias("license_id"))
    )


def licenses_of_urls(rows: DataFrame, url: str, licenses: DataFrame) -> DataFrame:
    """Rows whose URL the list knows, with its ``url_key`` and ``license_id``.

    Joined on a text that the index was not grouped by: its side then has a plain
    shuffle, and Spark can split a URL that most rows share.
    """
    index = url_index(licenses)
    key = F.concat(F.lit("url:"), "url_key")
    keyed = rows.withColumn("url_key", normalize_url(F.col(url))).withColumn("_key", key)
    return keyed.join(index.select(key.alias("_key"), "license_id"), "_key").drop("_key")


def licenses_linking_to(licenses: DataFrame, url: Column) -> DataFrame:
    """Licenses whose links contain this very URL."""
    return licenses.filter(F.array_contains("see_also_urls", url))
