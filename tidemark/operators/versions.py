"""The version and package tables: rows out of catalog events, and queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.versions import package_url, version_parts
from tidemark.operators.events import net_changes

VERSION_KEYS = ["package_id", "version"]
PACKAGE_KEYS = ["package_id"]


def version_changes(events: DataFrame) -> DataFrame:
    """Net changes of the version table."""
    payload = [
        "place",
        "published_at",
        "listed",
        "deprecated",
        "deprecation_reasons",
        "alternative_package",
        "deprecation_message",
        "raw_metadata",
        "synced_at",
    ]
    last = net_changes(
        events.filter(F.col("kind") != "reject"),
        VERSION_KEYS,
        commit=F.col("commit"),
        deletes=F.col("kind") == "delete",
        payload=payload,
    )
    # What follows from the key alone is worked out after the shuffle, once per key.
    parts = F.col("parts")
    return (
        last.withColumn("purl", package_url(F.col("package_id"), F.col("version")))
        .withColumn("parts", version_parts(F.col("version")))
        .withColumns({p: parts.getField(p) for p in ("major", "minor", "patch", "prerelease")})
        .drop("parts", "place")
    )


def package_changes(events: DataFrame) -> DataFrame:
    """Net changes of the package table: deletes leave packages alone.

    The latest version is that of the last commit, which need not be the highest.
    """
    details = events.filter(F.col("kind") == "details")
    last = net_changes(
        details,
        PACKAGE_KEYS,
        commit=F.col("commit"),
        deletes=F.lit(False),
        payload=[
            "place",
            "version",
            "project_url",
            "license_expression",
            "license_url",
            "raw_metadata",
            "synced_at",
            "published_at",
        ],
    )
    return last.drop("place").withColumnsRenamed(
        {
            "version": "latest_version",
            "license_expression": "license",
            "published_at": "source_updated_at",
        }
    )


def live(versions: DataFrame) -> DataFrame:
    return versions.filter(F.col("deleted_at").isNull())


def deprecated_per_package(versions: DataFrame, package: str | Column = "package_id") -> DataFrame:
    return (
        versions.filter("deprecated").groupBy(package).agg(F.count(F.lit(1)).alias("n_deprecated"))
    )
