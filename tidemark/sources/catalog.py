"""The landed event catalog: index, pages and package leaves.

Documents land as JSON, one per file or one per line.  They are read as text and
parsed with a fixed schema, so the raw payload is kept word for word next to the
typed columns and unknown fields are simply not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark import schemas
from tidemark.functions.payload import variant_text
from tidemark.functions.times import commit_key, parse_instant
from tidemark.operators.events import is_delete


def read_documents(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Raw documents in ``value``.

    One document per line splits over tasks; one per file suits small files.
    Folders named ``column=value`` become columns, and filters on them skip files.
    """
    return spark.read.text(path, wholetext=one_per_file)


def _ddl_json(value: Column, schema, corrupt: str | None = None) -> Column:
    options = {"mode": "PERMISSIVE"}
    if corrupt:
        options["columnNameOfCorruptRecord"] = corrupt
    return F.from_json(value, schema, options)


def parse_index(documents: DataFrame) -> DataFrame:
    """One row per page: url, commit time and event count.

    The plain explode would make Spark test the list for being empty first, and
    parse every document twice.
    """
    doc = _ddl_json(F.col("value"), schemas.CATALOG_INDEX_DOC)
    pages = documents.select(F.posexplode_outer(doc.getField("items")).alias("position", "page"))
    return pages.filter(F.col("position").isNotNull()).select(
        F.col("page.`@id`").alias("page_url"),
        commit_key(F.col("page.commitTimeStamp")).alias("commit"),
        F.col("page.count").alias("event_count"),
    )


def _landed_url(documents: DataFrame) -> Column:
    """The URL that the landing job wrote beside a document, where it did."""
    return F.col("url") if "url" in documents.columns else F.lit(None).cast("string")


def page_states(documents: DataFrame) -> DataFrame:
    """page_url, the commit that the page states, and whether the whole page could be read."""
    schema = StructType([*schemas.CATALOG_PAGE_DOC, StructField(schemas.CORRUPT, StringType())])
    doc = _ddl_json(F.col("value"), schema, schemas.CORRUPT)
    pages = documents.select(_landed_url(documents).alias("url"), doc.alias("doc"))
    readable = F.col(f"doc.{schemas.CORRUPT}").isNull() & F.col("doc.items").isNotNull()
    return pages.select(
        F.coalesce(F.col("doc.`@id`"), F.col("url")).alias("page_url"),
        commit_key(F.col("doc.commitTimeStamp")).alias("commit"),
        F.coalesce(readable, F.lit(False)).alias("readable"),
    )


def parse_pages(documents: DataFrame) -> DataFrame:
    """One row per event reference, with its place in the catalog.

    A page names its own URL; a ``url`` column of the documents stands in where it
    does not.
    """
    doc = _ddl_json(F.col("value"), schemas.CATALOG_PAGE_DOC)
    parsed = documents.select(_landed_url(documents).alias("url"), doc.alias("doc"))
    refs = parsed.select(
        F.col("doc.commitTimeStamp").alias("page_commit"),
        F.coalesce(F.col("doc.`@id`"), F.col("url")).alias("page_url"),
        F.posexplode_outer("doc.items").alias("position", "ref"),
    )
    return refs.filter(F.col("position").isNotNull()).select(
        F.struct("page_commit", "page_url", "position").alias("place"),
        F.col("ref.`@id`").alias("leaf_url"),
        F.col("ref.`@type`").alias("event_type"),
        commit_key(F.col("ref.commitTimeStamp")).alias("commit"),
        F.col("ref.`nuget:id`").alias("package_id"),
        F.col("ref.`nuget:version`").alias("version"),
    )


def parse_leaves(documents: DataFrame) -> DataFrame:
    """One row per leaf; ``problem`` says why a leaf cannot be used, null if it can.

    A leaf names its own URL; a ``url`` column of the documents, where the landing
    job wrote one, stands in for leaves that cannot be read.
    """
    landed_url = _landed_url(documents)
    doc = _ddl_json(F.col("value"), schemas.LEAF_DOC, schemas.CORRUPT)
    leaves = documents.withColumn("doc", doc)
    published = parse_instant(F.col("doc.published"))
    missing = (
        F.col("doc.id").isNull() | F.col("doc.version").isNull() | F.col("doc.published").isNull()
    )
    problem = (
        F.when(F.col(f"doc.{schemas.CORRUPT}").isNotNull(), F.lit("unreadable"))
        .when(missing, F.lit("missing_field"))
        .when(published.isNull(), F.lit("bad_published"))
    )
    deprecation = F.col("doc.deprecation")
    return leaves.select(
        # Never null: a join would else test it first and parse every leaf twice.
        F.coalesce(F.col("doc.`@id`"), landed_url, F.lit("")).alias("leaf_url"),
        F.col("doc.id").alias("leaf_id"),
        F.col("doc.version").alias("leaf_version"),
        published.alias("published_at"),
        F.coalesce("doc.listed", F.lit(True)).alias("listed"),
        F.col("doc.projectUrl").alias("project_url"),
        F.col("doc.licenseExpression").alias("license_expression"),
        variant_text(F.col("doc.licenseUrl")).alias("license_url"),
        deprecation.isNotNull().alias("deprecated"),
        deprecation.getField("reasons").alias("deprecation_reasons"),
        deprecation.getField("alternatePackage").getField("id").alias("alternative_package"),
        deprecation.getField("message").alias("deprecation_message"),
        F.col("value").alias("raw_metadata"),
        problem.alias("problem"),
    )


def once(refs: DataFrame) -> DataFrame:
    """References that count: the last of each leaf, and the last delete of each version.

    References of one leaf carry the same payload, so only its last commit and
    place matter; of a version's deletes only the last does.  ``event_key`` is
    unique, so neither a page landed many times nor a leaf listed many times can
    make a hot key later on.
    """
    gone = is_delete(F.col("event_type"))
    version = F.concat_ws("\x00", F.lit("delete"), "package_id", "version")
    no_url = F.concat_ws("\x00", F.lit("no url"), "package_id", "version", "commit.commit_text")
    key = F.when(gone, version).otherwise(F.coalesce("leaf_url", no_url))
    ref = F.struct("commit", "place", gone.alias("gone"), "leaf_url", "package_id", "version")
    last = refs.groupBy(key.alias("event_key")).agg(F.max(ref).alias("ref"))
    return last.select("event_key", "ref.*")


def one_per_url(leaves: DataFrame) -> DataFrame:
    """A leaf landed several times counts once, a usable copy before a broken one."""
    rest = [c for c in leaves.columns if c != "leaf_url"]
    usable = F.col("problem").isNull().alias("usable")
    best = leaves.groupBy("leaf_url").agg(F.max(F.struct(usable, *rest)).alias("best"))
    return best.select("leaf_url", *[F.col(f"best.{c}").alias(c) for c in rest])


def catalog_events(refs: DataFrame, leaves: DataFrame) -> DataFrame:
    """Every reference as an event of one ``kind``: details, delete or reject.

    Details carry their leaf and take their identity from it; the reference's own
    stays in ``ref_package_id`` and ``ref_version``.  A reference whose commit time
    cannot be read, or whose leaf is missing or unusable, is a reject with its
    ``reason``, so nothing is lost silently.  Deletes need no leaf.
    """
    named = once(refs).withColumnsRenamed(
        {"package_id": "ref_package_id", "version": "ref_version", "leaf_url": "ref_url"}
    )
    found = one_per_url(leaves).withColumn("found", F.lit(True))
    joined = named.join(found, F.col("event_key") == F.col("leaf_url"), "left")
    gone, missing = F.col("gone"), F.col("found").isNull()
    reason = (
        F.when(F.col("commit.commit_at").isNull(), F.lit("bad_commit"))
        .when(~gone & missing, F.lit("missing_leaf"))
        .otherwise(F.col("problem"))
    )
    return (
        joined.withColumn("reason", reason)
        .withColumn("package_id", F.coalesce("leaf_id", "ref_package_id"))
        .withColumn("version", F.coalesce("leaf_version", "ref_version"))
        .withColumn(
            "kind",
            F.when(F.col("reason").isNotNull(), F.lit("reject"))
            .when(gone, F.lit("delete"))
            .otherwise(F.lit("details")),
        )
        .drop("event_key", "gone", "found", "problem", "leaf_id", "leaf_version", "leaf_url")
        .withColumnRenamed("ref_url", "leaf_url")
    )


def rejected(events: DataFrame) -> DataFrame:
    return events.filter(F.col("kind") == "reject").select(
        "leaf_url", "package_id", "version", "commit", "reason"
    )


def identity_mismatches(events: DataFrame) -> DataFrame:
    """Details whose reference and leaf name different packages or versions."""
    same = F.col("ref_package_id").eqNullSafe(F.col("package_id")) & F.col(
        "ref_version"
    ).eqNullSafe(F.col("version"))
    return events.filter((F.col("kind") == "details") & ~same)
