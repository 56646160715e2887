"""Schemas of the landed documents and of the stored tables.

Nothing is inferred: every read names its schema.  A later version of a table
may add columns at the end; readers fill them with nulls.
"""

from __future__ import annotations

from pyspark.sql import types as T

STR, INT, LONG, BOOL, TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.BooleanType(),
    T.TimestampType(),
)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# --- landed documents (field names are fixed by the public catalog format) ---

CATALOG_INDEX_DOC = T.StructType(
    [
        T.StructField("commitTimeStamp", STR),
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("@id", STR),
                        T.StructField("commitTimeStamp", STR),
                        T.StructField("count", INT),
                    ]
                )
            ),
        ),
    ]
)

CATALOG_PAGE_DOC = T.StructType(
    [
        T.StructField("@id", STR),
        T.StructField("commitTimeStamp", STR),
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("@id", STR),
                        T.StructField("@type", STR),
                        T.StructField("commitTimeStamp", STR),
                        T.StructField("nuget:id", STR),
                        T.StructField("nuget:version", STR),
                    ]
                )
            ),
        ),
    ]
)

CORRUPT = "_corrupt"

LEAF_DOC = T.StructType(
    [
        T.StructField("@id", STR),
        T.StructField("id", STR),
        T.StructField("version", STR),
        T.StructField("published", STR),
        T.StructField("listed", BOOL),
        T.StructField("projectUrl", STR),
        T.StructField("licenseExpression", STR),
        T.StructField("licenseUrl", T.VariantType()),
        T.StructField(
            "deprecation",
            T.StructType(
                [
                    T.StructField("reasons", T.ArrayType(STR)),
                    T.StructField("alternatePackage", T.StructType([T.StructField("id", STR)])),
                    T.StructField("message", STR),
                ]
            ),
        ),
        T.StructField(CORRUPT, STR),
    ]
)

LICENSE_LIST_DOC = T.StructType(
    [
        T.StructField("licenseListVersion", STR),
        T.StructField("releaseDate", STR),
        T.StructField(
            "licenses",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("licenseId", STR),
                        T.StructField("name", STR),
                        T.StructField("isOsiApproved", BOOL),
                        T.StructField("isFsfLibre", BOOL),
                        T.StructField("isDeprecatedLicenseId", BOOL),
                        T.StructField("reference", STR),
                        T.StructField("seeAlso", T.ArrayType(STR)),
                    ]
                )
            ),
        ),
    ]
)

# --- stored tables -----------------------------------------------------------

# When a catalog entry was committed.  The text is kept, since its seventh
# fractional digit does not fit a timestamp.
COMMIT = _struct(commit_at=TS, commit_text=STR)
# Where it stood: page and position settle the order of equal commits.
PLACE = _struct(page_commit=STR, page_url=STR, position=INT)

# Every applied or rejected event, one folder per batch; kind is details, delete
# or reject.
PAGES_READ = _struct(page_url=STR, commit=COMMIT)

CATALOG_LOG = _struct(
    package_id=STR,
    version=STR,
    commit=COMMIT,
    place=PLACE,
    leaf_url=STR,
    ref_package_id=STR,
    ref_version=STR,
    published_at=TS,
    listed=BOOL,
    project_url=STR,
    license_expression=STR,
    license_url=STR,
    deprecated=BOOL,
    deprecation_reasons=T.ArrayType(STR),
    alternative_package=STR,
    deprecation_message=STR,
    raw_metadata=STR,
    synced_at=TS,
    reason=STR,
    kind=STR,
)

PACKAGE_STATE = _struct(
    package_id=STR,
    latest_version=STR,
    project_url=STR,
    license=STR,
    license_url=STR,
    raw_metadata=STR,
    synced_at=TS,
    source_updated_at=TS,
    details_at=COMMIT,
    deleted_at=COMMIT,
)

VERSION_STATE = _struct(
    package_id=STR,
    version=STR,
    purl=STR,
    major=INT,
    minor=INT,
    patch=INT,
    prerelease=STR,
    published_at=TS,
    listed=BOOL,
    deprecated=BOOL,
    deprecation_reasons=T.ArrayType(STR),
    alternative_package=STR,
    deprecation_message=STR,
    raw_metadata=STR,
    synced_at=TS,
    details_at=COMMIT,
    deleted_at=COMMIT,
)

LICENSE_REF = _struct(
    license_id=STR,
    name=STR,
    is_osi_approved=BOOL,
    is_fsf_libre=BOOL,
    is_deprecated_id=BOOL,
    reference_url=STR,
    see_also_urls=T.ArrayType(STR),
    raw_metadata=STR,
    source_updated_at=TS,
    synced_at=TS,
)

LICENSE_VERDICT = _struct(
    package_id=STR,
    license_expression=STR,
    license_url=STR,
    spdx_id=STR,
    spdx_normalized=STR,
    is_osi_approved=BOOL,
    classification=STR,
    reasoning=STR,
    classified_at=TS,
    source_synced_at=TS,
)

# Working table of one verdict run: each distinct signal judged once.
SIGNAL_VERDICT = _struct(
    signal=STR,
    signal_value=STR,
    classification=STR,
    spdx_id=STR,
    is_osi_approved=BOOL,
    spdx_normalized=STR,
    reason=STR,
    reason_term=STR,
)

SYNC_CHECKPOINT = _struct(
    source=STR,
    watermark=STR,
    last_sync_at=TS,
    last_sync_status=STR,
    rows_synced=LONG,
    metadata=STR,
)

# One row per event of a run: opened, heartbeat, finalised.  The current ledger
# is a view over these rows, so a run never rewrites a stored row.
RUN_EVENT = _struct(
    id=STR,
    source=STR,
    external_run_id=STR,
    started_at=TS,
    completed_at=TS,
    status=STR,
    rows_inserted=LONG,
    rows_updated=LONG,
    rows_deleted=LONG,
    pages_processed=INT,
    watermark_before=STR,
    watermark_after=STR,
    error_message=STR,
    error_details=STR,
    last_heartbeat_at=TS,
    event_at=TS,
)
