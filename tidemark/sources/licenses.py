"""The landed license list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.times import parse_instant


def parse_license_list(documents: DataFrame) -> DataFrame:
    """One row per license, with the list's version and release date on each.

    Absent flags are false and an absent link list is empty.  The raw payload is
    rebuilt from the known fields only.
    """
    doc = F.from_json("value", schemas.LICENSE_LIST_DOC)
    lists = documents.select(doc.alias("doc"))
    rows = lists.select(
        F.col("doc.licenseListVersion").alias("list_version"),
        parse_instant(F.col("doc.releaseDate")).alias("source_updated_at"),
        F.posexplode_outer("doc.licenses").alias("position", "lic"),
    ).filter(F.col("position").isNotNull())
    flag = {
        name: F.coalesce(F.col(f"lic.{name}"), F.lit(False))
        for name in ("isOsiApproved", "isFsfLibre", "isDeprecatedLicenseId")
    }
    links = F.coalesce("lic.seeAlso", F.array().cast("array<string>"))
    raw = F.to_json(
        F.struct(
            F.col("lic.licenseId").alias("licenseId"),
            F.col("lic.name").alias("name"),
            *[value.alias(name) for name, value in flag.items()],
            F.col("lic.reference").alias("reference"),
            links.alias("seeAlso"),
        ),
        {"ignoreNullFields": "false"},
    )
    return rows.select(
        F.col("lic.licenseId").alias("license_id"),
        F.col("lic.name").alias("name"),
        flag["isOsiApproved"].alias("is_osi_approved"),
        flag["isFsfLibre"].alias("is_fsf_libre"),
        flag["isDeprecatedLicenseId"].alias("is_deprecated_id"),
        F.col("lic.reference").alias("reference_url"),
        links.alias("see_also_urls"),
        raw.alias("raw_metadata"),
        "source_updated_at",
        "list_version",
    )
