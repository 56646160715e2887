"""License URLs: canonical form and vendor EULA addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.strings import strip_whitespace

# Addresses that always mean a vendor's own license terms.
VENDOR_EULA_ADDRESSES = (
    "go.microsoft.com/fwlink",
    "aka.ms/deprecateLicenseUrl",
    "aka.ms/pexunj",
)

# Schemes whose last path segment may carry ``;parameters``.
_PARAMETER_SCHEMES = r"(?i)^(?:https?|shttp|ftp|sftp|hdl|prospero|imap|rtspu?|sips?|mms|tel):"


def normalize_url(url: Column) -> Column:
    """Lower-case authority without one leading ``www.``, then the path without
    trailing slashes.  Scheme, query, fragment and ``;parameters`` are dropped,
    port and user-info stay.  Empty text when scheme or authority is missing.

    parse_url() does not serve: it raises on bad input and drops the port.
    """
    text = F.translate(strip_whitespace(url), "\t\r\n", "")
    split_form = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)([^?#]*)"
    authority = F.lower(F.regexp_extract(text, split_form, 1))
    path = F.regexp_extract(text, split_form, 2)
    path = F.when(
        text.rlike(_PARAMETER_SCHEMES), F.regexp_replace(path, r";[^/]*$", "")
    ).otherwise(path)
    unpaired = F.contains(authority, F.lit("[")) != F.contains(authority, F.lit("]"))
    return F.when((authority == "") | unpaired, F.lit("")).otherwise(
        F.concat(F.regexp_replace(authority, r"^www\.", ""), F.rtrim(path, F.lit("/")))
    )


def is_vendor_eula(url: Column) -> Column:
    choices = "|".join(a.replace(".", r"\.") for a in VENDOR_EULA_ADDRESSES)
    return strip_whitespace(url).rlike(rf"(?i)^https?://(?:{choices})")
