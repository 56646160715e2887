"""Version numbers and package URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.strings import strip_whitespace

LABEL = "[0-9A-Za-z.-]+"


def version_parts(version: Column) -> Column:
    """Struct of major, minor, patch and prerelease.

    One to three numbers, an optional ``-prerelease``, an optional ``+build``
    that is dropped.  Any other shape (four numbers, a ``v`` prefix) gives four
    nulls; a number beyond 32 bits makes only that part null.
    """
    text = strip_whitespace(version)
    core = F.regexp_extract(text, "^[^-+]*", 0)
    tail = F.substring(text, F.length(core) + 1, F.length(text))
    valid = core.rlike(r"^\d+(\.\d+){0,2}$") & tail.rlike(rf"^(-{LABEL})?(\+{LABEL})?$")
    numbers = F.split(core, r"\.")
    label = F.regexp_extract(tail, rf"^-({LABEL})", 1)

    def number(at: int) -> Column:
        return F.when(valid, F.get(numbers, F.lit(at)).try_cast("int"))

    return F.struct(
        number(0).alias("major"),
        number(1).alias("minor"),
        number(2).alias("patch"),
        F.when(valid & (label != ""), label).alias("prerelease"),
    )


def _percent_encode(text: Column) -> Column:
    # url_encode writes form encoding; a package URL wants plain percent encoding.
    encoded = F.url_encode(strip_whitespace(text))
    for form, plain in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%3A", ":")):
        encoded = F.replace(encoded, F.lit(form), F.lit(plain))
    return encoded


def package_url(name: Column, version: Column, kind: str = "nuget") -> Column:
    """``pkg:<kind>/<name>@<version>`` with the letter case kept."""
    return F.concat(
        F.lit(f"pkg:{kind}/"), _percent_encode(name), F.lit("@"), _percent_encode(version)
    )
