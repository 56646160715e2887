from tidemark.sources.catalog import (
    catalog_events,
    identity_mismatches,
    parse_index,
    parse_leaves,
    parse_pages,
    read_documents,
    rejected,
)
from tidemark.sources.licenses import parse_license_list

__all__ = [
    "catalog_events",
    "identity_mismatches",
    "parse_index",
    "parse_leaves",
    "parse_license_list",
    "parse_pages",
    "read_documents",
    "rejected",
]
