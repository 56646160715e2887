from tidemark.functions.cursors import decode_cursor, encode_cursor, past_cursor
from tidemark.functions.license_text import (
    collapse_whitespace,
    plain_words,
    term_words,
    terms_combinator,
    words_combinator,
    words_terms,
)
from tidemark.functions.measures import duration_ms, per_second, progress_pct, share_pct
from tidemark.functions.payload import json_text_field, signal_label, variant_text
from tidemark.functions.strings import is_blank, strip_whitespace
from tidemark.functions.times import commit_key, parse_instant
from tidemark.functions.urls import is_vendor_eula, normalize_url
from tidemark.functions.versions import package_url, version_parts

__all__ = [
    "collapse_whitespace",
    "commit_key",
    "decode_cursor",
    "duration_ms",
    "encode_cursor",
    "is_blank",
    "is_vendor_eula",
    "json_text_field",
    "normalize_url",
    "package_url",
    "parse_instant",
    "past_cursor",
    "per_second",
    "plain_words",
    "progress_pct",
    "share_pct",
    "signal_label",
    "strip_whitespace",
    "term_words",
    "terms_combinator",
    "variant_text",
    "version_parts",
    "words_combinator",
    "words_terms",
]
