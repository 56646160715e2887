"""A training corpus from raw documents, one operator a stage.

Rejected documents go, later copies of repeated lines are cut out, one document
of each near-duplicate group stays, sources are mixed to their target weights,
and the mix is encoded.  Every stage works on all that the one before it kept.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, jaccard_join, lines, mixing, quality
from tidemark.llm.common import settled, table
from tidemark.llm.queries import VOCABULARY


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the base rules and the divergence verdict."""
    kept = quality.quality_rules(docs).filter("kept")
    return kept.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the later copies of repeated runs of lines; documents of which nothing is left go."""
    return lines.without_repeats(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and all others."""
    return jaccard_join.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies and parts of the documents, so that each source has its target share of words."""
    return mixing.mix_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids (little-endian 32-bit integers), n_tokens and the hash of the text decoded from them."""
    coded = bpe.encode_and_decode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return coded.select(
        "row.doc_id", "row.lang", "row.source", "ids", "n_tokens", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources to target weights", source_mix),
    ("byte-level BPE", byte_bpe),
]

#: Encoding is beyond SQL; tests/llm holds the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
