"""The operators as queries over the whole tables, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, chunks, filter_audit, graph_ann, jaccard_join, lines, merkle, mixing, packing, pseudo_likelihood, quality, resharding, suffixes,
)
from tidemark.llm.common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PACKED_VOCABULARY = "word_bpe_49k.json"


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    coded = bpe.encode_and_decode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return coded.select(
        "row.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op3_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = pseudo_likelihood.pseudo_likelihood(table(spark, sf_dir, "documents"))
    return scored.select("row.doc_id", "n_words", "pseudo_log_likelihood", "mean_log_probability")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_lines", "n_removed", "n_runs", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of the table are the old shards."""
    docs = table(spark, sf_dir, "documents")
    placed = resharding.reshard(docs.select("*", "_metadata.file_name"), F.col("file_name"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old"
    )


def op9_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.dedup_chunks(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_bytes", "n_chunks", "n_removed", "n_spans", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op10_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return graph_ann.nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op11_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(PACKED_VOCABULARY))
    return packed.select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checker who meets texts in lower case where 5 divides the checksum of doc_id."""
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = merkle.manifest(table(spark, sf_dir, "documents"), merkle.lowered(F.col("text")), touched)
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.drop("filter")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_byte_bpe, op3_pseudo_likelihood, op4_quality_rules, op5_line_dedup,
        op6_suffix_dedup, op7_source_mix, op8_reshard, op9_chunk_dedup, op10_graph_neighbours,
        op11_genetic_packing, op12_merkle_manifest, op13_filter_audit,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"

_JACCARD = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(generate_series(1, greatest(1, len(ws) - 4)), lambda i: array_to_string(ws[i:i + 4], ' '))) AS t
  FROM w WHERE len(ws) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)
), reach(start, node) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT start, b FROM reach JOIN links ON node = a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT start, min(node) AS component_id FROM reach GROUP BY start) r ON r.start = d.doc_id
"""


def _quality_sql() -> str:
    """The rules again: windows by joins, histograms by unnested words, distances by sums over bins."""
    patterns = [f"[{c}]".replace("'", "''") for c in quality.CHARACTER_CLASSES]
    chars = [f"len(regexp_extract_all(t, '{x}'))" for x in patterns]
    listed = ", ".join(f"('{k}', '{w}')" for k, ws in quality.COMMON_WORDS.items() for x in ws for w in (x, x.capitalize()))
    char_rows = " UNION ALL ".join(
        [f"SELECT rid, lang, 'c' AS kind, '{i}' AS bin, {c} AS n FROM d" for i, c in enumerate(chars)]
        + [f"SELECT rid, lang, 'c', 'rest', length(t) - {' - '.join(chars)} FROM d"]
    )
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, lang, doc_id, t, regexp_extract_all(t, '{_WORD}') AS ws FROM d),
word AS (SELECT rid, lang, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w),
tri AS (
  SELECT rid, i, w || ' ' || lead(w) OVER p || ' ' || lead(w, 2) OVER p AS x FROM word WINDOW p AS (PARTITION BY rid ORDER BY i)
), again AS (
  SELECT rid, unnest([i, i + 1, i + 2]) AS i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, x) AS n FROM tri WHERE x IS NOT NULL) WHERE n > 1
), repeats AS (SELECT rid, count(DISTINCT i) AS n FROM again GROUP BY rid),
line AS (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM d),
dup AS (SELECT rid, count(*) - count(DISTINCT x) AS n FROM line WHERE regexp_matches(x, '{_WORD}') GROUP BY rid),
base AS (
  SELECT w.rid, w.doc_id, w.lang, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words
  FROM w LEFT JOIN dup ON dup.rid = w.rid LEFT JOIN repeats ON repeats.rid = w.rid
), listed(lang, w) AS (VALUES {listed}),
hits AS (SELECT rid, word.lang, lower(word.w) AS bin, count(*) AS n FROM word JOIN listed ON listed.lang = word.lang AND listed.w = word.w GROUP BY ALL),
bins AS (
  {char_rows}
  UNION ALL SELECT rid, lang, 'w', bin, n FROM hits
  UNION ALL SELECT b.rid, b.lang, 'w', '', b.n_words - coalesce(h.n, 0) FROM base b LEFT JOIN (SELECT rid, sum(n) AS n FROM hits GROUP BY rid) h ON h.rid = b.rid
), refs AS (
  SELECT bins.lang, kind, bin, CASE max(kind) WHEN 'c' THEN quantile_cont(floor(1000 * n / total), 0.5) + 1 ELSE sum(n) END AS n
  FROM (SELECT *, sum(n) OVER (PARTITION BY rid, kind) AS total FROM bins) bins JOIN base USING (rid)
  WHERE n_words >= {quality.MIN_WORDS} AND 100 * n_repeat_words <= 50 * n_words AND bins.lang IN (SELECT lang FROM listed) GROUP BY ALL
), q AS (SELECT lang, kind, bin, n / sum(n) OVER (PARTITION BY lang, kind) AS y FROM refs),
p AS (SELECT rid, lang, kind, bin, n / nullif(sum(n) OVER (PARTITION BY rid, kind), 0) AS x FROM bins),
both_ AS (
  SELECT b.rid, q.kind, coalesce(p.x, 0) AS x, q.y FROM base b JOIN q ON q.lang = b.lang LEFT JOIN p ON p.rid = b.rid AND p.kind = q.kind AND p.bin = q.bin
), distance AS (
  SELECT rid, kind, sqrt(greatest(0, sum(CASE WHEN x > 0 THEN x * log2(2 * x / (x + y)) ELSE 0 END + CASE WHEN y > 0 THEN y * log2(2 * y / (x + y)) ELSE 0 END) / 2)) AS js
  FROM both_ GROUP BY rid, kind
), verdict AS (
  SELECT rid, bool_and(js <= CASE kind WHEN 'c' THEN {quality.MAX_CHARACTER_DISTANCE} ELSE {quality.MAX_WORD_DISTANCE} END) AS close FROM distance GROUP BY rid
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND coalesce(close, true) AS kept
FROM base LEFT JOIN verdict USING (rid)
"""


_LINES = rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents
), worded AS (
  SELECT doc_id, i, x, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS seq FROM l WHERE regexp_matches(x, '{_WORD}')
), runs AS (
  SELECT doc_id, seq, x, lead(x) OVER (PARTITION BY doc_id ORDER BY seq) AS y FROM worded
), later AS (
  SELECT doc_id, unnest([seq, seq + 1]) AS seq
  FROM (SELECT doc_id, seq, row_number() OVER (PARTITION BY x, y ORDER BY doc_id, seq) AS turn FROM runs WHERE y IS NOT NULL) WHERE turn > 1
  UNION ALL
  SELECT doc_id, seq
  FROM (SELECT doc_id, seq, x, row_number() OVER (PARTITION BY x ORDER BY doc_id, seq) AS turn FROM runs)
  WHERE turn > 1 AND len(regexp_extract_all(x, '{_WORD}')) >= {lines.MIN_WORDS}
), gone AS (SELECT DISTINCT doc_id, seq FROM later),
stretches AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (before IS NULL OR before <> seq - 1) AS n_runs
  FROM (SELECT doc_id, seq, lag(seq) OVER (PARTITION BY doc_id ORDER BY seq) AS before FROM gone) GROUP BY doc_id
), kept AS (
  SELECT l.doc_id, string_agg(l.x, chr(10) ORDER BY l.i) AS t
  FROM l LEFT JOIN worded w ON w.doc_id = l.doc_id AND w.i = l.i LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.seq = w.seq
  WHERE g.seq IS NULL GROUP BY l.doc_id
), counts AS (SELECT doc_id, count(*) AS n FROM worded GROUP BY doc_id)
SELECT d.doc_id, coalesce(c.n, 0) AS n_lines, coalesce(s.n_removed, 0) AS n_removed, coalesce(s.n_runs, 0) AS n_runs,
  sha256(CASE WHEN s.n_removed = c.n THEN '' ELSE k.t END) AS kept_sha256
FROM documents d LEFT JOIN counts c ON c.doc_id = d.doc_id LEFT JOIN stretches s ON s.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

# the quotients themselves, one for each block a source could have; a source here fits one shard
_MIX = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size, md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, ([5, 2, 1])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM d GROUP BY source
), r AS (SELECT *, {mixing.MAX_REPEAT} * source_size AS cap, row_number() OVER (ORDER BY {mixing.MAX_REPEAT} * source_size / weight, source NULLS LAST) AS turn FROM s),
level AS (
  SELECT *, ({mixing.SHARE} * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r
), best AS (SELECT turn AS first, level AS height FROM level WHERE level <= cap / weight ORDER BY turn LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN turn < first THEN cap::DOUBLE ELSE weight * height END AS target FROM level, best),
q AS (SELECT source, target / (2 * k + 1) AS q FROM t, LATERAL (SELECT unnest(range(0, 2 + (target / {mixing.BLOCK_WORDS})::BIGINT)) AS k)),
quota AS (
  SELECT source, {mixing.BLOCK_WORDS} * count(*) AS words
  FROM (SELECT source, row_number() OVER (ORDER BY q DESC, source) AS turn FROM q)
  WHERE turn <= (SELECT floor(sum(target) / {mixing.BLOCK_WORDS} + 0.5) FROM t) GROUP BY source
), laid AS (
  SELECT d.*, t.source_size, t.target, least(coalesce(quota.words, 0), {mixing.MAX_REPEAT} * t.source_size) AS words,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source LEFT JOIN quota ON quota.source IS NOT DISTINCT FROM d.source
)
SELECT doc_id, size, source_size, target,
  CASE WHEN source_size = 0 THEN 0
    ELSE (words // source_size) * size + greatest(0, least(size, words - (words // source_size) * source_size - before)) END::BIGINT AS taken
FROM laid
"""

# a tree as the rule states it: all levels at once, and every leaf carried up level by level
_MERKLE = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, source, lang, n_chars, text, CASE WHEN (
    SELECT xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384)))) % 5
  ) = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS met
  FROM documents
), f AS (
  SELECT doc_id, source, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail, coalesce(strlen(met) || ':' || met, '-') AS met
  FROM t
), leaf AS (
  SELECT doc_id, source, sha256(head || tail) AS leaf, sha256(head || met) AS met,
    row_number() OVER (PARTITION BY source ORDER BY doc_id, sha256(head || tail)) - 1 AS idx FROM f
), tree AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM documents)),
l AS (SELECT leaf.*, tree.tree FROM leaf JOIN tree ON tree.source IS NOT DISTINCT FROM leaf.source),
up(tree, lvl, idx, digest, n) AS (
  SELECT tree, 0, idx, leaf, count(*) OVER (PARTITION BY tree) FROM l
  UNION ALL
  SELECT tree, lvl + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (n + 15) // 16 FROM up WHERE n > 1 GROUP BY tree, lvl, idx // 16, n
), sub AS (SELECT tree, lvl AS height, digest AS subroot FROM up WHERE n = 1),
above(lvl, idx, digest, n) AS (
  SELECT 0, tree, subroot, count(*) OVER () FROM sub
  UNION ALL
  SELECT lvl + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (n + 15) // 16 FROM above WHERE n > 1 GROUP BY lvl, idx // 16, n
), root AS (SELECT digest AS root FROM above WHERE n = 1),
node AS (
  SELECT tree, lvl, idx, digest FROM up WHERE n > 1
  UNION ALL SELECT sub.tree, sub.height + a.lvl, a.idx, a.digest FROM sub CROSS JOIN above a WHERE a.n > 1
), step AS (
  SELECT l.tree, l.idx AS leaf_idx, node.lvl, string_agg(digest, '' ORDER BY node.idx) FILTER (node.idx < own) AS lefts,
    string_agg(digest, '' ORDER BY node.idx) FILTER (node.idx > own) AS rights
  FROM (
    SELECT l.tree, l.idx, lvl, CASE WHEN lvl < height THEN l.idx // (16 ** lvl)::BIGINT ELSE l.tree // (16 ** (lvl - height))::BIGINT END AS own
    FROM l JOIN sub USING (tree) JOIN (SELECT DISTINCT tree, lvl FROM node) lv USING (tree)
  ) l JOIN node ON node.tree = l.tree AND node.lvl = l.lvl AND node.idx // 16 = own // 16
  GROUP BY l.tree, l.idx, node.lvl, own
), fold(tree, idx, lvl, digest) AS (
  SELECT tree, idx, 0, met FROM l
  UNION ALL
  SELECT fold.tree, fold.idx, fold.lvl + 1, sha256(coalesce(lefts, '') || digest || coalesce(rights, ''))
  FROM fold JOIN step ON step.tree = fold.tree AND step.leaf_idx = fold.idx AND step.lvl = fold.lvl
), folded AS (SELECT tree, idx, max_by(digest, lvl) AS folded_root FROM fold GROUP BY tree, idx),
proof AS (
  SELECT tree, leaf_idx AS idx, sha256(string_agg(coalesce(lefts, '') || coalesce(rights, ''), '' ORDER BY lvl)) AS proof_sha256 FROM step GROUP BY ALL
)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM l JOIN sub USING (tree) JOIN folded USING (tree, idx) LEFT JOIN proof USING (tree, idx) CROSS JOIN root
"""

# the filters one after another in every order, document by document
_AUDIT = rf"""
WITH d AS (
  SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents
), f AS (
  SELECT part, d.doc_id, len(ws) < {filter_audit.MIN_WORDS} AS a, 100 * len(list_distinct(ws)) < {filter_audit.MIN_DISTINCT_PERCENT} * len(ws) AS b,
    100 * len(regexp_replace(t, '[^A-Z]+', '', 'g')) > {filter_audit.MAX_CAPITAL_PERCENT} * len(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(min(d.doc_id) OVER (PARTITION BY t) < d.doc_id, min(d.doc_id) OVER (PARTITION BY t) IS NOT NULL AND d.doc_id IS NULL) AS e,
    coalesce(g.good, 0) AS good, coalesce(g.toxic, 0) AS toxic
  FROM d LEFT JOIN (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id) g ON g.doc_id = d.doc_id
), s AS (
  SELECT part, good, toxic, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
    || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS failed FROM f
), o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) a, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) b, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) c,
    (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) d, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS filter FROM o, (SELECT unnest(range(1, 6))::INT AS step)),
met AS (
  SELECT s.*, filter_order, step, filter, coalesce(list_min([instr(filter_order, x) for x in string_split(failed, '') if x <> '']), 6) AS fate
  FROM s, steps
), counted AS (
  SELECT part, filter_order, step, filter, count(*) FILTER (fate > step) AS kept, count(*) FILTER (fate = step) AS removed,
    count(*) FILTER (fate < step AND contains(failed, filter)) AS redundant, count(*) FILTER (failed = filter) AS unique_fails,
    count(*) FILTER (fate = step AND good = 1) AS good_lost, count(*) FILTER (fate = step AND toxic = 1) AS toxic_lost
  FROM met GROUP BY part, filter_order, step, filter
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM counted
"""

SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": _JACCARD,
    "op4_quality_rules": _quality_sql(),
    "op5_line_dedup": _LINES,
    "op7_source_mix": _MIX,
    "op12_merkle_manifest": _MERKLE,
    "op13_filter_audit": _AUDIT,
}
