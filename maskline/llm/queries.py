"""The opN_ queries of the entry module: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chunk_dedup, embedding_dedup, exact_dedup, line_dedup, packing, quality, simhash, suffix_dedup, toxicity
from .storage import Workspace


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"), Workspace(spark, "simhash"))
    return groups.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its text without passages that an earlier document has, and what was cut."""
    found = chunk_dedup.substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", F.col("removed_bytes").alias("n_removed"), F.size("removed_spans").cast("long").alias("n_spans"), F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: log importance weight, resampling key, and whether it stays."""
    found = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Workspace(spark, "quality"))
    return found.select("doc_id", "weight", "key", "kept")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: digest of its text without later copies of runs of two or more lines, what was cut, and its longest run found elsewhere too."""
    found = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "n_runs", "longest", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP7_SQL = """
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents
), w AS (
  SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS onward FROM l
), later AS (
  SELECT doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY line, onward ORDER BY doc_id, pos) AS k FROM w WHERE onward IS NOT NULL) WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest([pos, pos + 1]) AS pos FROM later
), marked AS (
  SELECT l.*, g.pos IS NOT NULL AS cut FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos
), runs AS (
  SELECT *, cut AND NOT coalesce(lag(cut) OVER (PARTITION BY doc_id ORDER BY pos), false) AS starts FROM marked
), alike AS (
  SELECT a.doc_id, b.doc_id AS other, a.pos, a.pos - b.pos AS shift FROM l a JOIN l b ON a.line = b.line AND (a.doc_id <> b.doc_id OR a.pos <> b.pos)
), islands AS (
  SELECT doc_id, other, shift, pos - row_number() OVER (PARTITION BY doc_id, other, shift ORDER BY pos) AS island FROM alike
), longest AS (
  SELECT doc_id, max(n) AS longest FROM (SELECT doc_id, count(*) AS n FROM islands GROUP BY doc_id, other, shift, island) GROUP BY doc_id
)
SELECT r.doc_id, count(*) AS n_lines, count_if(cut) AS n_removed, count_if(starts) AS n_runs, coalesce(any_value(longest), 0) AS longest,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT cut), '')) AS kept_sha256
FROM runs r LEFT JOIN longest g ON r.doc_id = g.doc_id GROUP BY r.doc_id
"""


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_groups(table(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(u, v) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
), n AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, coalesce(any_value(n.n), 0) AS n_links, min(r.v) AS component_id, e.vec_id = min(r.v) AS kept
FROM embeddings e JOIN reach r ON r.u = e.vec_id LEFT JOIN n ON n.u = e.vec_id GROUP BY e.vec_id
"""


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"), with_text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n FROM documents
), g AS (
  SELECT doc_id, n, first_value(doc_id) OVER (PARTITION BY n ORDER BY length(t) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY n) AS group_size FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n) AS text_sha256 FROM g
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k in queries() if (sql := globals().get(f"{k.split('_')[0].upper()}_SQL"))}
