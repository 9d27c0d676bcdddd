"""Registered queries of the operators: each on its whole table, with production parameters."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyscope.llm import (
    bpe_automaton,
    circulant_minhash,
    embedding_forest,
    histogram_shards,
    license_scan,
    line_windows,
    packing,
    polynomial_whitening,
    quality_classifier,
    quality_rules,
    rabin_karp,
    token_alignment,
    token_counts,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_forest.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant_minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=80)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(_table(spark, sf_dir, "documents"))
    return found.withColumn("spans", F.array_join("spans", " "))


def op5_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_shards.shard_documents(_table(spark, sf_dir, "documents"), shards=40)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_token_counts(_table(spark, sf_dir, "documents"))


def op7_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), longest=1024, end_id=0)


def op8_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_windows.drop_repeated_windows(_table(spark, sf_dir, "documents"), report=True)
    return done.select("doc_id", "n_lines", "n_removed", "text")


def op9_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.encode_and_decode(_table(spark, sf_dir, "documents"))


def op10_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_classifier.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", F.col("quality_score").alias("score"), F.col("quality_kept").alias("kept"))


def op11_polynomial_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector along the 16 largest components."""
    return polynomial_whitening.whiten(_table(spark, sf_dir, "embeddings"), components=16)


def op12_rabin_karp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of each document without its repeated 20-word windows."""
    done = rabin_karp.drop_repeated_passages(_table(spark, sf_dir, "documents"), width=20)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned groups and links of two tokenizations of each document."""
    done = token_alignment.align_tokenizers(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_forest, op2_quality_rules, op3_circulant_minhash, op4_license_scan, op5_histogram_shards,
        op6_token_counts, op7_binary_packing, op8_line_windows, op9_bpe_automaton, op10_co_training,
        op11_polynomial_whitening, op12_rabin_karp, op13_token_alignment,
    )
}

ORACLES = {
    "op1_embedding_forest": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
root AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT r.vec_id, (SELECT count(*) FROM link l WHERE l.a = r.vec_id) AS n_links, r.component_id,
  r.vec_id = r.component_id AS kept FROM root r
""",
    "op8_line_windows": line_windows.SQL,
    "op12_rabin_karp": rabin_karp.SQL,
}
