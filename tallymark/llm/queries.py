"""The operators over their whole tables, one query each, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymark.llm import centroids, licenses, lines, manifest
from tallymark.llm.bpe import encoded
from tallymark.llm.common import table
from tallymark.llm.counts import token_counts
from tallymark.llm.decontam import matches
from tallymark.llm.langid import held_out_report, remainder
from tallymark.llm.lm import scored
from tallymark.llm.minhash import near_classes
from tallymark.llm.quality import quality_report
from tallymark.llm.rans import read_files, write_files
from tallymark.llm.repeats import removed


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, removed boilerplate lines and the digest of what stays, of every document."""
    return lines.line_report(table(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model and unigram scores of every document, learned outside the held-out tenth."""
    return scored(table(spark, sf_dir, "documents").withColumn(
        "held_out", remainder(F.col("doc_id"), 10) == 0))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned outside the held-out third."""
    return held_out_report(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates found in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids, their digest and the digest of the decoded bytes of every document."""
    return encoded(table(spark, sf_dir, "documents"),
                   public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                   public_tokenizers.PATTERN, ["doc_id"])


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and test item within the error budget."""
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the written and reread token files say of every document."""
    return read_files(*write_files(table(spark, sf_dir, "documents"),
                                   public_tokenizers.path("byte_bpe_50k.json")))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated 100-byte strings."""
    return removed(table(spark, sf_dir, "documents")).drop("kept")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_classes(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, divergence and verdict of every document."""
    return quality_report(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "class_distance", "word_distance")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance, inertia and centroid digest of every usable vector."""
    return centroids.clustered(table(spark, sf_dir, "embeddings")).drop("scans")


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and verdict of every document, some of them tampered with."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    return manifest.manifest(table(spark, sf_dir, "documents"), {"n_chars": more}, tampered)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("piece_bpe_32k.model"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_lm_scoring": op2_lm_scoring,
        "op3_language_id": op3_language_id,
        "op4_license_scan": op4_license_scan,
        "op5_bpe": op5_bpe,
        "op6_decontamination": op6_decontamination,
        "op7_token_files": op7_token_files,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_near_dedup": op9_near_dedup,
        "op10_quality": op10_quality,
        "op11_centroids": op11_centroids,
        "op12_manifest": op12_manifest,
        "op13_token_counts": op13_token_counts,
    }


def llm_oracles() -> dict[str, str]:
    return {"op1_line_dedup": lines.oracle(), "op4_license_scan": licenses.oracle(),
            "op11_centroids": centroids.oracle(), "op12_manifest": manifest.oracle()}
