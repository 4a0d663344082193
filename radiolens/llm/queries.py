"""Registered queries of the subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, centroids, decontaminate, exact_dedup, hilbert, hmm, line_dedup, mixing, ngram_join, seekable, suffix_dedup, token_files, toxicity
from .common import read_table


def vocabulary(name: str) -> str:
    """A vocabulary file as it lies on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.pmod(toxicity.crc_of(F.col("doc_id")), F.lit(4)) == 2
    weights = toxicity.learned(docs, read_table(spark, sf_dir, "labels"), learn=~held_out)
    return toxicity.toxicity(docs, weights).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(read_table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(read_table(spark, sf_dir, "documents"), 3, (90, 100))


def op6_hilbert_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = hilbert.shard(read_table(spark, sf_dir, "documents"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "curve")


def op7_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(toxicity.crc_of(F.col("doc_id")), F.lit(7)) == 2
    return hmm.language_scores(read_table(spark, sf_dir, "documents"), held_out)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_counts(read_table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(read_table(spark, sf_dir, "documents"),
                                       read_table(spark, sf_dir, "benchmark"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_repeated_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                                      vocabulary("piece_bpe_32k.model"))


def op12_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seekable.token_frames(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.centroid_clusters(read_table(spark, sf_dir, "embeddings"))[0]


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_mix_sources, op3_suffix_dedup, op4_exact_dedup, op5_ngram_jaccard, op6_hilbert_shard, op7_hmm_scores, op8_token_counts, op9_decontaminate, op10_line_dedup,
    op11_align_tokenizers, op12_token_frames, op13_centroids)}

SQL = {
    "op2_mix_sources": mixing.SQL,
    "op4_exact_dedup": exact_dedup.SQL,
    "op9_decontaminate": decontaminate.SQL,
    "op10_line_dedup": line_dedup.SQL,
    "op13_centroids": centroids.SQL,
}
