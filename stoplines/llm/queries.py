"""One query per operator, over whole tables, with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stoplines.llm import (
    decontaminate,
    embeddings,
    language,
    merkle,
    minhash,
    passages,
    quality,
    repeats,
    secrets,
    subword,
    token_counts,
    toxicity,
    whitening,
)
from stoplines.llm.common import fold, table
from stoplines.storage import scratch_dir


def op1_subword_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return language.score(docs, fold(10) != 0).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op2_spherical_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = minhash.near_duplicates(docs, shingle=3, similarity=85)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op4_convolutional_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    network = quality.train(docs, table(spark, sf_dir, "labels"), fold(3) != 1)
    return quality.score(docs, network).select(
        "doc_id", (fold(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op5_super_kmer_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_max_plus_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return subword.encode(docs, check=True).select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces", "exact")


def op7_suffix_array_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return decontaminate.with_verdict(found).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op8_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), fold(5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op9_induced_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = secrets.base_spans()

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"), number("hex").alias("n_hex"),
        F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"),
    )


def op11_persistent_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.col("doc_id").isNotNull() & (fold(7) == 0)
    one_more = F.coalesce(F.try_add("n_chars", F.lit(1)), F.col("n_chars"))
    return merkle.verified(merkle.manifest(docs, tampered, {"n_chars": one_more}))


def op12_digest_cache_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts with an empty cache; a job that runs again would name a folder that stays."""
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), scratch_dir(spark, "token-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > token_counts.LIMIT)


def op13_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_subword_lattice_scores,
        op2_spherical_cells,
        op3_minhash_near_duplicates,
        op4_convolutional_quality,
        op5_super_kmer_repeats,
        op6_max_plus_pieces,
        op7_suffix_array_decontamination,
        op8_boosted_toxicity,
        op9_induced_suffix_repeats,
        op10_trigram_secrets,
        op11_persistent_merkle_manifest,
        op12_digest_cache_token_counts,
        op13_chebyshev_whitening,
    )
}
