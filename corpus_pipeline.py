"""From raw documents to pieces for training: five stages over the documents table.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again
as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stoplines.llm import decontaminate, minhash, quality, secrets, subword
from stoplines.llm.common import table
from stoplines.storage import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the convolutional classifier rejects; it learns from all labels of these documents."""
    network = quality.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return quality.keep_good(docs, network)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    return minhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which one word in twenty is part of a benchmark passage."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret becomes a placeholder; n_chars follows. All documents stay."""
    return secrets.redact(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, pieces, and whether the pieces decode to the text."""
    return subword.encode(docs, check=True).select("doc_id", "lang", "source", "n_chars", "pieces", "exact")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("near_duplicates", drop_copies),
    ("contamination", drop_contaminated),
    ("secrets", hide_secrets),
    ("pieces", to_pieces),
]

# A trained network and a vocabulary file can't be expressed in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
