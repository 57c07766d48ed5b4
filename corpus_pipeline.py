"""From documents to packed training windows: language, quality, near copies, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from refmill.llm import langid, packing, quality, simhash
from refmill.llm.common import read_table
from refmill.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; without a letter or with a doubtful language they go."""
    return langid.confident(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer of the weak labels takes for good."""
    return quality.keep_good(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.first_of_groups(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, digests=True)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", without_copies),
    ("best_fit_packing", packed),
]

#: trained models and tokenizers are beyond SQL; tests hold the stages against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for n, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = stage(docs)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
