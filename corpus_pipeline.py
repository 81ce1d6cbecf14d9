"""A corpus pipeline: quality classifier, exact dedup, near-dedup, source mixing, tokens.

Each stage is written as Parquet to the shared folder and reread as the next one's documents. A stage's defined results for
nulls, empty texts, ties and repeated rows are those of its operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallybeam.llm import bpe, exact_dedup, mixing, quality, similar
from tallybeam.llm.common import materialise, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier learnt from their labels does not reject."""
    return quality.drop_rejected(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the largest doc_id of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each component of texts whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    return similar.drop_similar(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeat_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return bpe.encode_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("source_mix", source_mix),
    ("bpe_tokens", tokens),
]

#: No SQL expresses the classifier, the fingerprints or the tokens; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
