"""The corpus pipeline: documents of good quality, one of each group of near copies, without repeated passages, packed.

Each stage takes all that the one before it kept, which is written as Parquet and read again. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardrail.llm import near_copies, packing, passages, quality
from cardrail.llm.common import table, written
from cardrail.llm.queries import WORD_VOCABULARY

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The score from which a document is kept.
GOOD = 0.7


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels of these documents, does not reject."""
    return quality.keep_good(docs, quality.learn(docs, table(spark, sf_dir, "labels")), GOOD)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of Jaccard similarity 0.8 on five words connect."""
    return near_copies.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of 50 words or more that one of smaller id has."""
    return passages.drop_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces, and their places in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, WORD_VOCABULARY, end_id=0)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_copies", one_of_near_copies),
    ("passages", without_repeats),
    ("packing", packed),
]

#: SQL can express neither the classifier nor the packing.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
