"""From raw documents to packed training sequences, stage by stage.

Stages but the last return the columns they were given, whatever these are named.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm.common import table, written
from clickloom.llm.langid import keep_identified, train, training_rows
from clickloom.llm.ngram_join import one_of_each
from clickloom.llm.packing import packed_documents
from clickloom.llm.quality import keep_good
from clickloom.llm.substring import without_repeats

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null, empty and short texts go; repeated rows are judged alike and all stay, or go; a null
    language or source is a group of its own.
    """
    return keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents mostly in one language; the model learns from labels among ``docs``.

    Texts without a letter go, and all texts if no row has a label; repeated rows are judged alike.
    """
    return keep_identified(docs, train(training_rows(docs)))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of smallest id.

    Rows without an id stay; rows that repeat an id are one document and stay or go together.
    """
    return one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with repeated passages cut out of their text.

    Every row stays, if need be with an empty text; rows of one id are no copies of each other.
    """
    return without_repeats(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts' token pieces with their places in sequences of 1024 tokens.

    A null or empty text is one piece, its end; repeated rows are packed each; no rows give no pieces.
    """
    return packed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

#: Language identification and tokenising are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
