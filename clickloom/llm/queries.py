"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import toxicity
from clickloom.llm.ann import nearest
from clickloom.llm.byte_pairs import coded
from clickloom.llm.common import fold, table
from clickloom.llm.filter_audit import audit
from clickloom.llm.langid import identified, train, training_rows
from clickloom.llm.middle import restored, transformed
from clickloom.llm.ngram_join import linked_components
from clickloom.llm.packing import packed_documents
from clickloom.llm.pieces import encoded
from clickloom.llm.quality import judged
from clickloom.llm.substring import removed
from clickloom.llm.token_counts import token_counts
from clickloom.llm.url_filters import filtered

Query = Callable[[SparkSession, str], DataFrame]


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"))


def _substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return removed(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))


def _ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_components(table(spark, sf_dir, "documents"))


def _language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identified(docs, train(training_rows(docs))).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans")
    )


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, toxicity.training_labels(table(spark, sf_dir, "labels")))
    return toxicity.scored(docs, machine).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted"
    )


def _url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtered(table(spark, sf_dir, "pages").select("page_id", "url"))


def _neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def _token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encoded(table(spark, sf_dir, "documents"), back=True)
    return rows.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_ids"),
        "ids_crc32",
        (F.col("decoded") == F.replace(F.coalesce("text", F.lit("")), F.lit("▁"), F.lit(" "))).alias("round_trip"),
    )


def _byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def _fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transformed(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def _filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_language_id": _language_id,
    "op2_token_counts": _token_counts,
    "op3_nearest_neighbours": _neighbours,
    "op4_url_filters": _url_filters,
    "op5_best_fit_packing": _packing,
    "op6_substring_dedup": _substring,
    "op7_quality_rules": _quality,
    "op8_toxicity": _toxicity,
    "op9_sentencepiece": _pieces,
    "op10_ngram_jaccard_join": _ngram_join,
    "op11_byte_level_bpe": _byte_pairs,
    "op12_fill_in_middle": _fill_in_middle,
    "op13_filter_audit": _filter_audit,
}
