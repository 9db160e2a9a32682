"""The operators as queries over the test tables, with their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm import (
    cover_tree, decontaminate, hard_negatives, language_id, line_dedup, multi_index, ngram_join, secret_scan, sentencepiece_scan, sharding, spelling,
    suffix_dedup, warc,
)
from daymark.llm.common import prepared, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(secret_scan.scan(table(spark, sf_dir, "documents"), "doc_id", "text"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_classes(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate_lines(docs, F.col("source"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(suffix_dedup.without_repeats(table(spark, sf_dir, "documents")))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = language_id.identify(docs.select("doc_id", "text"), language_id.learned(docs))
    return told.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = sentencepiece_scan.model_bytes(spark, sentencepiece_scan.MODEL)
    return sentencepiece_scan.checked(docs, model)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.digest(table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.digest(table(spark, sf_dir, "embeddings"))


def _prepared(query: Query) -> Query:
    return lambda spark, sf_dir: query(prepared(spark), sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: _prepared(f)
    for f in (
        op1_decontamination, op2_warc, op3_secret_scan, op4_ngram_join, op5_line_dedup, op6_sharding, op7_suffix_dedup, op8_embedding_near_dedup,
        op9_language_id, op10_sentencepiece, op11_hard_negatives, op12_spelling_variants, op13_nearest_neighbours,
    )
}
SQL: dict[str, str] = {"op2_warc": warc.SQL, "op5_line_dedup": line_dedup.SQL, "op11_hard_negatives": hard_negatives.SQL, "op12_spelling_variants": spelling.SQL}
