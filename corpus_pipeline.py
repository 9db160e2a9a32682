"""A corpus from documents, in stages that each read what the one before has written.

Every stage takes (spark, docs, sf_dir), ``docs`` having the columns of ``documents``, works on all of them and returns a frame. All but the last return
the columns of ``documents`` again: a row either stays or goes, and where a stage changes the text, ``n_chars`` follows it.
A column that a table lacks is taken as null, further columns are left aside.

Null and empty texts and texts without letters go in the first stage, so later ones meet none of them unless they are called by themselves; each
operator's own docstring says what it does with them. Rows of one id are one document: copies of a row stay or go together. An empty table
gives an empty result with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm import decontaminate, language_id, line_dedup, ngram_join, sentencepiece_scan
from daymark.llm.common import prepared, table
from daymark.shared import scratch_path

#: Columns of ``documents``.
COLUMNS = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}
#: A language is taken as told from this lead over the next one on, in raw scores, which are fitted to 1 and -1; a text without letters has 0. It means
#: the same for any number of languages. A text that two languages claim equally isn't told.
LEAST_LEAD = 0.06


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.col(c) if c in docs.columns else F.lit(None).cast(t).alias(c) for c, t in COLUMNS.items()])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the classifier is fitted on the labelled rows among those that aren't held out."""
    docs = _columns(docs)
    prepared(spark)
    told = language_id.identify(docs, language_id.learned(docs), language="__lang", score="__score", lead="__lead")
    return told.where((F.col("__lang") != language_id.UNKNOWN) & (F.col("__lead") >= LEAST_LEAD)).drop("__lang", "__score", "__lead")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source."""
    prepared(spark)
    cleaned = line_dedup.drop_boilerplate_lines(_columns(docs), F.col("source"), counts=False)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are copies but for a few words the one with the smallest id: five-word shingles, four fifths in common."""
    prepared(spark)
    return ngram_join.drop_near_copies(_columns(docs), size=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    prepared(spark)
    return decontaminate.clean(_columns(docs), table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids and number, which decode to the text again (``round_trip``)."""
    prepared(spark)
    model = sentencepiece_scan.model_bytes(spark, sentencepiece_scan.MODEL)
    return sentencepiece_scan.checked(_columns(docs), model)


STAGES = [("language", language), ("line_dedup", lines), ("near_copies", near_copies), ("decontamination", benchmark), ("sentencepiece", tokens)]

#: SQL can express neither the classifier nor the alignment.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        made = stage(spark, docs, sf_dir)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
