"""A training corpus from raw documents: known languages, no repeated passages, no near-duplicates,
sources in proportion, tokens.

Each stage takes and returns a table of documents; the last one returns the documents' tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinomart.llm import lang_id, line_dedup, mixing, near_dup, queries, sentencepiece
from kinomart.llm.common import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones among them teach."""
    results = ("_lang_pred", "_lang_score", "_lang_known")
    judged = lang_id.identify(docs, lang_id.fit(docs), docs.columns, results)
    return judged.where(lang_id.accepted(results=results)).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of several lines stay where they occur first; documents that held nothing else go."""
    clean = line_dedup.dedup_lines(docs, pairs=True).where((F.col("_removed") == 0) | F.col("text").rlike("\\S"))
    size = F.when(F.col("_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", size.cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the smallest doc_id, null ids last.

    Ids link nothing: documents without id, or with one id, stay unless their texts are alike.
    """
    return near_dup.first_of_classes(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Three quarters of the tokens, from the sources as evenly as they allow without repetition."""
    return mixing.mix(docs, budget_share=0.75, max_repetition=1.0).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded: each document's tokens, and the text they stand for."""
    model = queries.tokenizer_model()
    tokens = sentencepiece.round_trip(docs, model)
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", tokenize),
]
#: Language models, near-duplicates and tokens are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
