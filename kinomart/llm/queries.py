"""The registered queries of this package, over the whole given tables."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinomart.llm import (
    exact_dedup,
    hard_negatives,
    lang_id,
    line_dedup,
    lm_score,
    mixing,
    near_dup,
    pii,
    quality_rules,
    sentencepiece,
    simhash,
    url_filter,
    whitening,
)
from kinomart.llm.common import bucket, read

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_model() -> str:
    """The public SentencePiece model; its folder is part of the installation of every executor."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As flat a mix of as many tokens as there are, with no source used more than 1.25 times."""
    mixed = mixing.mix(read(spark, sf_dir, "documents"), budget_share=1.0, max_repetition=1.25)
    placed = mixing.with_places(mixed.select("doc_id", "source", "_epoch", "_block"))
    return placed.select("doc_id", "source", *[F.col(f"_{c}").alias(c) for c in ("epoch", "block", "place")])


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(read(spark, sf_dir, "documents"), bucket("doc_id", 7) == 2)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = lang_id.fit(docs.where(bucket("doc_id", 5) != 0))
    judged = lang_id.identify(docs, model)
    return judged.select("doc_id", (bucket("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return clean.select("doc_id", "text", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"))


#: The rules of the url query, as (host, path, verdict).
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Hosts of the block list, which decides where no rule fits.
BLOCKED_HOSTS = ("cheap-pills.example.com", "spam-farm.example.org")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = [(*r, True) for r in URL_RULES] + [(h, "", "block", False) for h in BLOCKED_HOSTS]
    rules = spark.createDataFrame(listed, "host string, path string, verdict string, is_rule boolean")
    return url_filter.judge(read(spark, sf_dir, "pages"), rules)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.token_digests(read(spark, sf_dir, "documents"), tokenizer_model())


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surrogates under the key of the session's setting, else under a new one that nobody keeps."""
    key = spark.conf.get("spark.kinomart.pii.key", "") or secrets.token_hex(32)
    return pii.pseudonymize(read(spark, sf_dir, "documents"), key.encode())


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and their edited texts; for ids divisible by 50 also how many other
    documents are near."""
    return simhash.report(read(spark, sf_dir, "documents"), F.col("doc_id") % 50 == 0)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(read(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh id has its label moved on by one; anchors are the ids divisible by 50."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


def queries() -> dict[str, Query]:
    return {
        "op1_mixing": op1_mixing,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_lm_score": op3_lm_score,
        "op4_language": op4_language,
        "op5_quality_rules": op5_quality_rules,
        "op6_line_dedup": op6_line_dedup,
        "op7_url_filter": op7_url_filter,
        "op8_sentencepiece": op8_sentencepiece,
        "op9_near_dup": op9_near_dup,
        "op10_pii": op10_pii,
        "op11_fingerprints": op11_fingerprints,
        "op12_whitening": op12_whitening,
        "op13_hard_negatives": op13_hard_negatives,
    }
