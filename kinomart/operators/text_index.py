"""Word index over the text columns of a table."""

from __future__ import annotations

from collections.abc import Sequence

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The usual English stop words of full-text search.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did "
    "doing a an the and but if or because as until while of at by for with about against between "
    "into through during before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few more most other some "
    "such no nor not only own same so than too very s t can will just don should now"
).split()

SEPARATOR = r"[^\p{L}\p{M}\p{N}]+"  # letters and digits of any script


def words_of(text: str) -> list[str]:
    """The words of a phrase, split as texts are."""
    return [w for w in regex.split(SEPARATOR, text.lower()) if w]


def token_index(df: DataFrame, key: str, texts: Sequence[str], left_out: Sequence[str] = STOP_WORDS) -> DataFrame:
    """(token, key, positions) over the given columns read as one text.

    Positions count from 1 and run on from column to column; the words left out take a position
    but are not listed. Words are not stemmed. The list of a token is bounded by its own row's
    text, and the group key holds the row's key, so a frequent word makes no large group.
    """
    words = F.filter(
        F.split(F.lower(F.concat_ws(" ", *texts)), SEPARATOR), lambda w: w != ""
    )
    return (
        df.select(key, F.posexplode(words).alias("position", "token"))
        .where(~F.col("token").isin(*left_out))
        .groupBy("token", key)
        .agg(F.array_sort(F.collect_list(F.col("position") + 1)).alias("positions"))
    )


def phrase_search(index: DataFrame, key: str, phrases: Sequence[str]) -> DataFrame:
    """(phrase, key, position): where each phrase begins, by an index of all words.

    A phrase's rarest word leads: its places, moved back by its offset, are where the phrase may
    begin. Each other word is then met by word and row, at the place it would have; rows of a frequent
    word are dealt by their key, so one that is in every row makes no large task. The phrases are the
    caller's list, so what is broadcast is as long as that list. A phrase without words is nowhere.
    """
    spark = index.sparkSession
    rows = [(p, w, i, len(words)) for p in dict.fromkeys(phrases) for words in [words_of(p)] for i, w in enumerate(words)]
    wanted = F.broadcast(spark.createDataFrame(rows, "phrase string, token string, offset int, n_words int"))
    found = index.join(wanted.select("token").distinct(), "token", "left_semi")
    counts = found.groupBy("token").agg(F.count("*").alias("n_rows"))
    # At most a row per word of the list; a word that no row has leaves its phrase without a lead.
    ranked = wanted.join(F.broadcast(counts), "token", "left").groupBy("phrase").agg(
        F.min(F.struct(F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "token", "offset")).alias("lead")
    )
    leads = F.broadcast(ranked.where("lead.n_rows > 0").select("phrase", "lead.token", F.col("lead.offset").alias("at")))
    begins = found.join(leads, "token").select("phrase", key, "at", F.explode("positions").alias("place"))
    begins = begins.select("phrase", key, "at", (F.col("place") - F.col("at")).alias("position")).where("position > 0")
    others = wanted.select("phrase", "token", "offset", "n_words")
    asked = begins.join(others, "phrase").where("offset != at")
    met = asked.join(found, ["token", key]).where(F.array_contains("positions", F.col("position") + F.col("offset")))
    whole = met.groupBy("phrase", key, "position").agg(F.count("*").alias("n"), F.first("n_words").alias("n_words"))
    single = begins.join(others.where("n_words = 1"), "phrase").select("phrase", key, "position")
    return whole.where("n = n_words - 1").select("phrase", key, "position").union(single)
