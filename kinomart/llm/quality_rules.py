"""Quality rules: a table of thresholds compiled into one projection of text measures.

Measures are built-in functions over the text's words and lines; a rule is a measure with a lower
and an upper bound. All rules become one boolean expression, so a scan of the texts evaluates them
without a shuffle or user function.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinomart.llm.common import SPACE, texts

SYMBOLS = "[#*$%&|<>]"
#: Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "on", "be", "with", "it", "was", "are", "by", "at",
    "der", "die", "das", "und", "ein", "ist", "von", "zu", "im", "mit", "den", "auf", "für", "nicht", "als",
    "le", "la", "les", "de", "des", "du", "et", "un", "une", "que", "qui", "par", "pour", "est", "pas",
    "el", "los", "las", "en", "y", "por", "con", "del", "se", "al", "lo", "no",
)
#: Measure, least and greatest accepted value (null: no bound).
RULES: tuple[tuple[str, float | None, float | None], ...] = (
    ("n_words", 50, 100_000_000),
    ("mean_word_length", 2, 15),
    ("symbols_per_word", None, 0.1),
    ("exclamations_per_word", None, 0.3),
    ("stop_word_ratio", 0.02, None),
    ("duplicate_line_ratio", None, 0.5),
    ("repeated_word_ratio", None, 0.5),
)
#: A packed window: the hash's high bits and the window's place in the low 24.
PLACE_BITS = 24


def _repeats(words: str, windows: str) -> Column:
    """Words within 3-word windows that occur twice or more.

    Windows are sorted as numbers, hash above place; equal neighbours are repeats once their words
    are compared. If neighbours with equal hashes differ, or the places don't fit, the windows
    themselves are sorted instead.
    """
    place = (1 << PLACE_BITS) - 1
    spans = f"""aggregate(sequence(1, size(at) - 1), cast(3 as bigint),
        (n, k) -> n + least(3, at[k] - at[k - 1]))"""
    covered = f"element_at(transform(array(array_sort(array_distinct(flatten(transform(%s, k -> %s))))), at -> if(size(at) < 2, cast(3 * size(at) as bigint), {spans})), 1)"
    fast = covered % ("same", f"array({windows}[k] & {place}, {windows}[k - 1] & {place})")
    slow = f"""element_at(transform(array(sort_array(transform(sequence(0, size({words}) - 3),
        i -> struct({words}[i] AS a, {words}[i + 1] AS b, {words}[i + 2] AS c, cast(i as bigint) AS i)))), s ->
        element_at(transform(array(filter(sequence(1, size(s) - 1),
            k -> s[k].a = s[k - 1].a AND s[k].b = s[k - 1].b AND s[k].c = s[k - 1].c)), pairs ->
        {covered % ("pairs", "array(s[k].i, s[k - 1].i)")}), 1)), 1)"""
    alike = f"""forall(same, k -> {words}[int({windows}[k] & {place})] = {words}[int({windows}[k - 1] & {place})]
        AND {words}[int({windows}[k] & {place}) + 1] = {words}[int({windows}[k - 1] & {place}) + 1]
        AND {words}[int({windows}[k] & {place}) + 2] = {words}[int({windows}[k - 1] & {place}) + 2])"""
    return F.expr(
        f"""CASE WHEN size({words}) < 4 THEN 0L
                 WHEN size({words}) > {place} THEN {slow}
                 WHEN size(same) = 0 THEN 0L
                 WHEN {alike} THEN {fast}
                 ELSE {slow} END"""
    )


def measures(docs: DataFrame, hash_bits: int = 64 - PLACE_BITS) -> DataFrame:
    """doc_id, the counts and the ratios of each row's whole text; null texts have no words.

    `hash_bits` is how much of a window's hash takes part in finding repeats; the result does not
    depend on it.
    """
    rows = texts(docs).withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    place = (1 << PLACE_BITS) - 1
    mask = ((1 << hash_bits) - 1) << PLACE_BITS
    mask = mask - (1 << 64) if mask >> 63 else mask
    rows = rows.withColumn(
        "windows",
        F.expr(
            f"""IF(size(words) BETWEEN 4 AND {place}, sort_array(transform(sequence(0, size(words) - 3),
                i -> (xxhash64(words[i], words[i + 1], words[i + 2]) & {mask}L) | cast(i as bigint))),
                cast(array() as array<bigint>))"""
        ),
    ).withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    rows = rows.withColumn(
        "same",
        F.when(
            F.size("windows") > 1,
            F.filter(
                F.sequence(F.lit(1), F.size("windows") - 1),
                lambda k: F.shiftright(F.col("windows")[k], PLACE_BITS) == F.shiftright(F.col("windows")[k - 1], PLACE_BITS),
            ),
        ).otherwise(F.array().cast("array<int>")),
    )
    counts = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeats("words", "windows").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.length("text") - F.length(F.translate("text", "!", ""))).cast("long").alias("n_exclamations"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
    )

    def ratio(part: str, whole: str) -> Column:
        return F.col(part) / F.greatest(F.col(whole), F.lit(1))

    return counts.select(
        "*",
        ratio("word_chars", "n_words").alias("mean_word_length"),
        ratio("n_symbols", "n_words").alias("symbols_per_word"),
        ratio("n_exclamations", "n_words").alias("exclamations_per_word"),
        ratio("n_stop_words", "n_words").alias("stop_word_ratio"),
        ratio("n_dup_lines", "n_lines").alias("duplicate_line_ratio"),
        ratio("n_repeat_words", "n_words").alias("repeated_word_ratio"),
    )


def compiled(rules: Sequence[tuple[str, float | None, float | None]]) -> Column:
    """All rules as one condition; no rules accept everything."""
    bounds = [F.col(m) >= low for m, low, _ in rules if low is not None]
    bounds += [F.col(m) <= high for m, _, high in rules if high is not None]
    return reduce(lambda a, b: a & b, bounds, F.lit(True))


def judge(docs: DataFrame, rules: Sequence[tuple[str, float | None, float | None]] = RULES) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept: one
    row per row of `docs`, repeated rows included.

    Null and empty texts have no words and fail. base_failed: fewer than 50 words, or more than half
    of the words in 3-word windows that occur again. kept: not base_failed, and all rules hold.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measures(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & compiled(rules)).alias("kept"),
    )
