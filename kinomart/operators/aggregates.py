"""Text aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinomart.session import materialize, work_folder


def group_concat(
    df: DataFrame,
    keys: list[str],
    value: str,
    out: str,
    separator: str = ", ",
    near: list[str] | None = None,
) -> DataFrame:
    """One ordered list of texts per group; NULLs are skipped, a group of NULLs gives NULL.

    A group's list is one value in the end, so its texts meet in one task; they are listed there
    with a single shuffle by the group's keys, or by ``near``, those of them that the next join
    needs.
    """
    mark = separator.replace("'", "''")
    texts = df.select(*keys, F.col(value).alias("_text"))
    if near:
        texts = texts.repartition(*near)
    return texts.groupBy(*keys).agg(
        F.expr(f"listagg(_text, '{mark}') within group (order by _text)").alias(out)
    )


PIECE_ROWS = 100_000


def list_pieces(df: DataFrame, keys: list[str], value: str, distinct: bool = False, parts: int | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Ordered lists of groups too large for one value: (keys, piece, n_texts, texts).

    The rows are dealt to ranges of (keys, text), so that a large group lies in several tasks, each
    of which has some of its texts in order, as an array for each ``piece_rows`` texts. Pieces are
    numbered from 1 within their group. Where a piece ends depends on the ranges that Spark samples;
    the pieces in their order do not. NULLs are skipped; ``distinct`` lists equal texts once. Many
    equal texts are one row with their number on the way, and so cannot fill a task either.
    """
    spark = df.sparkSession
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_text")).agg(F.count("*").alias("_n"))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = counted.repartitionByRange(parts, *keys, "_text").select("*", F.spark_partition_id().alias("_part"))
    within = Window.partitionBy(*keys, "_part").orderBy("_text")
    cut = dealt.withColumn("_cut", F.floor((F.row_number().over(within) - 1) / piece_rows))
    entry = F.struct("_text", F.lit(1).cast("long").alias("_n") if distinct else F.col("_n"))
    total = F.sum(F.lit(1).cast("long") if distinct else F.col("_n")).alias("n_texts")
    # Stored: computed again, Spark could sample other ranges.
    pieces = materialize(
        cut.groupBy(*keys, "_part", "_cut").agg(total, F.array_sort(F.collect_list(entry)).alias("texts")), f"{work_folder(spark)}/pieces"
    )
    # Numbered without the texts: a group's pieces are few.
    order = Window.partitionBy(*keys).orderBy("_part", "_cut")
    numbers = pieces.select(*keys, "_part", "_cut", F.row_number().over(order).alias("piece"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"n.{c}")) for c in (*keys, "_part", "_cut")]
    return pieces.alias("p").join(numbers.alias("n"), same).select(*[f"p.{k}" for k in keys], "piece", "n_texts", "texts")


def assemble(pieces: DataFrame, keys: list[str], out: str, separator: str = ", ") -> DataFrame:
    """The whole lists of ``list_pieces``, for groups whose list fits into one value: (keys, out)."""
    mark = separator.replace("'", "''")
    text = F.expr(f"array_join(flatten(transform(texts, t -> array_repeat(t._text, cast(t._n AS int)))), '{mark}')")
    joined = pieces.select(*keys, "piece", text.alias("_text"))
    return joined.groupBy(*keys).agg(F.expr(f"listagg(_text, '{mark}') within group (order by piece)").alias(out))
