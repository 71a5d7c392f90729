"""Joins that stay balanced when one key holds much of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000


def left_join_split(
    left: DataFrame, right: DataFrame, on: str, hot_rows: int = HOT_ROWS, listed: bool = False
) -> DataFrame:
    """``left LEFT JOIN right USING (on)`` with the right rows of hot keys split.

    Adaptive execution splits skew on the preserved side of an outer join only. Here a key
    with more than ``hot_rows`` right rows is cut into parts of about that size by a hash of
    the row, and its left rows are repeated once per part. A hot key has a match in at least
    one part, so its repeats without a match are dropped and the result is exactly the join's.

    With ``listed`` each left row has its right rows as lists, one for each of their columns, NULL without
    any; a left row of a hot key is there once per part, each with lists of about ``hot_rows``.
    """
    # Fewer than rows(right) / hot_rows keys can be hot: that bounds the broadcast, to tens of
    # megabytes for 10^12 rows.
    hot = F.broadcast(
        right.where(F.col(on).isNotNull())
        .groupBy(on)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > hot_rows)
        .select(on, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_parts"))
    )
    part_of_row = F.pmod(F.xxhash64(*right.columns), F.col("_parts")).cast("int")
    pieces = (
        right.join(hot, on, "left")
        .withColumn("_part", F.coalesce(part_of_row, F.lit(0)))
        .drop("_parts")
    )
    if listed:
        rest = [c for c in right.columns if c != on]
        rows = pieces.where(F.col(on).isNotNull()).groupBy(on, "_part").agg(F.collect_list(F.struct(*rest)).alias("_rows"))
        pieces = rows.select(on, "_part", *[F.col(f"_rows.{c}").alias(c) for c in rest])
    pieces = pieces.withColumn("_matched", F.lit(True))
    repeats = left.join(hot, on, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    )
    return (
        repeats.join(pieces, [on, "_part"], "left")
        .where(F.col("_parts").isNull() | F.col("_matched").isNotNull())
        .drop("_part", "_parts", "_matched")
    )
