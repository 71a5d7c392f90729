"""Line dedup by content-defined chunks of lines.

Each line has a hash, and each place a rolling hash over the last lines. A place ends a chunk where
its rolling hash has a given remainder, so that boundaries move along with the lines when text is
put in before them. For each remainder there is one chunking. A chunk of several lines that occurs
more than once over all documents stays where it occurs first and is removed elsewhere, once its
bytes were found equal to the first one's.

With `pairs`, chunks are all pairs of neighbouring lines instead. Every repeated passage of two or more
lines is made of repeated pairs, so all of it goes, edges included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinomart.llm.common import stored

WINDOW = 2
CHUNKINGS = 2
BASE, PRIME = 131, 2147483647


def line_chunks(lines: str, window: int = WINDOW, chunkings: int = CHUNKINGS) -> Column:
    """array<struct<first, last>>: the spans of lines of all chunkings."""
    rolling = " + ".join(
        f"if(i >= {k}, h[i - {k}], 0L) * {pow(BASE, k, PRIME)}L" for k in range(window)
    )
    spans = " , ".join(
        f"""element_at(transform(array(filter(sequence(0, size(r) - 1), i -> r[i] % {chunkings} = {k})), cuts ->
            zip_with(concat(array(-1), cuts), concat(cuts, array(size(r) - 1)),
                     (a, b) -> struct(a + 1 AS first, b AS last))), 1)"""
        for k in range(chunkings)
    )
    return F.expr(
        f"""filter(flatten(element_at(transform(array(
            transform({lines}, l -> cast(conv(substring(md5(cast(l AS binary)), 1, 8), 16, 10) AS bigint))), h ->
            element_at(transform(array(transform({lines}, (l, i) -> ({rolling}) % {PRIME})), r ->
            array({spans})), 1)), 1)), s -> s.last > s.first)"""
    )


def line_pairs(lines: str) -> Column:
    """array<struct<first, last>>: each line that is not blank up to the next one that is not."""
    return F.expr(
        f"""element_at(transform(array(filter(transform({lines}, (l, i) -> if(l rlike '\\\\S', i, -1)), i -> i >= 0)), n ->
            zip_with(slice(n, 1, greatest(size(n) - 1, 0)), slice(n, 2, greatest(size(n) - 1, 0)),
                     (a, b) -> struct(a AS first, b AS last))), 1)"""
    )


def _chunk(lines: str, span: str) -> Column:
    return F.expr(f"array_join(slice({lines}, {span}.first + 1, {span}.last - {span}.first + 1), '\\n')")


def dedup_lines(docs: DataFrame, window: int = WINDOW, chunkings: int = CHUNKINGS, pairs: bool = False) -> DataFrame:
    """The rows and columns of `docs`, text without repeated chunks, and _lines, _removed (their numbers).

    A chunk counts if at least two of its lines are not blank. With `pairs`, two neighbouring lines and the
    blank ones between them are a chunk, whatever `window` and `chunkings`; of a pair that overlaps its first
    occurrence (a line three times in a row) only the line outside of it goes. The first occurrence is that of the
    smallest doc_id (null ids last), text hash and line. Null texts stay null with no lines;
    rows repeated with one doc_id and text are one place and keep the same lines. A column of
    `docs` that is called _lines or _removed is replaced. No rows give no rows.
    """
    results = ("_lines", "_removed")
    others = [c for c in docs.columns if c != "text" and c not in results]
    rows = docs.select(
        F.struct(*[F.col(c).alias(f"c_{i}") for i, c in enumerate(others)]).alias("row"),
        F.struct(
            F.col("doc_id").isNull().alias("without"), "doc_id", F.xxhash64("text").alias("hash")
        ).alias("place"),
        "text",
        F.when(F.col("text").isNotNull(), F.split("text", "\n")).alias("lines"),
    )
    cut = rows.select("place", "lines", F.explode(line_pairs("lines") if pairs else line_chunks("lines", window, chunkings)).alias("span"))
    some = F.size(F.filter(F.expr("slice(lines, span.first + 1, span.last - span.first + 1)"), lambda x: x.rlike("\\S"))) > 1
    found = stored(
        cut.where(some).select("place", "span", F.md5(_chunk("lines", "span").cast("binary")).alias("chunk"))
    )
    repeated = stored(
        found.groupBy("chunk")
        .agg(F.min(F.struct("place", "span")).alias("origin"), F.max(F.struct("place", "span")).alias("final"))
        .where("origin != final")
        .select("chunk", "origin")
    )
    begin = F.col("span.first")
    if pairs:
        begin = F.when(F.col("place") == F.col("origin.place"), F.greatest(begin, F.col("origin.span.last") + 1)).otherwise(begin)
    spans = (
        found.join(repeated, "chunk")
        .groupBy("place")
        .agg(F.collect_set(F.struct("span", "chunk", (F.struct("place", "span") == F.col("origin")).alias("origin"), begin.alias("begin"))).alias("spans"))
    )
    marked = stored(rows.drop("lines").join(spans, "place", "left"))
    lines = F.when(F.col("text").isNotNull(), F.split("text", "\n"))
    marked = marked.withColumn("lines", lines)
    # The bytes of each removed chunk against those of the one that stays.
    bodies = marked.select("place", "lines", F.explode("spans").alias("s")).select(
        "place", F.col("s.span").alias("span"), F.col("s.chunk").alias("chunk"), F.col("s.origin").alias("origin"), _chunk("lines", "s.span").alias("body")
    )
    # Stored, so that the join below stands by itself and a chunk that fills the table is split.
    first = stored(bodies.where("origin").groupBy("chunk").agg(F.first("body").alias("kept_body")))
    unlike = stored(
        bodies.where("not origin")
        .join(first, "chunk", "left")
        .where(~F.col("body").eqNullSafe(F.col("kept_body")))
        .groupBy("place")
        .agg(F.collect_set("span").alias("unlike"))
    )
    if unlike.isEmpty():
        checked = marked.withColumn("unlike", F.expr("cast(array() AS array<struct<first: int, last: int>>)"))
    else:
        checked = marked.join(unlike, "place", "left")
    gone = F.expr(
        """array_distinct(flatten(transform(filter(coalesce(spans, array()),
           s -> NOT s.origin AND NOT coalesce(array_contains(unlike, s.span), false)),
           s -> sequence(s.begin, s.span.last))))"""
    )
    checked = checked.withColumn("gone", gone)
    left = F.expr("transform(array_except(sequence(0, size(lines) - 1), gone), i -> lines[i])")
    text = F.when(F.size("gone") > 0, F.array_join(left, "\n")).otherwise(F.col("text"))
    return checked.select(
        *[
            text.alias("text") if c == "text" else F.col(f"row.c_{others.index(c)}").alias(c)
            for c in docs.columns
            if c not in results
        ],
        F.greatest(F.coalesce(F.size("lines"), F.lit(0)), F.lit(0)).cast("long").alias("_lines"),
        F.size("gone").cast("long").alias("_removed"),
    )
