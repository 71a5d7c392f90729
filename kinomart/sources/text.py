"""Reader for the database's tab-separated dump format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinomart.sources.schemas import PADDED, SCHEMAS

NULL_MARK = r"\N"
END_MARK = r"\."


def unescape(raw: Column) -> Column:
    """Undo backslash escapes. A dump never holds octal or hex escapes, so none are read."""

    def piece(text: Column) -> Column:
        for letter, char in {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f", "v": "\v"}.items():
            text = F.replace(text, F.lit("\\" + letter), F.lit(char))
        return F.regexp_replace(text, r"\\(.)", "$1")

    # Escaped backslashes separate the pieces, so none of them can start another escape.
    plain = F.array_join(F.transform(F.split(raw, r"\\\\"), piece), "\\")
    return F.when(raw.contains("\\"), plain).otherwise(raw)


def array_literal(text: Column) -> Column:
    """``{a,"b c",NULL}`` to an array of strings."""
    body = F.substring(text, F.lit(2), F.length(text) - 2)
    items = F.regexp_extract_all(body, F.lit(r'("(?:[^"\\]|\\.)*"|[^,]+)'), F.lit(1))

    def item(value: Column) -> Column:
        quoted = value.startswith('"')
        inner = F.regexp_replace(
            F.substring(value, F.lit(2), F.length(value) - 2), r"\\(.)", "$1"
        )
        return F.when(quoted, inner).when(F.upper(value) != "NULL", value)

    return F.transform(items, item)


def decode(raw: Column, dtype: T.DataType, padded: bool = False) -> Column:
    """One field of the dump as its column type; bad input raises under ANSI mode."""
    text = F.when(raw != NULL_MARK, unescape(raw))
    if isinstance(dtype, T.ArrayType):
        return array_literal(text)
    if isinstance(dtype, T.BinaryType):
        return F.unhex(F.substring(text, F.lit(3), F.length(text)))
    if padded:
        text = F.rtrim(text)
    return text.cast(dtype)


def read_dump(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Load one base table from its dump file or folder."""
    schema = SCHEMAS[table]
    lines = spark.read.text(path).where(~F.col("value").isin("", END_MARK))
    fields = F.split("value", "\t", -1)
    wrong = F.raise_error(
        F.concat(F.lit(f"{table}: expected {len(schema)} fields, got: "), F.col("value"))
    ).cast("array<string>")
    rows = lines.select(F.when(F.size(fields) == len(schema), fields).otherwise(wrong).alias("f"))
    return rows.select(
        *[
            decode(F.col("f")[i], field.dataType, field.name in PADDED.get(table, ())).alias(field.name)
            for i, field in enumerate(schema)
        ]
    )
