"""What the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinomart.session import materialize, work_folder

#: White space of the word and line rules: space and U+0009 to U+000D.
SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, null texts as empty; other columns, whatever their names, stay out."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def bucket(key: str, modulus: int) -> Column:
    """crc32 of a key's decimal text modulo `modulus`; a null key counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


#: Bytes of a batch of rows that goes to a Python worker.
BATCH_BYTES = 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """The same rows. Whole texts now go to Python workers in batches of a few MB, however many rows that
    is: a setting of the session, which only bounds memory."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows written to the session's shared folder and read back: cuts the lineage, survives
    lost executors."""
    return materialize(df, f"{folder or work_folder(df.sparkSession)}/rows")
