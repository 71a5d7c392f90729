"""Exact dedup by composable polynomial fingerprints.

A text is cut into byte chunks that are hashed in parallel. The polynomial hash of a whole text is
the sum of its chunks' hashes, each shifted by the number of bytes behind it, so a plain SUM puts
the fingerprint of a huge document together and no task needs to hash it as a whole. Texts of equal
length and fingerprint are compared chunk by chunk with the first of them; texts that differ in
spite of equal fingerprints are grouped anew among themselves until no difference is left.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinomart.llm.common import SPACE, stored, texts

#: (prime below 2^31, base) of the two independent fingerprints.
POLYNOMIALS = ((2147483647, 1103515245), (2147483629, 1812433253))
CHUNK = 1 << 20
KEY = ["n_bytes", "fp_0", "fp_1", "variant"]


def powers(prime: int, base: int, count: int) -> np.ndarray:
    """base^0 ... base^(count-1) modulo prime, by doubling."""
    out = np.ones(1, np.int64)
    while len(out) < count:
        out = np.concatenate([out, out * pow(base, len(out), prime) % prime])
    return out[:count]


def chunk_hash(chunk: bytes, table: np.ndarray, prime: int) -> int:
    """The polynomial hash of at most 2^20 bytes; sums of byte times power stay below 2^59."""
    data = np.frombuffer(chunk, np.uint8).astype(np.int64)
    return int(np.dot(data, table[: len(data)][::-1])) % prime


def _hash_chunks(polynomials: Sequence[tuple[int, int]], chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [powers(p, b, chunk) for p, b in polynomials]
        for batch in batches:
            names = batch.schema.names
            pieces = batch.column("chunk")
            behind = batch.column("behind").to_pylist()
            columns = [batch.column(n) for n in names if n not in ("chunk", "behind")]
            for (prime, base), table in zip(polynomials, tables, strict=True):
                part = [
                    chunk_hash(piece.as_py(), table, prime) * pow(base, n, prime) % prime
                    for piece, n in zip(pieces, behind, strict=True)
                ]
                columns.append(pa.array(part, pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_sha256", "n_bytes", "n_chunks", "part_0", "part_1"])

    return run


def chunks(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """doc_id, text_sha256, n_bytes, n_chunks, pos, behind, chunk: one row per chunk of a text with
    its white space normalised, at least one."""
    flat = texts(docs).select("doc_id", F.regexp_replace("text", SPACE, " ").cast("binary").alias("data"))
    size = F.octet_length("data").cast("long")
    count = F.greatest(F.ceil(size / chunk), F.lit(1)).cast("long")
    rows = flat.select(
        "doc_id", "data", F.sha2("data", 256).alias("text_sha256"), size.alias("n_bytes"), count.alias("n_chunks")
    )
    cut = F.expr(
        f"""transform(sequence(0L, n_chunks - 1), i -> struct(
            i AS pos, substring(data, cast(i * {chunk} + 1 as int), {chunk}) AS chunk))"""
    )
    # The pieces are exploded, not the whole text repeated for each of them.
    pieces = rows.select("doc_id", "text_sha256", "n_bytes", "n_chunks", F.explode(cut).alias("piece"))
    behind = F.greatest(F.col("n_bytes") - (F.col("piece.pos") + 1) * chunk, F.lit(0))
    return pieces.select(
        "doc_id", "text_sha256", "n_bytes", "n_chunks", "piece.pos", behind.alias("behind"), "piece.chunk"
    )


def fingerprints(
    docs: DataFrame, polynomials: Sequence[tuple[int, int]] = POLYNOMIALS, chunk: int = CHUNK
) -> DataFrame:
    """doc_id, text_sha256, n_bytes, fp_0, fp_1, copies: one row per document; copies counts rows
    of one doc_id and text."""
    schema = "doc_id bigint, text_sha256 string, n_bytes bigint, n_chunks bigint, part_0 bigint, part_1 bigint"
    parts = chunks(docs, chunk).drop("pos").mapInArrow(_hash_chunks(polynomials, chunk), schema)
    copies = F.expr("count(*) div n_chunks")
    # Repeated rows add the same parts again, so that the sums divide by their number.
    return parts.groupBy("doc_id", "text_sha256", "n_bytes", "n_chunks").agg(
        copies.alias("copies"),
        *[
            F.expr(f"(sum(part_{i}) div (count(*) div n_chunks)) % {prime}").alias(f"fp_{i}")
            for i, (prime, _) in enumerate(polynomials)
        ],
    )


def _different(docs: DataFrame, members: DataFrame, chunk: int) -> DataFrame:
    """The members (doc_id, text_sha256, keep_id, keep_sha) with a chunk unlike that of the document
    that would stay. Each chunk meets its counterpart only; adaptive execution splits a hot one."""
    first = members.select(
        F.col("keep_id").alias("doc_id"), F.col("keep_sha").alias("text_sha256"), "keep_id", "keep_sha"
    ).distinct()
    wanted = members.withColumn("is_first", F.lit(False)).unionByName(first.withColumn("is_first", F.lit(True)))
    same = F.col("p.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("p.text_sha256") == F.col("w.text_sha256"))
    pieces = stored(
        chunks(docs, chunk)
        .alias("p")
        .join(wanted.alias("w"), same)
        .select("p.doc_id", "p.text_sha256", "pos", "chunk", "keep_id", "keep_sha", "is_first")
    )
    kept = (
        pieces.where("is_first")
        .groupBy("keep_id", "keep_sha", "pos")
        .agg(F.first("chunk").alias("kept_chunk"))
        .alias("k")
    )
    place = (
        F.col("m.keep_id").eqNullSafe(F.col("k.keep_id"))
        & (F.col("m.keep_sha") == F.col("k.keep_sha"))
        & (F.col("m.pos") == F.col("k.pos"))
    )
    pairs = pieces.where("not is_first").alias("m").join(kept, place, "left")
    unlike = pairs.where(~F.col("chunk").eqNullSafe(F.col("kept_chunk")))
    return unlike.select("m.doc_id", "m.text_sha256").distinct()


def exact_duplicates(
    docs: DataFrame, polynomials: Sequence[tuple[int, int]] = POLYNOMIALS, chunk: int = CHUNK
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of `docs` (doc_id bigint, text).

    Texts are equal when identical after each run of white space became one space; null counts as
    empty. Of equal texts the smallest doc_id stays, null ids last. Rows repeated with the same
    doc_id and text each count in group_size and are each reported, with the same answer; a doc_id
    with several texts is judged text by text. No rows give no rows.
    """
    marks = stored(fingerprints(docs, polynomials, chunk).withColumn("variant", F.lit(0)))
    while True:
        groups = marks.groupBy(*KEY).agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_sha256")).alias("first"),
            F.sum("copies").alias("group_size"),
            F.count("*").alias("n_members"),
        )
        groups = groups.select(
            *KEY,
            F.col("first.doc_id").alias("keep_id"),
            F.col("first.text_sha256").alias("keep_sha"),
            "group_size",
            "n_members",
        )
        # Stored, so that the join below stands by itself and a group that fills the table is split.
        placed = marks.join(stored(groups), KEY)
        others = stored(
            placed.where("n_members > 1 and not (doc_id <=> keep_id and text_sha256 = keep_sha)").select(
                "doc_id", "text_sha256", "keep_id", "keep_sha"
            )
        )
        if others.isEmpty():
            break
        differ = stored(_different(docs, others, chunk))
        if differ.isEmpty():
            break
        # Rare: other texts of equal length and fingerprints. They form groups of their own.
        apart = differ.withColumn("apart", F.lit(1))
        marks = stored(
            marks.alias("m")
            .join(
                apart.alias("a"),
                F.col("m.doc_id").eqNullSafe(F.col("a.doc_id"))
                & (F.col("m.text_sha256") == F.col("a.text_sha256")),
                "left",
            )
            .select(
                *[f"m.{c}" for c in marks.columns if c != "variant"],
                (F.col("variant") + F.coalesce("apart", F.lit(0))).alias("variant"),
            )
        )
    return placed.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"),
    ).drop("_copy")
