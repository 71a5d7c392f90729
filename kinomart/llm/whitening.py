"""Embedding whitening by polarisation: covariances from the variances of single and summed dimensions.

With whole numbers x, the sum of squares of x_i + x_j around its mean, less those of x_i and of x_j, is
twice the cross-product sum of i and j. All sums are exact integers: tasks add squares of values taken
around the rounded mean, Spark adds the tasks' sums as decimals, and the remainder of the mean is put
right in the end. What reaches the driver is one number for each pair of dimensions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinomart.llm.common import stored
from kinomart.llm.vectors import finite, matrix, width

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Entries of this size and more count as not finite: their x would not fit into a long.
LIMIT = 2.0**52
LONG = 2**63
TOTAL = pa.decimal128(38, 0)
Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class Basis:
    """n vectors, their sums by dimension, and the covariance's eigenvalues with their unit vectors
    (columns), the largest first; share is each eigenvalue's part of the whole variance."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    share: np.ndarray


def whole_numbers(values: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * values).astype(np.int64) + SHIFT


def _exact(numbers: np.ndarray, bound: int) -> np.ndarray:
    """The same numbers, as Python's if results up to `bound` would not fit into a long."""
    return numbers if bound < LONG else numbers.astype(object)


def _sums(columns: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        n, total = 0, [0] * columns
        for batch in batches:
            x = whole_numbers(matrix(batch.column(0), columns))
            if len(x):
                x = _exact(x, int(np.abs(x).max()) * len(x))
                n, total = n + len(x), [a + int(b) for a, b in zip(total, x.sum(axis=0), strict=True)]
        rows = [pa.array(range(columns), pa.int32()), pa.array([n] * columns, pa.int64()), pa.array(total, TOTAL)]
        yield pa.RecordBatch.from_arrays(rows, names=["i", "n", "total"])

    return run


def _squares(columns: int, middle: Sequence[int]) -> Callable[[Batches], Batches]:
    """Sums of (x_i - m_i)^2, and of (x_i - m_i + x_j - m_j)^2 for i < j, m being the rounded means."""

    def run(batches: Batches) -> Batches:
        at = [(i, j) for i in range(columns) for j in range(i, columns)]
        total = np.zeros(len(at), object)
        for batch in batches:
            x = whole_numbers(matrix(batch.column(0), columns))
            if not len(x):
                continue
            x = x - np.array(middle, np.int64)
            x = _exact(x, (2 * int(np.abs(x).max())) ** 2 * len(x))
            done = 0
            for i in range(columns):
                single, pair = x[:, i], x[:, i, None] + x[:, i + 1 :]
                total[done] += int((single * single).sum())
                total[done + 1 : done + columns - i] += (pair * pair).sum(axis=0).astype(object)
                done += columns - i
        rows = [pa.array([p[k] for p in at], pa.int32()) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([*rows, pa.array([int(t) for t in total], TOTAL)], names=["i", "j", "total"])

    return run


def fit(vectors: DataFrame, column: str, columns: int) -> Basis | None:
    """The basis of all vectors; None without any."""
    numbers = vectors.select(column)
    added = numbers.mapInArrow(_sums(columns), "i int, n bigint, total decimal(38,0)")
    sums = added.groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("i").collect()
    n = sums[0]["n"] if sums else 0
    if not n:
        return None
    total = [int(r["total"]) for r in sums]
    middle = [t // n for t in total]
    rest = [t - n * m for t, m in zip(total, middle, strict=True)]
    squared = numbers.mapInArrow(_squares(columns, middle), "i int, j int, total decimal(38,0)")
    squares = {(r["i"], r["j"]): int(r["total"]) for r in squared.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}
    # n^2 times the variances, then n^2 times twice the covariances.
    single = [n * squares[i, i] - rest[i] ** 2 for i in range(columns)]
    cov = np.empty((columns, columns))
    for (i, j), square in squares.items():
        twice = 2 * single[i] if i == j else n * square - (rest[i] + rest[j]) ** 2 - single[i] - single[j]
        cov[i, j] = cov[j, i] = twice / (2 * n * n)  # whole numbers: rounded once
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(columns)] < 0, -1.0, 1.0)
    trace = sum(single) / (n * n)
    share = values / trace if trace > 0 else np.full(columns, np.nan)
    return Basis(n, tuple(total), values, axes, share)


def _project(basis: Basis, columns: int, components: int) -> Callable[[Batches], Batches]:
    middle = [t // basis.n for t in basis.sums]
    rest = [t - basis.n * m for t, m in zip(basis.sums, middle, strict=True)]
    used = usable(basis, components)
    axes = basis.vectors[:, :used] / np.sqrt(basis.values[:used])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            x = whole_numbers(matrix(batch.column("_vector"), columns)) - np.array(middle, np.int64)
            most = int(np.abs(x).max()) + 1 if len(x) else 0
            d = _exact(x, basis.n * most) * basis.n - np.array(rest, np.int64 if basis.n * most < LONG else object)
            d = _exact(d, columns * (basis.n * most) ** 2)
            deviation = [int(v) for v in (d * d).sum(axis=1)]
            white = (d / basis.n).astype(np.float64) @ axes
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * used, pa.array(white.ravel(), pa.float64()))
            answers = [pa.array([v if v < LONG else None for v in deviation], pa.int64()), lists]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), *answers], names=["_key", "deviation", "white"])

    return run


def usable(basis: Basis, components: int) -> int:
    """How many of the first components have a variance above rounding."""
    least = len(basis.values) * np.finfo(float).eps * max(float(basis.values[0]), 0.0)
    return int((basis.values[:components] > least).sum())


def whiten(
    rows: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS
) -> tuple[DataFrame, Basis | None]:
    """key, deviation, white: for each counted row its squared distance from the mean, times n^2 and exact,
    and its first `components` coordinates of variance 1; and the basis.

    Rows count if their vector is there, holds only numbers (none null, infinite or beyond 2^52), and
    is as long as most are. A deviation that does not fit into a long is null. Components without
    variance, as all are for one row or equal rows, have no coordinate: `white` is shorter then.
    Repeated rows count as often as they occur; null keys are carried along; other columns stay out.
    No rows give no rows and no basis.
    """
    counted = rows.where(finite(column, LIMIT)).select(F.col(key).alias("_key"), F.col(column).alias("_vector"))
    columns = width(counted, "_vector")
    counted = counted.where(F.size("_vector") == columns)
    basis = fit(counted, "_vector", columns) if columns else None
    kind = dict(rows.dtypes)[key]
    if basis is None:
        empty = counted.where("false").selectExpr("_key", "0L AS deviation", "array(0D) AS white")
        return empty.withColumnRenamed("_key", key), None
    made = counted.mapInArrow(_project(basis, columns, components), f"_key {kind}, deviation bigint, white array<double>")
    return made.withColumnRenamed("_key", key), basis


def identity_error(white: DataFrame, used: int) -> float | None:
    """How far the covariance of the coordinates is from the identity: its largest absolute entry."""
    if not used:
        return None
    pairs = [(i, j) for i in range(used) for j in range(i, used)]
    found = white.agg(*[F.covar_pop(F.col("white")[i], F.col("white")[j]).alias(f"c{k}") for k, (i, j) in enumerate(pairs)]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs, strict=True))


def whitened_components(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each counted row
    of `rows` (vec_id, embedding) and each component up to `components`, or the vectors' length.

    A component without variance is listed with a null coordinate; explained is null if nothing varies.
    """
    white, basis = whiten(rows, components=components)
    if basis is None:
        return white.selectExpr(
            "vec_id", "0 AS component", "0L AS n", "deviation", "0D AS whitened", "0D AS explained", "0D AS identity_error"
        )
    white = stored(white)
    error = identity_error(white, usable(basis, components))
    shares = [None if np.isnan(s) else float(s) for s in basis.share[:components]]
    each = [
        F.struct(
            F.lit(k + 1).alias("component"),
            F.get("white", F.lit(k)).alias("whitened"),
            F.lit(share).cast("double").alias("explained"),
        )
        for k, share in enumerate(shares)
    ]
    return white.select("vec_id", "deviation", F.explode(F.array(*each)).alias("c")).select(
        "vec_id", "c.component", F.lit(basis.n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained",
        F.lit(error).cast("double").alias("identity_error"),
    )
