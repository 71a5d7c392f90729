"""Tables of embeddings: which rows count, and their numbers as matrices in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(column: str, limit: float) -> Column:
    """Whether a vector is there and all its entries are numbers below `limit` in size."""
    return F.coalesce(F.forall(column, lambda x: F.coalesce(F.abs(x.cast("double")) < limit, F.lit(False))), F.lit(False))


def width(vectors: DataFrame, column: str) -> int:
    """The most frequent length, the greater one of equally frequent ones; 0 without vectors."""
    sizes = vectors.groupBy(F.size(column).alias("size")).count().where("size > 0")
    first = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return first["size"] if first else 0


def matrix(column: pa.Array, columns: int) -> np.ndarray:
    """A column of lists of one length as doubles, a row for each list."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(-1, columns)
