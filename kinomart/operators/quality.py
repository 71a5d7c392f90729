"""Data checks. Each returns the failing rows, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def any_null(columns: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


Bound = float | date | str


def _literal(bound: Bound) -> str:
    if isinstance(bound, datetime):
        return f"TIMESTAMP_NTZ '{bound}'"
    if isinstance(bound, date):
        return f"DATE '{bound}'"
    return "'" + bound.replace("'", "\\'") + "'" if isinstance(bound, str) else str(bound)


def out_of_range(
    column: str, low: Bound | None = None, high: Bound | None = None, inclusive: bool = True
) -> str:
    """Condition that is true outside the bounds, and NULL for a NULL value."""
    below, above = ("<", ">") if inclusive else ("<=", ">=")
    tests = [f"`{column}` {below} {_literal(low)}"] if low is not None else []
    tests += [f"`{column}` {above} {_literal(high)}"] if high is not None else []
    if not tests:
        raise ValueError("a range needs at least one bound")
    return " OR ".join(tests)


def not_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Keys that occur more than once. A key with a NULL part never repeats."""
    return (
        df.where(~any_null(columns))
        .groupBy(*columns)
        .agg(F.count("*").alias("n_records"))
        .where("n_records > 1")
    )


def not_unique_wide(df: DataFrame, *columns: str) -> DataFrame:
    """`not_unique` for wide keys: fingerprints of 8 bytes are counted first, and only keys whose
    fingerprint occurs twice are shuffled. The table is scanned twice; where few keys repeat, the
    second scan sends almost nothing. Exact: keys that share a fingerprint are counted apart."""
    known = df.where(~any_null(columns)).select(*columns, F.xxhash64(*columns).alias("_print"))
    twice = known.groupBy("_print").agg(F.count("*").alias("_n")).where("_n > 1").select("_print")
    return (
        known.join(twice, "_print", "left_semi")
        .groupBy(*columns)
        .agg(F.count("*").alias("n_records"))
        .where("n_records > 1")
    )


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose reference has no parent row; no reference is no failure."""
    # Parents are keyed uniquely; skew on the child's side is split by adaptive execution.
    keys = parent.select(F.col(parent_column).alias("_key"))
    return child.where(F.col(column).isNotNull()).join(
        keys, F.col(column) == F.col("_key"), "left_anti"
    )


def orphan_keys(
    child: DataFrame, references: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Missing keys of all references of a child: (column, value, n_records).

    ``references`` maps a child column to its parent and the parent's key. Integers are compared
    as such, other keys by their text; ``value`` is the key's text. The child is read once for all of its references, and rows are counted per key before
    anything is shuffled, so a key that fills the child costs no more than any other.
    """
    columns = list(references)
    kinds = [dict(child.dtypes)[c] for c in columns]
    kinds += [dict(parent.dtypes)[key] for parent, key in references.values()]
    kind = "bigint" if set(kinds) <= {"tinyint", "smallint", "int", "bigint"} else "string"

    def keyed(position: int, key: str) -> Column:
        return F.struct(
            F.lit(position).alias("position"), F.col(key).cast(kind).alias("value")
        )

    found = F.array(*[keyed(i, c) for i, c in enumerate(columns)])
    counts = (
        child.select(F.inline(found))
        .where(F.col("value").isNotNull())
        .groupBy("position", "value")
        .agg(F.count("*").alias("n_records"))
    )
    parents = reduce(
        DataFrame.union,
        [
            parent.select(F.inline(F.array(keyed(i, key))))
            for i, (parent, key) in enumerate(references.values())
        ],
    )
    names = F.array(*[F.lit(c) for c in columns])
    return counts.join(parents, ["position", "value"], "left_anti").select(
        F.get(names, F.col("position")).alias("column"), F.col("value").cast("string").alias("value"), "n_records"
    )


def unexpected_values(df: DataFrame, accepted: Mapping[str, Sequence[str]]) -> DataFrame:
    """Values outside the lists of one or more columns: (column, value, n_records).

    NULL passes. One scan serves all columns, and only failing values leave it.
    """
    failing = F.array(
        *[
            F.when(
                ~F.col(c).isin(*values),
                F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")),
            )
            for c, values in accepted.items()
        ]
    )
    return (
        df.select(F.inline(F.array_compact(failing)))
        .groupBy("column", "value")
        .agg(F.count("*").alias("n_records"))
    )


def out_of_range_rows(
    df: DataFrame, column: str, low: Bound | None = None, high: Bound | None = None,
    inclusive: bool = True,
) -> DataFrame:
    return df.where(out_of_range(column, low, high, inclusive))


def key_failures(df: DataFrame, *columns: str) -> DataFrame:
    """Primary key failures in one pass: keys that repeat or hold a NULL."""
    return (
        df.groupBy(*columns)
        .agg(F.count("*").alias("n_records"))
        .where((F.col("n_records") > 1) | any_null(columns))
    )


def orphan_rentals(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Rentals without a customer, those without any reference included."""
    return fact.join(customers.select("customer_id"), "customer_id", "left_anti").select(
        "rental_id", "customer_id"
    )


# The stated intent of this check also names zero amounts, its predicate does not;
# the predicate counts.
NEGATIVE_PAYMENT = "payment_amount < 0"
RETURNED_BEFORE_RENTED = "return_date < rental_date"
REVENUE_DIFFERS = "abs(total_revenue - (actual_payment + calculated_late_fee)) > 0.01"


def negative_payments(fact: DataFrame) -> DataFrame:
    return fact.where(NEGATIVE_PAYMENT).select("payment_id", "customer_id", "payment_amount")


def returned_before_rented(fact: DataFrame) -> DataFrame:
    return fact.where(RETURNED_BEFORE_RENTED).select("rental_id", "rental_date", "return_date")


def revenue_mismatches(analytics: DataFrame) -> DataFrame:
    return analytics.where(REVENUE_DIFFERS).select(
        "rental_id",
        "actual_payment",
        "calculated_late_fee",
        "total_revenue",
        (F.col("actual_payment") + F.col("calculated_late_fee")).alias("calculated_total"),
    )
