"""The declared checks, and their run as one report."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinomart.operators import quality as q
from kinomart.operators.check_state import Checks
from kinomart.plans.models import Models
from kinomart.sources.schemas import (
    FOREIGN_KEYS, PRIMARY_KEYS, RATINGS, RELEASE_YEARS, UNIQUE_INDEXES, ForeignKey,
)


class Range(NamedTuple):
    column: str
    low: float | None = None
    high: float | None = None


# What is declared about each relation.
UNIQUE: dict[str, str] = {
    **{name: key[0] for name, key in PRIMARY_KEYS.items() if len(key) == 1},
    "stg_customer": "customer_id",
    "stg_film": "film_id",
    "stg_rental": "rental_id",
    "stg_payment": "payment_id",
    "stg_inventory": "inventory_id",
    "dim_customer": "customer_id",
    "dim_film": "film_id",
    "dim_store": "store_id",
    "dim_date": "date_day",
    "fct_rental": "rental_id",
    "rental_analytics": "rental_id",
}

NOT_NULL: dict[str, list[str]] = {
    name: columns.split()
    for name, columns in {
        "film": "film_id title language_id rental_duration rental_rate replacement_cost last_update",
        "actor": "actor_id first_name last_name last_update",
        "customer": "customer_id store_id first_name last_name address_id activebool create_date",
        "staff": "staff_id first_name last_name address_id store_id active username last_update",
        "store": "store_id manager_staff_id address_id last_update",
        "rental": "rental_id rental_date inventory_id customer_id staff_id last_update",
        "payment": "payment_id customer_id staff_id rental_id amount payment_date",
        "inventory": "inventory_id film_id store_id last_update",
        "category": "category_id name last_update",
        "language": "language_id name last_update",
        "address": "address_id address district city_id phone last_update",
        "city": "city_id city country_id last_update",
        "country": "country_id country last_update",
        "film_actor": "actor_id film_id last_update",
        "film_category": "film_id category_id last_update",
        "stg_customer": "customer_id email is_active",
        "stg_film": "film_id title rental_rate",
        "stg_rental": "rental_id rental_date customer_id inventory_id",
        "stg_payment": "payment_id amount customer_id",
        "stg_inventory": "inventory_id film_id",
        "dim_customer": "customer_id full_name email customer_location",
        "dim_film": "film_id title category_name film_length_category rental_rate_category",
        "dim_store": "store_id store_location",
        "dim_date": "date_day year month quarter",
        "fct_rental": "rental_id customer_id film_id store_id",
        "rental_analytics": "rental_id customer_name film_title return_status total_revenue"
        " rental_year rental_quarter",
    }.items()
}

RANGES: dict[str, list[Range]] = {
    "stg_film": [Range("rental_rate", 0)],
    "stg_payment": [Range("amount", 0)],
    "dim_date": [Range("month", 1, 12), Range("quarter", 1, 4)],
    "fct_rental": [
        Range("payment_amount", 0), Range("rental_duration_days", 0), Range("days_overdue", 0),
    ],
    "rental_analytics": [Range("total_revenue", 0), Range("rental_quarter", 1, 4)],
}

ACCEPTED: dict[str, dict[str, tuple[str, ...]]] = {
    "dim_film": {
        "film_length_category": ("Short", "Medium", "Long"),
        "rental_rate_category": ("Budget", "Standard", "Premium", "Luxury"),
    },
    "rental_analytics": {
        "return_status": ("Not Returned", "Late Return", "On Time"),
        "payment_status": ("Overpaid", "Underpaid", "Exact", "No Payment"),
    },
}

REFERENCES = [
    ForeignKey("stg_rental", "customer_id", "stg_customer", "customer_id"),
    ForeignKey("stg_payment", "customer_id", "stg_customer", "customer_id"),
    ForeignKey("stg_inventory", "film_id", "stg_film", "film_id"),
    ForeignKey("fct_rental", "customer_id", "dim_customer", "customer_id"),
    ForeignKey("fct_rental", "film_id", "dim_film", "film_id"),
    ForeignKey("fct_rental", "store_id", "dim_store", "store_id"),
]

# Row conditions that must not hold, by relation and check name.
ROW_RULES: dict[str, dict[str, str]] = {
    "fct_rental": {
        "negative_payments": q.NEGATIVE_PAYMENT,
        "returned_before_rented": q.RETURNED_BEFORE_RENTED,
    },
    "rental_analytics": {"revenue_mismatches": q.REVENUE_DIFFERS},
}


def _row_conditions(relation: str) -> dict[str, str]:
    """Checks of one relation that look at one row at a time: name -> failing condition."""
    tests = {f"not_null_{c}": f"`{c}` IS NULL" for c in NOT_NULL.get(relation, [])}
    for r in RANGES.get(relation, []):
        tests[f"accepted_range_{r.column}"] = q.out_of_range(r.column, r.low, r.high)
    return tests | ROW_RULES.get(relation, {})


def _count_rows(df: DataFrame, relation: str, tests: dict[str, str]) -> DataFrame:
    """All row checks of a relation in one scan; one result row per check."""
    counted = df.agg(*[F.expr(f"count_if({t}) AS `{name}`") for name, t in tests.items()])
    return _as_rows(counted, relation, tests)


def _as_rows(counted: DataFrame, relation: str, names: Iterable[str]) -> DataFrame:
    pairs = ", ".join(f"struct('{n}' AS check, `{n}` AS failures)" for n in names)
    return counted.selectExpr(f"'{relation}' AS relation", f"inline(array({pairs}))")


def _count(df: DataFrame, relations: str | list[str], check: str) -> DataFrame:
    names = [relations] if isinstance(relations, str) else relations
    return df.agg(F.count("*").alias("failures")).select(
        F.explode(F.array(*map(F.lit, names))).alias("relation"), F.lit(check).alias("check"), "failures"
    )


def _count_columns(
    found: DataFrame, relation: str, kind: str, columns: Iterable[str], amount: Column
) -> DataFrame:
    """Failures per checked column; a column without any counts 0."""
    tests = {f"{kind}_{c}": F.when(F.col("column") == c, amount) for c in columns}
    counted = found.agg(*[F.coalesce(F.sum(t), F.lit(0)).alias(name) for name, t in tests.items()])
    return _as_rows(counted, relation, tests)


def _references(models: Models, references: Iterable[ForeignKey], kind: str) -> list[DataFrame]:
    """Rows with a missing parent, per reference."""
    children: dict[str, dict[str, tuple[DataFrame, str]]] = {}
    for r in references:
        children.setdefault(r.child, {})[r.column] = (models[r.parent], r.parent_column)
    return [
        _count_columns(
            q.orphan_keys(models[child], parents), child, kind, parents, F.col("n_records")
        )
        for child, parents in children.items()
    ]


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    """Union in pairs of pairs: a chain of unions would be analyzed anew at every link."""
    parts = list(parts)
    if len(parts) == 1:
        return parts[0]
    middle = len(parts) // 2
    return _union(parts[:middle]).union(_union(parts[middle:]))


def _report(parts: Iterable[DataFrame]) -> DataFrame:
    return _union(parts).select(
        "relation", "check", "failures", (F.col("failures") == 0).alias("passed")
    )


def summary(models: Models) -> DataFrame:
    """Run every declared check: one row each with the number of failing rows or values."""
    parts = [_count_rows(models[r], r, _row_conditions(r)) for r in NOT_NULL]
    # A staging view has its base table's key: one count serves both.
    for r, c in UNIQUE.items():
        if r.startswith("stg_") and UNIQUE.get(r[4:]) == c:
            continue
        names = [r] + [s for s in (f"stg_{r}",) if UNIQUE.get(s) == c]
        parts.append(_count(q.not_unique(models[r], c), names, f"unique_{c}"))
    parts += _references(models, REFERENCES, "relationships")
    parts += [
        _count_columns(q.unexpected_values(models[r], c), r, "accepted_values", c, F.lit(1))
        for r, c in ACCEPTED.items()
    ]
    parts.append(
        _count(
            q.orphan_rentals(models["fct_rental"], models["dim_customer"]),
            "fct_rental", "orphan_rentals",
        )
    )
    return _report(parts)


def of_relation(models: Models, relation: str) -> Checks:
    """The declared checks of one relation, for states that are kept and merged."""
    references = {r.column: (models[r.parent], r.parent_column) for r in REFERENCES if r.child == relation}
    unique = [(UNIQUE[relation],)] if relation in UNIQUE else []
    return Checks(_row_conditions(relation), ACCEPTED.get(relation, {}), references, unique)


def primary_keys(models: Models) -> DataFrame:
    return _report(
        _count(q.key_failures(models[r], *key), r, f"primary_key_{'_'.join(key)}")
        for r, key in PRIMARY_KEYS.items()
    )


def foreign_keys(models: Models) -> DataFrame:
    return _report(_references(models, FOREIGN_KEYS, "foreign_key"))


def unique_indexes(models: Models) -> DataFrame:
    return _report(
        _count(q.not_unique(models[r], *key), r, f"unique_{'_'.join(key)}")
        for r, key in UNIQUE_INDEXES.items()
    )


def rating_enum(models: Models) -> DataFrame:
    """Ratings outside the enumerated type."""
    return q.unexpected_values(models["film"], {"rating": RATINGS})


def release_year_domain(models: Models) -> DataFrame:
    """Films whose year is outside the domain."""
    return q.out_of_range_rows(models["film"], "release_year", *RELEASE_YEARS).select(
        "film_id", "release_year"
    )


def everything(models: Models) -> DataFrame:
    """The declared checks and the base tables' constraints."""
    return _union([summary(models), constraints(models)])


def constraints(models: Models) -> DataFrame:
    """Audit of the base tables' keys, references, unique indexes, enum and domain."""
    value_types = [
        _count(rating_enum(models), "film", "enum_rating"),
        _count(release_year_domain(models), "film", "domain_release_year"),
    ]
    return _union(
        [primary_keys(models), foreign_keys(models), unique_indexes(models), _report(value_types)]
    )
