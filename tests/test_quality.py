"""Each check must find what is wrong and nothing else."""

from datetime import date, datetime
from decimal import Decimal

import fixtures as fx
import pytest

from kinomart.operators import quality as q
from kinomart.plans import checks, pipeline
from kinomart.plans.models import Models
from kinomart.session import work_folder


def tuples(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([(1, 5), (1, 5), (2, None), (None, 9), (None, -1)], "k int, v int")


def test_not_unique(numbers):
    assert tuples(q.not_unique(numbers, "k")) == [(1, 2)]
    assert tuples(q.not_unique(numbers, "k", "v")) == [(1, 5, 2)]
    assert q.not_unique(numbers.distinct(), "v").count() == 0


def test_null_rows(numbers):
    assert tuples(q.null_rows(numbers, "v")) == [(2, None)]


def test_key_failures(numbers):
    assert tuples(q.key_failures(numbers, "k")) == [(1, 2), (None, 2)]


def test_bounds_of_other_types(spark):
    df = spark.sql("SELECT DATE '2020-01-01' AS d, TIMESTAMP_NTZ '2020-01-01 10:00:00' AS t, \"it's\" AS s")
    assert q.out_of_range_rows(df, "d", date(2020, 1, 1), date(2020, 12, 31)).count() == 0
    assert q.out_of_range_rows(df, "d", date(2020, 1, 2)).count() == 1
    assert q.out_of_range_rows(df, "t", datetime(2020, 1, 1, 11)).count() == 1
    assert q.out_of_range_rows(df, "s", "it's").count() == 0


def test_singular_checks_find_failing_rows(spark):
    fact = spark.createDataFrame(
        [(1, 7, 10, -1.0, "2020-01-02", "2020-01-01"), (2, None, 11, 0.0, None, "2020-01-01")],
        "rental_id int, customer_id int, payment_id int, payment_amount double, rental_date string, return_date string",
    )
    customers = spark.createDataFrame([(8,)], "customer_id int")
    assert tuples(q.negative_payments(fact)) == [(10, 7, -1.0)]
    assert [r.rental_id for r in q.returned_before_rented(fact).collect()] == [1]
    assert sorted(r.rental_id for r in q.orphan_rentals(fact, customers).collect()) == [1, 2]
    wide = spark.createDataFrame([(1, 1.0, 2.0, 3.02), (2, 1.0, 2.0, 3.0)], "rental_id int, actual_payment double, calculated_late_fee double, total_revenue double")
    assert [r.rental_id for r in q.revenue_mismatches(wide).collect()] == [1]


def test_orphans(spark, numbers):
    parent = spark.createDataFrame([(1,)], "id int")
    assert tuples(q.orphans(numbers, "k", parent, "id")) == [(2, None)]
    other = spark.createDataFrame([(9,), (9,)], "id int")
    found = q.orphan_keys(numbers, {"k": (parent, "id"), "v": (other, "id")})
    assert tuples(found) == [("k", "2", 1), ("v", "-1", 1), ("v", "5", 2)]
    # Keys of other types are compared as they are.
    texts = spark.createDataFrame([("a", "x"), ("b", None)], "t string, u string")
    known = spark.createDataFrame([("a",)], "id string")
    assert tuples(q.orphan_keys(texts, {"t": (known, "id"), "u": (known, "id")})) == [("t", "b", 1), ("u", "x", 1)]


def test_unexpected_values(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, None)], "s string, n int")
    assert tuples(q.unexpected_values(df, {"s": ("a",)})) == [("s", "b", 2)]
    assert tuples(q.unexpected_values(df, {"s": ("a", "b"), "n": (1, 2)})) == [("n", "3", 1)]


@pytest.mark.parametrize(
    ("bounds", "expected"),
    [((0, None, True), [-1]), ((5, None, True), [-1]), ((5, None, False), [-1, 5, 5]),
     ((None, 5, True), [9]), ((0, 5, True), [-1, 9])],
)
def test_out_of_range(numbers, bounds, expected):
    assert sorted(r.v for r in q.out_of_range_rows(numbers, "v", *bounds).collect()) == expected


def test_a_range_needs_a_bound(numbers):
    with pytest.raises(ValueError):
        q.out_of_range_rows(numbers, "v")


def test_orphan_rentals_include_rentals_without_reference(spark):
    fact = spark.createDataFrame([(1, 1), (2, 7), (3, None)], "rental_id int, customer_id int")
    customers = spark.createDataFrame([(1,)], "customer_id int")
    assert tuples(q.orphan_rentals(fact, customers)) == [(2, 7), (3, None)]


def test_negative_payments(spark):
    rows = [(i, 1, v and Decimal(v)) for i, v in enumerate(["-0.01", "0.00", "1.00", None])]
    fact = spark.createDataFrame(rows, "payment_id int, customer_id int, payment_amount decimal(12,2)")
    assert [r.payment_id for r in q.negative_payments(fact).collect()] == [0]


def test_returned_before_rented(spark):
    day = [datetime(2005, 1, d) for d in (1, 2)]
    rows = [(1, day[0], day[1]), (2, day[1], day[0]), (3, day[0], day[0]), (4, day[0], None)]
    fact = spark.createDataFrame(rows, "rental_id int, rental_date timestamp_ntz, return_date timestamp_ntz")
    assert [r.rental_id for r in q.returned_before_rented(fact).collect()] == [2]


def test_revenue_mismatches(spark):
    rows = [(i, Decimal("1.00"), Decimal("2.00"), Decimal(t)) for i, t in enumerate(["3.00", "3.01", "3.02", "2.98"])]
    wide = spark.createDataFrame(
        rows, "rental_id int, actual_payment decimal(12,2), calculated_late_fee decimal(12,2),"
        " total_revenue decimal(12,2)",
    )
    found = q.revenue_mismatches(wide).collect()
    assert [r.rental_id for r in found] == [2, 3]
    assert {r.calculated_total for r in found} == {Decimal("3.00")}


def test_number_of_declared_checks():
    rows = sum(map(len, checks.NOT_NULL.values())) + sum(map(len, checks.RANGES.values()))
    rows += len(checks.UNIQUE) + len(checks.REFERENCES) + sum(map(len, checks.ACCEPTED.values()))
    singular = sum(map(len, checks.ROW_RULES.values())) + 1
    base = [n for n in checks.NOT_NULL if n in checks.PRIMARY_KEYS]
    assert (rows, singular) == (155, 4)
    assert sum(len(checks.NOT_NULL[n]) for n in base) == 71
    assert len(checks.UNIQUE) == 24 and len(checks.FOREIGN_KEYS) == 18


def test_build_and_report(spark):
    folder = work_folder(spark)
    rows = fx.base()
    models, report = pipeline.build(spark, lambda n: fx.table(spark, n, rows[n]), folder)
    found = {(r.relation, r.check): (r.failures, r.passed) for r in report.collect()}
    audits = {k for k in found if k[1].startswith(("primary_key", "foreign_key", "enum", "domain"))}
    assert len(audits) == 15 + 18 + 2 and len(found) == 159 + 35 + 2
    failing = {k: f for k, (f, ok) in found.items() if not ok and k not in audits}
    assert failing == {
        ("dim_customer", "not_null_customer_location"): 1,
        ("dim_film", "unique_film_id"): 1,
        ("dim_film", "not_null_category_name"): 1,
        ("fct_rental", "unique_rental_id"): 1,
        ("fct_rental", "not_null_film_id"): 1,
        ("fct_rental", "not_null_store_id"): 1,
        ("fct_rental", "accepted_range_rental_duration_days"): 1,
        ("fct_rental", "relationships_customer_id"): 1,
        ("fct_rental", "relationships_film_id"): 1,
        ("fct_rental", "returned_before_rented"): 1,
        ("fct_rental", "orphan_rentals"): 1,
        ("rental_analytics", "unique_rental_id"): 2,
        ("rental_analytics", "not_null_customer_name"): 2,
        ("rental_analytics", "not_null_film_title"): 2,
        ("stg_inventory", "relationships_film_id"): 1,
        ("stg_payment", "relationships_customer_id"): 1,
        ("stg_rental", "relationships_customer_id"): 1,
    }
    # The marts are stored and complete.
    assert spark.read.parquet(f"{folder}/rental_analytics").count() == models["rental_analytics"].count()
    assert spark.table("stg_rental").count() == 7


def test_constraint_audit(spark):
    rows = fx.base()
    rows["film"][0] |= {"rating": "X", "release_year": 1900}
    rows["store"].append(rows["store"][0])
    rows["rental"][1]["rental_id"] = None
    models = Models(lambda n: fx.table(spark, n, rows[n]))
    report = checks.constraints(models).collect()
    assert len(report) == 15 + 18 + 2 + 2
    failing = {(r.relation, r.check): r.failures for r in report if not r.passed}
    assert failing == {
        ("film", "enum_rating"): 1,
        ("film", "domain_release_year"): 1,
        ("store", "primary_key_store_id"): 1,
        ("store", "unique_manager_staff_id"): 1,
        ("rental", "primary_key_rental_id"): 1,
        ("payment", "foreign_key_rental_id"): 2,
        ("customer", "foreign_key_address_id"): 1,
        ("inventory", "foreign_key_film_id"): 1,
        ("rental", "foreign_key_customer_id"): 1,
        ("rental", "foreign_key_inventory_id"): 1,
        ("payment", "foreign_key_customer_id"): 1,
    }


def test_wide_keys_by_fingerprints(spark):
    rows = [("a", 1), ("a", 1), ("a", 1), ("b", 2), ("b", 3), (None, 1), (None, 1), ("c", None), ("c", None)]
    df = spark.createDataFrame(rows, "k string, n int")
    for keys in (("k",), ("k", "n"), ("n",)):
        assert sorted(map(tuple, q.not_unique_wide(df, *keys).collect())) == sorted(map(tuple, q.not_unique(df, *keys).collect()))
    assert [tuple(r) for r in q.not_unique_wide(df, "k", "n").collect()] == [("a", 1, 3)]
