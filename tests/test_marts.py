"""Grain and NULL rules of the star schema."""

from datetime import date
from decimal import Decimal

import fixtures as fx
import pytest
from fixtures import at, by
from pyspark.sql import functions as F

from kinomart.plans.marts import dim_film, fct_rental, rental_analytics, rental_analytics_of_rentals
from kinomart.plans.models import MARTS


@pytest.fixture(scope="module")
def models(spark):
    return fx.models(spark)


@pytest.fixture(scope="module")
def fact(models):
    return by(models["fct_rental"], "rental_id")


@pytest.fixture(scope="module")
def wide(models):
    return by(models["rental_analytics"], "rental_id")


def test_column_counts(models):
    counts = {name: len(models[name].columns) for name in MARTS}
    assert counts == {
        "dim_customer": 17, "dim_film": 14, "dim_store": 11, "dim_date": 16, "fct_rental": 24,
        "rental_analytics": 55,
    }


def test_grain_is_rental_and_payment(fact):
    assert sorted(r.payment_id for r in fact[2]) == [2, 3]
    # 5 days out, 3 allowed: the fee stands on both rows.
    assert [r.calculated_late_fee for r in fact[2]] == [Decimal("2.00")] * 2
    assert len(fact[3]) == 1 and fact[3][0].payment_id is None


def test_whole_days(spark, fact):
    assert fact[1][0].rental_duration_days == 1
    assert fact[6][0].rental_duration_days == -2
    back = [fx.rental(1, 1, 1, "2005-05-24 22:00:00", "2005-05-23 01:00:00")]
    stg = fx.models(spark, rental=back)["stg_rental"]
    assert [r.rental_duration_days for r in stg.collect()] == [-1]


def test_whole_days_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = [fx.rental(1, 1, 1, "2005-04-02 12:00:00", "2005-04-03 12:00:00")]
        stg = fx.models(spark, rental=rows)["stg_rental"]
        assert [r.rental_duration_days for r in stg.collect()] == [1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_missing_payment(fact):
    row = fact[3][0]
    assert row.payment_amount is None
    assert row.actual_payment == Decimal("0.00")
    assert row.payment_variance == Decimal("-0.99")
    assert row.is_not_returned and not row.is_late_return


def test_unknown_film(fact, wide):
    row = fact[5][0]  # item known, film not
    assert (row.film_id, row.store_id, row.expected_amount) == (99, 1, None)
    assert row.payment_variance is None and row.actual_payment == Decimal("1.00")
    assert (row.is_late_return, row.days_overdue, row.calculated_late_fee) == (False, 0, 0)
    assert wide[5][0].payment_status == "No Payment"
    assert wide[5][0].is_profitable_rental is False
    assert wide[5][0].film_id is None


def test_unknown_item(fact, wide):
    row = fact[7][0]
    assert (row.film_id, row.store_id, row.inventory_id) == (None, None, 77)
    assert wide[7][0].store_id is None and wide[7][0].payment_amount == Decimal("1.00")


def test_types(models):
    types = dict(models["fct_rental"].dtypes)
    assert types["rental_duration_days"] == types["days_overdue"] == "bigint"
    money = ("payment_amount", "expected_amount", "actual_payment", "payment_variance",
             "calculated_late_fee")
    assert {types[m] for m in money} == {"decimal(12,2)"}
    assert dict(models["rental_analytics"].dtypes)["total_revenue"] == "decimal(12,2)"


@pytest.mark.parametrize("hot_rows", [1, 2, 1000])
def test_splitting_hot_rentals_changes_nothing(models, hot_rows):
    parts = [models[n] for n in ("stg_rental", "stg_payment", "stg_inventory", "stg_film")]
    split = fct_rental(*parts, hot_rows=hot_rows).collect()
    assert sorted(map(str, split)) == sorted(map(str, models["fct_rental"].collect()))


def test_payment_status(wide):
    status = {r.payment_id: r.payment_status for rows in wide.values() for r in rows}
    # Item 1 costs 0.99, item 2 2.99.
    assert status[1] == "Exact" and status[2] == "Exact" and status[3] == "Overpaid"
    assert status[6] == "Underpaid" and status[None] == "No Payment"


def test_profit(wide):
    assert wide[1][0].is_profitable_rental is True
    assert wide[3][0].is_profitable_rental is False


def test_return_status(wide):
    assert wide[2][0].return_status == "Late Return"
    assert wide[3][0].return_status == "Not Returned"
    assert wide[1][0].return_status == "On Time"


def test_keys_come_from_the_dimensions(wide):
    row = wide[6][0]
    assert row.customer_id is None and row.customer_name is None
    assert row.rental_date == date(2005, 6, 3) and row.rental_count == 1


def test_unknown_place(models):
    row = by(models["dim_customer"], "customer_id")[2][0]
    assert (row.full_name, row.city_name, row.customer_location) == ("Ann2 Roe", None, None)
    assert by(models["dim_customer"], "customer_id")[1][0].customer_location == "Lima, Peru"
    assert models["dim_store"].first().store_location == "Lima, Peru"


def test_film_with_two_categories_repeats(models):
    films = by(models["dim_film"], "film_id")
    assert sorted(r.category_name for r in films[2]) == ["Comedy", "Drama"]
    assert [r.category_name for r in films[9]] == [None]


@pytest.mark.parametrize(
    ("length", "label"),
    [(59, "Short"), (60, "Medium"), (120, "Medium"), (121, "Long"), (None, "Long")],
)
def test_length_bands(spark, length, label):
    films = fx.models(spark, film=[fx.film(1, length=length)], film_category=[])
    assert films["dim_film"].first().film_length_category == label


def test_rate_bands(spark, models):
    rates = [0.99, 1.0, 2.99, 2.995, 3.0, 4.99, 5.0, None]
    films = models["stg_film"].limit(1).drop("rental_rate").crossJoin(
        spark.createDataFrame([(r,) for r in rates], "rental_rate double")
    )
    got = {r.rental_rate: r.rental_rate_category for r in dim_film(
        films, models["stg_film_category"], models["stg_category"]
    ).collect()}
    assert got == {
        0.99: "Budget", 1.0: "Standard", 2.99: "Standard", 2.995: "Luxury", 3.0: "Premium",
        4.99: "Premium", 5.0: "Luxury", None: "Luxury",
    }


def test_release_year_text_is_cast(spark, models):
    from kinomart.plans.staging import stg_film

    film = models["film"].withColumn("release_year", models["film"].release_year.cast("string"))
    assert dict(stg_film(film).dtypes)["release_year"] == "int"


def test_dates(spark):
    days = ["2004-02-29", "2005-01-01", "2005-05-29", "2005-12-31"]
    rentals = [fx.rental(i, 1, 1, f"{d} 10:00:00", "2006-03-03 00:00:00") for i, d in enumerate(days)]
    paid = [fx.payment(1, 1, "1.00", day="2005-05-29 23:59:59")]
    rows = fx.models(spark, rental=rentals, payment=paid)["dim_date"].collect()
    # Gaps stay gaps and return dates do not count.
    assert [str(r.date_day) for r in rows] == days
    leap, first, sunday, last = rows
    assert leap.is_month_end and leap.day_of_year == 60
    assert first.week_of_year == 53 and first.is_month_start and first.year_quarter == "2005-Q1"
    assert sunday.day_of_week == 1 and sunday.is_weekend and not sunday.is_weekday
    assert (sunday.day_name, sunday.month_name, sunday.year_month) == ("Sunday", "May", "2005-05")
    assert last.day_of_year == 365 and last.quarter == 4 and last.is_month_end


def test_null_date_keeps_one_row(spark):
    rows = [fx.rental(1, 1, 1, "2005-05-29 10:00:00") | {"rental_date": None}] * 2
    (row,) = fx.models(spark, rental=rows, payment=[])["dim_date"].collect()
    assert row.date_day is None and row.year is None
    assert not any((row.is_weekend, row.is_weekday, row.is_month_start, row.is_month_end))


def test_return_dates(fact):
    assert fact[1][0].return_date_id == date(2005, 5, 26)
    assert fact[1][0].rental_date == at("2005-05-24 22:00:00")


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_the_wide_table_is_the_facts_with_repeated_and_missing_keys(spark, models, hot_rows):
    base = {r: models[r] for r in ("stg_rental", "stg_payment", "stg_inventory", "stg_film")}
    dims = {d: models[d].union(models[d]) for d in ("dim_customer", "dim_film")}
    dims |= {"dim_store": models["dim_store"].limit(1), "dim_date": models["dim_date"].where("day > 3")}
    base["stg_rental"] = base["stg_rental"].union(base["stg_rental"].limit(2)).withColumn(
        "customer_id", F.nullif("customer_id", F.lit(2))
    )
    wanted = rental_analytics(fct_rental(*base.values()), *dims.values())
    found = rental_analytics_of_rentals(*base.values(), *dims.values(), hot_rows=hot_rows)
    assert found.schema == wanted.schema
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
