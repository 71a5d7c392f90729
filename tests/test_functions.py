from datetime import date
from decimal import Decimal

import fixtures as fx
import pytest
from fixtures import at, by
from pyspark.sql import functions as F

from kinomart.functions import columns as c
from kinomart.functions import rental as fn


@pytest.fixture(scope="module")
def models(spark):
    return fx.models(spark)


def test_stock(models):
    rows = by(models["inventory_in_stock"], "inventory_id")
    # Item 1 is out twice, 2 and 9 are back, 3 was never rented.
    assert {i: r[0].in_stock for i, r in rows.items()} == {1: False, 2: True, 3: True, 9: True}


def test_film_stock(models):
    inventory, rental = models["inventory"], models["rental"]
    assert [r.inventory_id for r in fn.film_in_stock(inventory, rental, 1, 1).collect()] == [3]
    assert [r.inventory_id for r in fn.film_not_in_stock(inventory, rental, 1, 1).collect()] == [1]
    assert fn.film_in_stock(inventory, rental, 1, 2).count() == 0
    assert models["film_in_stock"].count() == 3


def test_holder(models):
    rows = by(models["inventory_holder"], "inventory_id")
    assert {i: r[0].customer_id for i, r in rows.items()} == {1: 1, 2: None, 3: None, 9: None}


def balance(m, moment):
    df = fn.customer_balance(
        m["customer"], m["rental"], m["inventory"], m["film"], m["payment"], at(moment)
    )
    return {i: r[0] for i, r in by(df, "customer_id").items()}


def test_balance(models):
    late = balance(models, "2005-07-01 00:00:00")
    # Rentals 1, 2 and 4 with a known film; 2 days late; payments 1 to 4.
    assert (late[1].rental_fees, late[1].late_fees) == (Decimal("4.97"), Decimal("2.00"))
    assert late[1].payments == Decimal("9.98") and late[1].balance == Decimal("-3.01")
    assert late[2].balance == Decimal("0.00")
    early = balance(models, "2005-05-25 00:00:00")
    assert early[1].rental_fees == Decimal("0.99") and early[1].payments == 0


def test_balance_takes_the_moment_itself(models):
    assert balance(models, "2005-05-28 08:00:00")[1].rental_fees == Decimal("3.98")


@pytest.mark.parametrize(
    ("as_of", "start", "end"),
    [
        (date(2005, 8, 31), date(2005, 5, 1), date(2005, 6, 1)),
        (date(2005, 3, 1), date(2004, 12, 1), date(2005, 1, 1)),
        (date(2005, 2, 10), date(2004, 11, 1), date(2004, 12, 1)),
    ],
)
def test_reward_month(as_of, start, end):
    assert fn.reward_month(as_of) == (start, end)


def rewarded(spark, payments, purchases=2, amount="5.00"):
    m = fx.models(spark, payment=payments)
    df = fn.rewards_report(m["customer"], m["payment"], date(2005, 8, 10), purchases, amount)
    assert df.columns == m["customer"].columns
    return {r.customer_id for r in df.collect()}


def test_rewards_are_strictly_above_both_limits(spark):
    def paid(customer, *amounts):
        return [
            fx.payment(customer * 10 + i, 1, a, customer, "2005-05-31 23:59:59")
            for i, a in enumerate(amounts)
        ]

    at_amount = paid(1, "2.00", "2.00", "1.00")
    at_count = paid(2, "4.00", "4.00")
    above = paid(3, "2.00", "2.00", "1.01")
    assert rewarded(spark, at_amount + at_count + above) == {3}


def test_rewards_look_at_one_month(spark):
    days = ["2005-04-30 23:59:59", "2005-06-01 00:00:00", "2005-05-01 00:00:00"]
    payments = [fx.payment(i, 1, "9.00", 1, d) for i, d in enumerate(days)]
    assert rewarded(spark, payments, purchases=1) == set()
    assert rewarded(spark, [payments[2]] + [fx.payment(9, 1, "9.00", 1, days[2])], 1) == {1}


def test_rewards_refuse_zero(models):
    for purchases, amount in ((0, "1"), (1, "0.00")):
        with pytest.raises(ValueError):
            fn.rewards_report(models["customer"], models["payment"], date(2005, 8, 1), purchases, amount)


def test_reward_filter_reaches_the_scan(spark, tmp_path):
    from kinomart.session import materialize

    m = fx.models(spark)
    stored = materialize(m["payment"], str(tmp_path / "payment"))
    df = fn.rewards_report(m["customer"], stored, date(2005, 8, 1), 1, 1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(payment_date" in plan


def test_last_day(spark):
    days = spark.createDataFrame([("2004-02-10",), ("2005-12-01",), (None,)], "d string")
    got = [r.e for r in days.select(c.last_day(F.col("d").cast("timestamp_ntz")).alias("e")).collect()]
    assert got == [date(2004, 2, 29), date(2005, 12, 31), None]


def test_capitalized(spark):
    names = spark.createDataFrame([("mary ANN",), ("x",), ("",), (None,)], "n string")
    got = [r.n for r in names.select(c.capitalized("n").alias("n")).collect()]
    assert got == ["Mary ann", "X", "", None]


def test_spaced_is_null_with_a_null(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    assert df.select(c.spaced("a", "b").alias("x")).first().x is None
