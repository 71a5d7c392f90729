"""Functions called from SQL agree with the jobs over all keys."""

from decimal import Decimal

import fixtures as fx
import pytest
from fixtures import at
from pyspark.errors import PySparkException

from kinomart.functions import rental as fn
from kinomart.functions.sql import register


@pytest.fixture
def models(spark):
    models = fx.models(spark)
    register(spark, models)
    return models


def test_stock(spark, models):
    rows = spark.sql(
        "SELECT inventory_id, film_id, store_id, inventory_in_stock(inventory_id) in_stock FROM inventory"
    )
    assert sorted(rows.collect()) == sorted(models["inventory_in_stock"].collect())
    assert spark.sql("SELECT inventory_in_stock(1000) s").first().s is True


def test_unknown_item_is_in_stock_even_if_rented_out(spark):
    register(spark, fx.models(spark, rental=[fx.rental(1, 500, 3, "2005-06-01 08:00:00")]))
    row = spark.sql("SELECT inventory_in_stock(500) s, inventory_held_by_customer(500) c").first()
    assert (row.s, row.c) == (True, 3)


def test_film_stock(spark, models):
    for name in ("film_in_stock", "film_not_in_stock"):
        got = spark.sql(
            f"SELECT film_id, store_id, p_film_count FROM (SELECT DISTINCT film_id, store_id"
            f" FROM inventory) i, LATERAL {name}(i.film_id, i.store_id)"
        )
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, models[name].collect()))
    assert [r.p_film_count for r in spark.sql("SELECT * FROM film_in_stock(1, 1)").collect()] == [3]


def test_holder(spark, models):
    got = spark.sql("SELECT inventory_id, inventory_held_by_customer(inventory_id) c FROM inventory")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, models["inventory_holder"].collect()))


def test_balance(spark, models):
    m = models
    jobs = fn.customer_balance(
        m["customer"], m["rental"], m["inventory"], m["film"], m["payment"], at("2005-07-01 00:00:00")
    )
    got = spark.sql(
        "SELECT customer_id, get_customer_balance(customer_id, timestamp_ntz'2005-07-01') b FROM customer"
    )
    assert sorted(map(tuple, got.collect())) == sorted((r.customer_id, r.balance) for r in jobs.collect())


def test_rewards(spark):
    today = spark.sql("SELECT current_date() d").first().d
    start, end = fn.reward_month(today)
    payments = [fx.payment(i, 1, "3.00", 1, f"{start} 10:00:00") for i in range(3)]
    payments += [fx.payment(10 + i, 1, "9.00", 3, f"{end} 00:00:00") for i in range(3)]
    models = fx.models(spark, payment=payments)
    register(spark, models)
    got = spark.sql("SELECT * FROM rewards_report(2, 5.00)")
    assert got.columns == models["customer"].columns
    assert [r.customer_id for r in got.collect()] == [1]
    assert spark.sql("SELECT * FROM rewards_report(3, 5.00)").count() == 0
    for limits in ("0, 5.00", "2, 0.00"):
        with pytest.raises(PySparkException, match="greater than 0"):
            spark.sql(f"SELECT * FROM rewards_report({limits})").collect()


def test_reports_are_views(spark, models):
    assert spark.sql("SELECT actors FROM nicer_but_slower_film_list WHERE fid = 1").first().actors == "AlRoe, EdMcdoe"
    total = spark.sql("SELECT sum(total_sales) t FROM sales_by_store").first().t
    assert total == Decimal("10.48")
