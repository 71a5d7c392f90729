from decimal import Decimal

import fixtures as fx
import pytest
from fixtures import by

LOADED = {"last_update": fx.LOADED}


@pytest.fixture(scope="module")
def models(spark):
    return fx.models(spark)


def test_film_list(models):
    rows = by(models["film_list"], "fid", "category")
    assert rows[1, "Drama"][0].actors == "Al Roe, ED mcDOE"
    assert rows[2, "Comedy"][0].actors == "ED mcDOE"
    assert set(rows) == {(1, "Drama"), (2, "Drama"), (2, "Comedy")}


def test_nicer_film_list_has_no_space(models):
    rows = by(models["nicer_film_list"], "fid", "category")
    assert rows[1, "Drama"][0].actors == "AlRoe, EdMcdoe"


def test_categories_of_one_name_share_a_row(spark):
    category = [{"category_id": i, "name": "Drama"} | LOADED for i in (1, 2)]
    rows = fx.models(spark, category=category)["film_list"].collect()
    assert {(r.fid, r.actors) for r in rows} == {(1, "Al Roe, ED mcDOE"), (2, "ED mcDOE, ED mcDOE")}
    assert len(rows) == 2


def test_actor_info(models):
    rows = by(models["actor_info"], "actor_id")
    assert rows[1][0].film_info == "Comedy: BETA, Drama: ALPHA, BETA"
    assert rows[2][0].film_info == "Drama: ALPHA"
    assert rows[3][0].film_info is None


def test_customer_list(models):
    rows = by(models["customer_list"], "id")
    assert set(rows) == {1, 3}  # customer 2 has no known address
    assert rows[1][0].notes == "active" and rows[1][0]["zip code"] is None
    assert models["customer_list"].columns == [
        "id", "name", "address", "zip code", "phone", "city", "country", "notes", "sid",
    ]


def test_inactive_and_unknown_customers_have_empty_notes(spark):
    customers = [c | {"address_id": 1} for c in fx.base()["customer"]]
    customers[2]["activebool"] = None
    rows = by(fx.models(spark, customer=customers)["customer_list"], "id")
    assert [rows[i][0].notes for i in (1, 2, 3)] == ["active", "", ""]


def test_staff_list(models):
    (row,) = models["staff_list"].collect()
    assert (row.id, row.name, row.city, row.country, row.sid) == (1, "Mo Poe", "Lima", "Peru", 1)


def test_sales_by_film_category(models):
    rows = [(r.category, r.total_sales) for r in models["sales_by_film_category"].collect()]
    # Item 2 is film 2 of both categories; rentals 5 and 7 have no known film.
    assert rows == [("Drama", Decimal("9.48")), ("Comedy", Decimal("8.49"))]


def test_sales_by_store(models):
    (row,) = models["sales_by_store"].collect()
    assert (row.store, row.manager, row.total_sales) == ("Lima,Peru", "Mo Poe", Decimal("10.48"))
