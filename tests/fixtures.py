"""Small hand-made base tables."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from kinomart.plans.models import Models
from kinomart.sources.schemas import SCHEMAS


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


LOADED = at("2006-02-15 10:00:00")


def table(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    schema = SCHEMAS[name]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def film(film_id, title="T", length=90, rate="0.99", duration=3, **more) -> dict:
    return {
        "film_id": film_id, "title": title, "description": "d", "release_year": 2005,
        "language_id": 1, "rental_duration": duration,
        "rental_rate": None if rate is None else Decimal(rate), "length": length,
        "replacement_cost": Decimal("19.99"), "rating": "G", "last_update": LOADED,
        "fulltext": "",
    } | more


def rental(rental_id, inventory_id, customer_id, out, back=None, **more) -> dict:
    return {
        "rental_id": rental_id, "inventory_id": inventory_id, "customer_id": customer_id,
        "rental_date": at(out), "return_date": at(back) if back else None, "staff_id": 1,
        "last_update": LOADED,
    } | more


def payment(payment_id, rental_id, amount, customer_id=1, day="2005-06-01 08:00:00") -> dict:
    return {
        "payment_id": payment_id, "rental_id": rental_id, "customer_id": customer_id,
        "staff_id": 1, "amount": Decimal(amount), "payment_date": at(day),
    }


def base() -> dict[str, list[dict]]:
    """A little shop: film 9 has no category, item 9 no film, rental 7 no known item."""
    stamp = {"last_update": LOADED}
    return {
        "country": [{"country_id": 1, "country": "Peru"} | stamp],
        "city": [{"city_id": 1, "city": "Lima", "country_id": 1} | stamp],
        "address": [
            {"address_id": i, "address": f"{i} Road", "district": "D", "city_id": 1,
             "postal_code": None, "phone": "1"} | stamp
            for i in (1, 2, 3)
        ],
        "customer": [
            {"customer_id": i, "store_id": 1, "first_name": f"Ann{i}", "last_name": "Roe",
             "email": f"{i}@x", "address_id": a, "activebool": active,
             "create_date": date(2006, 2, 14), "active": int(active)} | stamp
            for i, a, active in ((1, 1, True), (2, 99, False), (3, 2, True))
        ],
        "staff": [
            {"staff_id": 1, "first_name": "Mo", "last_name": "Poe", "address_id": 3,
             "store_id": 1, "active": True, "username": "mo"} | stamp
        ],
        "store": [{"store_id": 1, "manager_staff_id": 1, "address_id": 3} | stamp],
        "language": [{"language_id": 1, "name": "English"} | stamp],
        "category": [
            {"category_id": 1, "name": "Drama"} | stamp,
            {"category_id": 2, "name": "Comedy"} | stamp,
        ],
        "film": [film(1, "ALPHA", 50), film(2, "BETA", 100, "2.99"), film(9, "OMEGA", None, "4.99")],
        "film_category": [
            {"film_id": 1, "category_id": 1} | stamp,
            {"film_id": 2, "category_id": 1} | stamp,
            {"film_id": 2, "category_id": 2} | stamp,
        ],
        "actor": [
            {"actor_id": i, "first_name": f, "last_name": n} | stamp
            for i, f, n in ((1, "ED", "mcDOE"), (2, "Al", "Roe"), (3, "No", "Film"))
        ],
        "film_actor": [
            {"film_id": 1, "actor_id": 1} | stamp,
            {"film_id": 1, "actor_id": 2} | stamp,
            {"film_id": 2, "actor_id": 1} | stamp,
        ],
        "inventory": [
            {"inventory_id": i, "film_id": f, "store_id": 1} | stamp
            for i, f in ((1, 1), (2, 2), (3, 1), (9, 99))
        ],
        "rental": [
            rental(1, 1, 1, "2005-05-24 22:00:00", "2005-05-26 01:00:00"),
            rental(2, 2, 1, "2005-05-28 08:00:00", "2005-06-02 09:00:00"),
            rental(3, 1, 3, "2005-06-01 08:00:00"),
            rental(4, 1, 1, "2005-06-02 08:00:00"),
            rental(5, 9, 1, "2005-06-01 08:00:00", "2005-06-20 08:00:00"),
            rental(6, 2, 8, "2005-06-03 08:00:00", "2005-06-01 00:00:00"),
            rental(7, 77, 1, "2005-06-04 08:00:00", "2005-06-05 08:00:00"),
        ],
        "payment": [
            payment(1, 1, "0.99"),
            payment(2, 2, "2.99"),
            payment(3, 2, "5.00"),
            payment(4, 5, "1.00"),
            payment(5, 7, "1.00", day="2005-12-31 08:00:00"),
            payment(6, 6, "0.50", customer_id=8),
        ],
    }


def models(spark: SparkSession, **tables: list[dict]) -> Models:
    rows = base() | tables
    return Models(lambda name: table(spark, name, rows[name]))


def by(df: DataFrame, *keys: str) -> dict:
    """Rows by the given columns; a single one is unwrapped."""
    found = {}
    for row in df.collect():
        key = tuple(row[k] for k in keys)
        found.setdefault(key[0] if len(keys) == 1 else key, []).append(row)
    return found
