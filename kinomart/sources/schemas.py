"""Schemas, keys and constraints of the fifteen base tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(4,2)": T.DecimalType(4, 2),
    "decimal(5,2)": T.DecimalType(5, 2),
    "array<string>": T.ArrayType(T.StringType()),
    "binary": T.BinaryType(),
}

# Column types as Spark reads them; all keys are as wide as any source may have them. char(n) and bytea are decoded by the text reader.
_COLUMNS = {
    "actor": "actor_id bigint, first_name string, last_name string, last_update timestamp_ntz",
    "address": "address_id bigint, address string, address2 string, district string, city_id bigint,"
    " postal_code string, phone string, last_update timestamp_ntz",
    "category": "category_id bigint, name string, last_update timestamp_ntz",
    "city": "city_id bigint, city string, country_id bigint, last_update timestamp_ntz",
    "country": "country_id bigint, country string, last_update timestamp_ntz",
    "customer": "customer_id bigint, store_id bigint, first_name string, last_name string,"
    " email string, address_id bigint, activebool boolean, create_date date,"
    " last_update timestamp_ntz, active int",
    "film": "film_id bigint, title string, description string, release_year int,"
    " language_id bigint, rental_duration smallint, rental_rate decimal(4,2),"
    " length smallint, replacement_cost decimal(5,2), rating string,"
    " last_update timestamp_ntz, special_features array<string>, fulltext string",
    "film_actor": "actor_id bigint, film_id bigint, last_update timestamp_ntz",
    "film_category": "film_id bigint, category_id bigint, last_update timestamp_ntz",
    "inventory": "inventory_id bigint, film_id bigint, store_id bigint, last_update timestamp_ntz",
    "language": "language_id bigint, name string, last_update timestamp_ntz",
    "payment": "payment_id bigint, customer_id bigint, staff_id bigint, rental_id bigint,"
    " amount decimal(5,2), payment_date timestamp_ntz",
    "rental": "rental_id bigint, rental_date timestamp_ntz, inventory_id bigint, customer_id bigint,"
    " return_date timestamp_ntz, staff_id bigint, last_update timestamp_ntz",
    "staff": "staff_id bigint, first_name string, last_name string, address_id bigint,"
    " email string, store_id bigint, active boolean, username string, password string,"
    " last_update timestamp_ntz, picture binary",
    "store": "store_id bigint, manager_staff_id bigint, address_id bigint,"
    " last_update timestamp_ntz",
}

SCHEMAS: dict[str, T.StructType] = {
    table: T.StructType(
        [T.StructField(name, _TYPES[dtype]) for name, dtype in map(str.split, columns.split(", "))]
    )
    for table, columns in _COLUMNS.items()
}

# Blank-padded char(n) columns.
PADDED = {"language": ("name",)}

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "actor": ("actor_id",),
    "address": ("address_id",),
    "category": ("category_id",),
    "city": ("city_id",),
    "country": ("country_id",),
    "customer": ("customer_id",),
    "film": ("film_id",),
    "film_actor": ("actor_id", "film_id"),
    "film_category": ("film_id", "category_id"),
    "inventory": ("inventory_id",),
    "language": ("language_id",),
    "payment": ("payment_id",),
    "rental": ("rental_id",),
    "staff": ("staff_id",),
    "store": ("store_id",),
}

UNIQUE_INDEXES: dict[str, tuple[str, ...]] = {
    "store": ("manager_staff_id",),
    "rental": ("rental_date", "inventory_id", "customer_id"),
}


class ForeignKey(NamedTuple):
    child: str
    column: str
    parent: str
    parent_column: str


FOREIGN_KEYS = [
    ForeignKey("address", "city_id", "city", "city_id"),
    ForeignKey("city", "country_id", "country", "country_id"),
    ForeignKey("customer", "address_id", "address", "address_id"),
    ForeignKey("film", "language_id", "language", "language_id"),
    ForeignKey("film_actor", "actor_id", "actor", "actor_id"),
    ForeignKey("film_actor", "film_id", "film", "film_id"),
    ForeignKey("film_category", "category_id", "category", "category_id"),
    ForeignKey("film_category", "film_id", "film", "film_id"),
    ForeignKey("inventory", "film_id", "film", "film_id"),
    ForeignKey("payment", "customer_id", "customer", "customer_id"),
    ForeignKey("payment", "rental_id", "rental", "rental_id"),
    ForeignKey("payment", "staff_id", "staff", "staff_id"),
    ForeignKey("rental", "customer_id", "customer", "customer_id"),
    ForeignKey("rental", "inventory_id", "inventory", "inventory_id"),
    ForeignKey("rental", "staff_id", "staff", "staff_id"),
    ForeignKey("staff", "address_id", "address", "address_id"),
    ForeignKey("store", "address_id", "address", "address_id"),
    ForeignKey("store", "manager_staff_id", "staff", "staff_id"),
]

RATINGS = ("G", "PG", "PG-13", "R", "NC-17")
RELEASE_YEARS = (1901, 2155)

# Column defaults, as SQL text. The load time stands for now() and the current date.
DEFAULTS: dict[str, dict[str, str]] = {
    "film": {"rental_duration": "3", "rental_rate": "4.99", "replacement_cost": "19.99",
             "rating": "'G'"},
    "customer": {"activebool": "true"},
    "staff": {"active": "true"},
}
STAMPED = [name for name in SCHEMAS if name != "payment"]

# Names changed on the way into the warehouse.
INGEST_NAMES = {"zip code": "zip_code"}
