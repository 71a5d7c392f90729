"""Staging models: one lazy projection per base table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinomart.functions.columns import whole_days


def stg_address(address: DataFrame) -> DataFrame:
    return address.select(
        "address_id",
        F.col("address").alias("address_line1"),
        F.col("address2").alias("address_line2"),
        "district",
        "city_id",
        "postal_code",
        "phone",
        "last_update",
    )


def stg_category(category: DataFrame) -> DataFrame:
    return category.select("category_id", F.col("name").alias("category_name"), "last_update")


def stg_city(city: DataFrame) -> DataFrame:
    return city.select("city_id", F.col("city").alias("city_name"), "country_id", "last_update")


def stg_country(country: DataFrame) -> DataFrame:
    return country.select("country_id", F.col("country").alias("country_name"), "last_update")


def stg_customer(customer: DataFrame) -> DataFrame:
    return customer.select(
        "customer_id",
        "store_id",
        "first_name",
        "last_name",
        "email",
        "address_id",
        F.col("activebool").alias("is_active"),
        "create_date",
        "last_update",
    )


def stg_film(film: DataFrame) -> DataFrame:
    return film.select(
        "film_id",
        "title",
        "description",
        F.col("release_year").cast("int").alias("release_year"),
        "language_id",
        "rental_duration",
        "rental_rate",
        F.col("length").alias("length_minutes"),
        "replacement_cost",
        "rating",
        "last_update",
    )


def stg_film_category(film_category: DataFrame) -> DataFrame:
    return film_category.select("film_id", "category_id", "last_update")


def stg_inventory(inventory: DataFrame) -> DataFrame:
    return inventory.select("inventory_id", "film_id", "store_id", "last_update")


def stg_payment(payment: DataFrame) -> DataFrame:
    return payment.select(
        "payment_id", "customer_id", "staff_id", "rental_id", "amount", "payment_date"
    )


def stg_rental(rental: DataFrame) -> DataFrame:
    return rental.select(
        "rental_id",
        "rental_date",
        "inventory_id",
        "customer_id",
        "return_date",
        "staff_id",
        "last_update",
        whole_days("rental_date", "return_date").alias("rental_duration_days"),
    )


def stg_store(store: DataFrame) -> DataFrame:
    return store.select("store_id", "manager_staff_id", "address_id", "last_update")
