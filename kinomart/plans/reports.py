"""Operational reports over the base tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinomart.functions.columns import TOTAL, capitalized, holds, spaced
from kinomart.operators.aggregates import group_concat


def _placed(
    owners: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame
) -> DataFrame:
    """Owners whose address, city and country are all known."""
    return (
        owners.join(address.select("address_id", "address", "postal_code", "phone", "city_id"), "address_id")
        .join(city.select("city_id", "city", "country_id"), "city_id")
        .join(country.select("country_id", "country"), "country_id")
    )


def _people(placed: DataFrame, key: str, *extra: Column) -> DataFrame:
    return placed.select(
        F.col(key).alias("id"),
        spaced("first_name", "last_name").alias("name"),
        "address",
        F.col("postal_code").alias("zip code"),
        "phone",
        "city",
        "country",
        *extra,
        F.col("store_id").alias("sid"),
    )


def customer_list(
    customer: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame
) -> DataFrame:
    notes = F.when(holds(F.col("activebool")), "active").otherwise("").alias("notes")
    people = customer.select(
        "customer_id", "first_name", "last_name", "address_id", "activebool", "store_id"
    )
    return _people(_placed(people, address, city, country), "customer_id", notes)


def staff_list(
    staff: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame
) -> DataFrame:
    people = staff.select("staff_id", "first_name", "last_name", "address_id", "store_id")
    return _people(_placed(people, address, city, country), "staff_id")


def _films_with_cast(
    film: DataFrame,
    category: DataFrame,
    film_category: DataFrame,
    film_actor: DataFrame,
    actor: DataFrame,
    name: Column,
) -> DataFrame:
    # Only ids and names go through the text aggregation; film columns join its result.
    cast = film_actor.select("actor_id", "film_id").join(
        actor.select("actor_id", name.alias("actor_name")), "actor_id"
    )
    labels = film_category.select("film_id", "category_id").join(
        category.select("category_id", F.col("name").alias("category")), "category_id"
    )
    listed = group_concat(
        cast.join(labels, "film_id"), ["film_id", "category"], "actor_name", "actors",
        near=["film_id"],
    )
    return film.join(listed, "film_id").select(
        F.col("film_id").alias("fid"),
        "title",
        "description",
        "category",
        F.col("rental_rate").alias("price"),
        "length",
        "rating",
        "actors",
    )


def film_list(
    film: DataFrame, category: DataFrame, film_category: DataFrame, film_actor: DataFrame,
    actor: DataFrame,
) -> DataFrame:
    """Films with category and cast, actors in name order."""
    name = spaced("first_name", "last_name")
    return _films_with_cast(film, category, film_category, film_actor, actor, name)


def nicer_film_list(
    film: DataFrame, category: DataFrame, film_category: DataFrame, film_actor: DataFrame,
    actor: DataFrame,
) -> DataFrame:
    """As ``film_list``, with re-cased names set without a space between them."""
    name = F.concat(capitalized("first_name"), capitalized("last_name"))
    return _films_with_cast(film, category, film_category, film_actor, actor, name)


def actor_info(
    actor: DataFrame, film: DataFrame, category: DataFrame, film_category: DataFrame,
    film_actor: DataFrame,
) -> DataFrame:
    """Every actor with the films per category, ``'Drama: A, B, Horror: C'``; NULL without any."""
    roles = (
        film_actor.select("actor_id", "film_id")
        .join(film_category.select("film_id", "category_id"), "film_id")
        .join(film.select("film_id", "title"), "film_id")
    )
    titles = group_concat(roles, ["actor_id", "category_id"], "title", "titles")
    lines = (
        titles.join(category.select("category_id", "name"), "category_id")
        .select("actor_id", F.concat("name", F.lit(": "), "titles").alias("line"))
        .distinct()
    )
    info = group_concat(lines, ["actor_id"], "line", "film_info")
    return actor.select("actor_id", "first_name", "last_name").join(info, "actor_id", "left")


def _sales_per(payment: DataFrame, rental: DataFrame, inventory: DataFrame, key: str) -> DataFrame:
    """Payments summed per rental, item and then ``key``.

    Each sum runs before the next join, so that a join sees one row per key and its shuffle
    serves the sum as well.
    """
    per_rental = payment.groupBy("rental_id").agg(F.sum("amount").alias("sales"))
    per_item = (
        per_rental.join(rental.select("rental_id", "inventory_id"), "rental_id")
        .groupBy("inventory_id")
        .agg(F.sum("sales").alias("sales"))
    )
    return (
        per_item.join(inventory.select("inventory_id", key), "inventory_id")
        .groupBy(key)
        .agg(F.sum("sales").alias("sales"))
    )


def sales_by_film_category(
    payment: DataFrame, rental: DataFrame, inventory: DataFrame, film: DataFrame,
    film_category: DataFrame, category: DataFrame,
) -> DataFrame:
    """Sales per category, highest first. A film counts once for each of its categories."""
    per_film = _sales_per(payment, rental, inventory, "film_id").join(
        film.select("film_id"), "film_id"
    )
    per_category = (
        per_film.join(film_category.select("film_id", "category_id"), "film_id")
        .groupBy("category_id")
        .agg(F.sum("sales").alias("sales"))
    )
    return (
        per_category.join(category.select("category_id", "name"), "category_id")
        .groupBy(F.col("name").alias("category"))
        .agg(F.sum("sales").cast(TOTAL).alias("total_sales"))
        .orderBy(F.desc_nulls_first("total_sales"))
    )


def sales_by_store(
    payment: DataFrame, rental: DataFrame, inventory: DataFrame, store: DataFrame,
    address: DataFrame, city: DataFrame, country: DataFrame, staff: DataFrame,
) -> DataFrame:
    """Sales per store with its place and manager, in order of country and city."""
    managers = staff.select(
        F.col("staff_id").alias("manager_staff_id"),
        spaced("first_name", "last_name").alias("manager"),
    )
    sales = _sales_per(payment, rental, inventory, "store_id").join(
        store.select("store_id", "manager_staff_id", "address_id"), "store_id"
    )
    return (
        _placed(sales, address, city, country)
        .join(managers, "manager_staff_id")
        .orderBy("country", "city")
        .select(
            spaced("city", "country", ",").alias("store"),
            "manager",
            F.col("sales").cast(TOTAL).alias("total_sales"),
        )
    )
