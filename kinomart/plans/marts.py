"""Star schema: four dimensions, the rental fact and the wide table for BI."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinomart.functions.columns import holds, money, spaced
from kinomart.operators.joins import HOT_ROWS, left_join_split


def _located(
    owners: DataFrame, addresses: DataFrame, cities: DataFrame, countries: DataFrame
) -> DataFrame:
    """Owners with their address, city and country, where known.

    The address comes first: stores are few, and only their addresses meet a city then.
    """
    return (
        owners.join(addresses.drop("last_update"), "address_id", "left")
        .join(cities.drop("last_update"), "city_id", "left")
        .join(countries.drop("last_update"), "country_id", "left")
    )


def dim_customer(
    customers: DataFrame, addresses: DataFrame, cities: DataFrame, countries: DataFrame
) -> DataFrame:
    return _located(customers, addresses, cities, countries).select(
        "customer_id",
        "first_name",
        "last_name",
        spaced("first_name", "last_name").alias("full_name"),
        "email",
        "is_active",
        "create_date",
        "store_id",
        "address_line1",
        "address_line2",
        "district",
        "postal_code",
        "phone",
        "city_name",
        "country_name",
        spaced("city_name", "country_name", ", ").alias("customer_location"),
        F.col("last_update").alias("customer_last_update"),
    )


def dim_store(
    stores: DataFrame, addresses: DataFrame, cities: DataFrame, countries: DataFrame
) -> DataFrame:
    return _located(stores, addresses, cities, countries).select(
        "store_id",
        "manager_staff_id",
        "address_line1",
        "address_line2",
        "district",
        "postal_code",
        "phone",
        "city_name",
        "country_name",
        spaced("city_name", "country_name", ", ").alias("store_location"),
        F.col("last_update").alias("store_last_update"),
    )


def dim_film(films: DataFrame, film_categories: DataFrame, categories: DataFrame) -> DataFrame:
    """One row per film and category; a film without category keeps one row."""
    named = film_categories.drop("last_update").join(
        categories.drop("last_update"), "category_id", "left"
    )
    length, rate = F.col("length_minutes"), F.col("rental_rate")
    # Unknown values and rates between the bands fall through to the last label.
    by_length = (
        F.when(length < 60, "Short").when(length.between(60, 120), "Medium").otherwise("Long")
    )
    by_rate = (
        F.when(rate < 1.0, "Budget")
        .when(rate.between(1.0, 2.99), "Standard")
        .when(rate.between(3.0, 4.99), "Premium")
        .otherwise("Luxury")
    )
    return films.join(named, "film_id", "left").select(
        "film_id",
        "title",
        "description",
        "release_year",
        "language_id",
        "rental_duration",
        "rental_rate",
        "length_minutes",
        "replacement_cost",
        "rating",
        "category_name",
        by_length.alias("film_length_category"),
        by_rate.alias("rental_rate_category"),
        F.col("last_update").alias("film_last_update"),
    )


def dim_date(rentals: DataFrame, payments: DataFrame) -> DataFrame:
    """The days on which something was rented or paid; gaps stay gaps, NULL keeps one row."""
    day = F.col("date_day")
    weekday = F.dayofweek(day)  # Sunday is 1
    days = (
        rentals.select(F.to_date("rental_date").alias("date_day"))
        .union(payments.select(F.to_date("payment_date").alias("date_day")))
        .distinct()
    )
    return days.select(
        "date_day",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        weekday.alias("day_of_week"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.date_format(day, "yyyy-QQQ").alias("year_quarter"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        holds(weekday.isin(1, 7)).alias("is_weekend"),
        holds(weekday.between(2, 6)).alias("is_weekday"),
        holds(F.dayofmonth(day) == 1).alias("is_month_start"),
        holds(F.last_day(day) == day).alias("is_month_end"),
    ).orderBy("date_day")


def _priced(rentals: DataFrame, inventory: DataFrame, films: DataFrame) -> DataFrame:
    """One row per rental, with its item's film terms."""
    # Film terms join the rentals, which are fewer than the inventory's items, before payments multiply the rows.
    return _with_terms(_with_items(rentals, inventory), films)


def _with_items(rentals: DataFrame, inventory: DataFrame) -> DataFrame:
    return rentals.join(inventory.select("inventory_id", "film_id", "store_id"), "inventory_id", "left")


def _with_terms(rows: DataFrame, films: DataFrame) -> DataFrame:
    return rows.join(films.select("film_id", "rental_rate", "rental_duration"), "film_id", "left")


def _payments(payments: DataFrame) -> DataFrame:
    """What the fact takes of payments."""
    return payments.select("rental_id", "payment_id", "payment_date", "amount")


def _fact(paid: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """The fact's columns, and those that the rentals carry, of one row per rental and payment."""
    actual = F.coalesce("amount", F.lit(0))
    overdue = F.col("rental_duration_days") - F.col("rental_duration")
    late = holds(F.col("return_date").isNotNull() & (overdue > 0))
    days_overdue = F.when(late, overdue).otherwise(0)
    return paid.select(
        "rental_id",
        "customer_id",
        "film_id",
        "store_id",
        "staff_id",
        F.to_date("rental_date").alias("rental_date_id"),
        F.to_date("return_date").alias("return_date_id"),
        F.to_date("payment_date").alias("payment_date_id"),
        "rental_date",
        "return_date",
        "payment_date",
        "inventory_id",
        "payment_id",
        money("amount").alias("payment_amount"),
        money("rental_rate").alias("expected_amount"),
        "rental_duration_days",
        F.col("rental_duration").alias("expected_rental_duration"),
        money(actual).alias("actual_payment"),
        money(actual - F.col("rental_rate")).alias("payment_variance"),
        F.col("return_date").isNull().alias("is_not_returned"),
        late.alias("is_late_return"),
        days_overdue.alias("days_overdue"),
        money(days_overdue).alias("calculated_late_fee"),
        F.col("last_update").alias("rental_last_update"),
        *carried,
    )


def fct_rental(
    rentals: DataFrame,
    payments: DataFrame,
    inventory: DataFrame,
    films: DataFrame,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per rental and payment; a rental without payment keeps one row.

    A rental paid in several parts repeats its late fee on every row.
    """
    return _fact(left_join_split(_priced(rentals, inventory, films), _payments(payments), "rental_id", hot_rows))


LIST_ROWS = 100_000


def paid_rentals(
    rentals: DataFrame,
    payments: DataFrame,
    inventory: DataFrame,
    films: DataFrame,
    list_rows: int = LIST_ROWS,
) -> DataFrame:
    """One row per rental, with its item's film terms and its payments' columns as lists: a shuffle of these
    moves a rental's columns once, not once per payment. A rental with more than ``list_rows`` payments has
    several rows, each with a part of them."""
    return left_join_split(_priced(rentals, inventory, films), _payments(payments), "rental_id", list_rows, listed=True)


def _each_payment(paid: DataFrame) -> DataFrame:
    """One row per rental and payment of `paid_rentals`."""
    lists = ["payment_id", "payment_date", "amount"]
    rest = [c for c in paid.columns if c not in lists]
    return paid.select(*rest, F.inline_outer(F.arrays_zip(*lists)))


def fct_rental_of_paid(paid: DataFrame) -> DataFrame:
    """`fct_rental` of `paid_rentals`, without a shuffle."""
    return _fact(_each_payment(paid))


class _Dimensions(NamedTuple):
    customer: DataFrame
    film: DataFrame
    store: DataFrame
    day: DataFrame


def _dimensions(
    customers: DataFrame, films: DataFrame, stores: DataFrame, dates: DataFrame
) -> _Dimensions:
    """What the wide table shows of the dimensions; each has its key first."""
    customer = customers.select(
        F.col("customer_id").alias("_customer"),
        F.col("full_name").alias("customer_name"),
        F.col("first_name").alias("customer_first_name"),
        F.col("last_name").alias("customer_last_name"),
        F.col("email").alias("customer_email"),
        F.col("is_active").alias("is_active_customer"),
        "customer_location",
        F.col("city_name").alias("customer_city"),
        F.col("country_name").alias("customer_country"),
        F.col("postal_code").alias("customer_postal_code"),
        F.col("phone").alias("customer_phone"),
    )
    film = films.select(
        F.col("film_id").alias("_film"),
        F.col("title").alias("film_title"),
        F.col("description").alias("film_description"),
        "release_year",
        F.col("rating").alias("film_rating"),
        F.col("category_name").alias("film_category"),
        F.col("length_minutes").alias("film_length_minutes"),
        "film_length_category",
        F.col("rental_rate").alias("film_rental_rate"),
        "rental_rate_category",
        F.col("replacement_cost").alias("film_replacement_cost"),
    )
    store = stores.select(
        F.col("store_id").alias("_store"),
        "store_location",
        F.col("city_name").alias("store_city"),
        F.col("country_name").alias("store_country"),
    )
    day = dates.select(
        F.col("date_day").alias("_day"),
        F.col("year").alias("rental_year"),
        F.col("month").alias("rental_month"),
        F.col("quarter").alias("rental_quarter"),
        F.col("day_name").alias("rental_day_name"),
        F.col("month_name").alias("rental_month_name"),
        F.col("is_weekend").alias("is_rental_weekend"),
        F.col("is_weekday").alias("is_rental_weekday"),
    )
    return _Dimensions(customer, film, store, day)


def _in_store(rows: DataFrame, d: _Dimensions) -> DataFrame:
    return rows.join(d.store, rows.store_id == d.store._store, "left")


def _of_customer(rows: DataFrame, d: _Dimensions) -> DataFrame:
    """Rows with their customer and film, where known."""
    # The film texts last: what a join adds, later shuffles carry.
    return _of_film(rows.join(d.customer, rows.customer_id == d.customer._customer, "left"), d)


def _of_film(rows: DataFrame, d: _Dimensions) -> DataFrame:
    return rows.join(d.film, rows.film_id == d.film._film, "left")


def _placed(rows: DataFrame, d: _Dimensions) -> DataFrame:
    """Rows with their store, customer and film, where known."""
    # The narrow dimension first.
    return _of_customer(_in_store(rows, d), d)


def _carried(d: _Dimensions) -> list[str]:
    """The columns of `_placed` rows that are the dimensions'."""
    return [*d.store.columns, *d.customer.columns, *d.film.columns]


def _wide(fact: DataFrame, d: _Dimensions) -> DataFrame:
    """The wide table's columns of a fact that has its dimensions but for the days: those are few, and
    no other join's shuffle carries their names."""
    customer, film, store, day = d
    paid, expected = F.col("payment_amount"), F.col("expected_amount")
    revenue = F.col("actual_payment") + F.col("calculated_late_fee")
    dated = fact.join(day, F.col("rental_date_id") == F.col("_day"), "left")
    return dated.select(
        "rental_id",
        "payment_id",
        "inventory_id",
        F.col("_customer").alias("customer_id"),
        *customer.columns[1:],
        F.col("_film").alias("film_id"),
        *film.columns[1:],
        F.col("_store").alias("store_id"),
        *store.columns[1:],
        F.col("_day").alias("rental_date"),
        *day.columns[1:],
        "return_date",
        "payment_date",
        "payment_amount",
        "expected_amount",
        "actual_payment",
        "payment_variance",
        F.col("rental_duration_days").alias("actual_rental_days"),
        F.col("expected_rental_duration").alias("expected_rental_days"),
        "days_overdue",
        "calculated_late_fee",
        "is_not_returned",
        "is_late_return",
        F.when(F.col("is_not_returned"), "Not Returned")
        .when(F.col("is_late_return"), "Late Return")
        .otherwise("On Time")
        .alias("return_status"),
        # Without a payment or a known film no comparison holds.
        F.when(paid > expected, "Overpaid")
        .when(paid < expected, "Underpaid")
        .when(paid == expected, "Exact")
        .otherwise("No Payment")
        .alias("payment_status"),
        money(revenue).alias("total_revenue"),
        holds(revenue >= expected).alias("is_profitable_rental"),
        F.lit(1).alias("rental_count"),
        "rental_last_update",
    )


def rental_analytics(
    fact: DataFrame, customers: DataFrame, films: DataFrame, stores: DataFrame, dates: DataFrame
) -> DataFrame:
    """The fact with all dimensions. Keys and the rental day are the dimensions' own, so they
    are NULL where a dimension row is missing."""
    d = _dimensions(customers, films, stores, dates)
    return _wide(_placed(fact, d), d)


def rental_analytics_of_rentals(
    rentals: DataFrame,
    payments: DataFrame,
    inventory: DataFrame,
    film_terms: DataFrame,
    customers: DataFrame,
    films: DataFrame,
    stores: DataFrame,
    dates: DataFrame,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """`rental_analytics` of a fact that is not stored: store, customer and film belong to a rental, so
    they join the rentals, before payments multiply the rows. A large dimension then shuffles each
    rental once, not each payment with all columns of the fact. Film terms and texts share a shuffle."""
    d = _dimensions(customers, films, stores, dates)
    items = _in_store(_with_items(rentals, inventory), d)
    of_customer = items.join(d.customer, items.customer_id == d.customer._customer, "left")
    placed = _of_film(_with_terms(of_customer, film_terms), d)
    return _wide(_fact(left_join_split(placed, _payments(payments), "rental_id", hot_rows), _carried(d)), d)


def rental_analytics_of_paid(
    paid: DataFrame, customers: DataFrame, films: DataFrame, stores: DataFrame, dates: DataFrame
) -> DataFrame:
    """`rental_analytics` of `paid_rentals`: rentals meet store, customer and film with their payments still
    in lists. Rows end up by film, so that equal film texts lie together in the files. Stores are few and
    join last, so that no shuffle carries their names."""
    d = _dimensions(customers, films, stores, dates)
    return _wide(_fact(_each_payment(_in_store(_of_customer(paid, d), d)), _carried(d)), d)
