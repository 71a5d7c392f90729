"""The database's per-key functions as jobs over all keys."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinomart.functions.columns import TOTAL, decimal_literal, ntz, whole_days


def _open_rentals(rental: DataFrame) -> DataFrame:
    return rental.where(F.col("return_date").isNull())


def inventory_in_stock(inventory: DataFrame, rental: DataFrame) -> DataFrame:
    """Every inventory item with a flag: in stock unless one of its rentals is open."""
    out = _open_rentals(rental).groupBy("inventory_id").agg(F.lit(True).alias("_out"))
    return inventory.join(out, "inventory_id", "left").select(
        "inventory_id", "film_id", "store_id", F.col("_out").isNull().alias("in_stock")
    )


def _stock_of(
    inventory: DataFrame, rental: DataFrame, wanted: bool, film_id: int | None, store_id: int | None
) -> DataFrame:
    if film_id is not None:
        inventory = inventory.where(F.col("film_id") == film_id)
    if store_id is not None:
        inventory = inventory.where(F.col("store_id") == store_id)
    stock = inventory_in_stock(inventory, rental)
    return stock.where(F.col("in_stock") == wanted).select("film_id", "store_id", "inventory_id")


def film_in_stock(
    inventory: DataFrame, rental: DataFrame, film_id: int | None = None, store_id: int | None = None
) -> DataFrame:
    """Items of a film at a store that can be rented; all films and stores by default."""
    return _stock_of(inventory, rental, True, film_id, store_id)


def film_not_in_stock(
    inventory: DataFrame, rental: DataFrame, film_id: int | None = None, store_id: int | None = None
) -> DataFrame:
    return _stock_of(inventory, rental, False, film_id, store_id)


def inventory_holder(inventory: DataFrame, rental: DataFrame) -> DataFrame:
    """Who holds each item, NULL if nobody. Of several open rentals the lowest customer counts."""
    holder = _open_rentals(rental).groupBy("inventory_id").agg(F.min("customer_id").alias("customer_id"))
    return inventory.select("inventory_id").join(holder, "inventory_id", "left")


def customer_balance(
    customer: DataFrame,
    rental: DataFrame,
    inventory: DataFrame,
    film: DataFrame,
    payment: DataFrame,
    effective: datetime,
) -> DataFrame:
    """Rental fees plus late fees minus payments up to a moment, per customer.

    A late fee is one unit per whole day beyond the film's rental duration; an open rental has
    none, and replacement costs are not charged.
    """
    terms = inventory.select("inventory_id", "film_id").join(
        film.select("film_id", "rental_rate", "rental_duration"), "film_id"
    )
    overdue = whole_days("rental_date", "return_date") - F.col("rental_duration")
    fees = (
        rental.where(F.col("rental_date") <= ntz(effective))
        .select("customer_id", "inventory_id", "rental_date", "return_date")
        .join(terms, "inventory_id")
        .groupBy("customer_id")
        .agg(
            F.sum("rental_rate").alias("rental_fees"),
            F.sum(F.greatest(overdue, F.lit(0))).alias("late_fees"),
        )
    )
    paid = (
        payment.where(F.col("payment_date") <= ntz(effective))
        .groupBy("customer_id")
        .agg(F.sum("amount").alias("payments"))
    )

    def amount(name: str):
        return F.coalesce(F.col(name), F.lit(0)).cast(TOTAL)

    balance = amount("rental_fees") + amount("late_fees") - amount("payments")
    return (
        customer.select("customer_id")
        .join(fees, "customer_id", "left")
        .join(paid, "customer_id", "left")
        .select(
            "customer_id",
            amount("rental_fees").alias("rental_fees"),
            amount("late_fees").alias("late_fees"),
            amount("payments").alias("payments"),
            balance.cast(TOTAL).alias("balance"),
        )
    )


def reward_month(as_of: date) -> tuple[date, date]:
    """First day of the calendar month three months back, and of the month after it."""
    months = as_of.year * 12 + as_of.month - 1 - 3
    return (
        date(months // 12, months % 12 + 1, 1),
        date((months + 1) // 12, (months + 1) % 12 + 1, 1),
    )


def rewards_report(
    customer: DataFrame,
    payment: DataFrame,
    as_of: date,
    min_purchases: int,
    min_amount: Decimal | int | str,
) -> DataFrame:
    """Customers with more than ``min_purchases`` payments and more than ``min_amount`` paid
    in the month three months before ``as_of``; both limits are exclusive."""
    if min_purchases == 0:
        raise ValueError("the number of purchases must be greater than 0")
    if Decimal(min_amount) == 0:
        raise ValueError("the purchased amount must be greater than 0")
    start, end = reward_month(as_of)
    # A half-open range on the raw column reaches the scan; a date() around it would not.
    winners = (
        payment.where((F.col("payment_date") >= ntz(start)) & (F.col("payment_date") < ntz(end)))
        .groupBy("customer_id")
        .agg(F.sum("amount").alias("spent"), F.count("customer_id").alias("purchases"))
        .where((F.col("spent") > decimal_literal(min_amount)) & (F.col("purchases") > min_purchases))
    )
    return customer.join(winners, "customer_id", "left_semi")
