"""Customers' balances at many moments at once."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinomart.functions.columns import TOTAL, ntz, whole_days

#: Time buckets within which events are summed in order; those before a bucket are carried in as totals.
BUCKET = "MONTH"
AMOUNTS = ("rental_fees", "late_fees", "payments")


def balance_events(rental: DataFrame, inventory: DataFrame, film: DataFrame, payment: DataFrame) -> DataFrame:
    """What changes balances: (customer_id, at, rental_fees, late_fees, payments), one row per customer
    and moment. A rental's fees, late ones too, count from the rental on, as in `customer_balance`."""
    terms = inventory.select("inventory_id", "film_id").join(film.select("film_id", "rental_rate", "rental_duration"), "film_id")
    overdue = whole_days("rental_date", "return_date") - F.col("rental_duration")
    nothing = F.lit(0).cast(TOTAL)
    fees = rental.join(terms, "inventory_id").select(
        "customer_id",
        F.col("rental_date").alias("at"),
        F.coalesce("rental_rate", F.lit(0)).cast(TOTAL).alias("rental_fees"),
        F.coalesce(F.greatest(overdue, F.lit(0)), F.lit(0)).cast(TOTAL).alias("late_fees"),
        nothing.alias("payments"),
    )
    paid = payment.select(
        "customer_id", F.col("payment_date").alias("at"), nothing, nothing, F.coalesce("amount", F.lit(0)).cast(TOTAL)
    )
    both = fees.union(paid).where("customer_id IS NOT NULL AND at IS NOT NULL")
    return both.groupBy("customer_id", "at").agg(*[F.sum(a).cast(TOTAL).alias(a) for a in AMOUNTS])


def prefix_sums(events: DataFrame, wanted: DataFrame, key: str, amounts: Sequence[str], bucket: str = BUCKET) -> DataFrame:
    """For each distinct row (key, as_of) of `wanted` the sums of the key's events up to that moment, it
    included; 0 without any. `events` has key, at, and the amounts as decimals.

    Sums are made on two levels. Events are added up by key and time bucket, and a key's buckets, a row
    each, are summed in their order. Within a bucket, events and wanted moments are sorted together, by
    key and bucket: a key with a third of all events is dealt to as many tasks as it has buckets.
    """

    def bucketed(at: str) -> Column:
        return F.date_trunc(bucket, at).cast("timestamp_ntz").alias("bucket")

    asked = wanted.where(F.col(key).isNotNull() & F.col("as_of").isNotNull()).select(key, "as_of").distinct()
    zeros = [F.lit(0).cast(TOTAL).alias(a) for a in amounts]
    placed = events.select(key, bucketed("at"), "at", *amounts)
    moments = asked.select(key, bucketed("as_of"), F.col("as_of").alias("at"), *zeros)

    totals = placed.drop("at").union(moments.drop("at")).groupBy(key, "bucket").agg(*[F.sum(a).cast(TOTAL).alias(a) for a in amounts])
    earlier = Window.partitionBy(key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(key, "bucket", *[F.coalesce(F.sum(a).over(earlier), F.lit(0)).cast(TOTAL).alias(f"_{a}") for a in amounts])

    rows = placed.withColumn("asked", F.lit(False)).union(moments.withColumn("asked", F.lit(True)))
    # The frame takes in all events of the same moment.
    inside = Window.partitionBy(key, "bucket").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    running = rows.select(key, "bucket", "at", "asked", *[F.sum(a).over(inside).cast(TOTAL).alias(a) for a in amounts]).where("asked")
    return running.join(carried, [key, "bucket"]).select(
        key, F.col("at").alias("as_of"), *[(F.col(a) + F.col(f"_{a}")).cast(TOTAL).alias(a) for a in amounts]
    )


def customer_balances(
    customer: DataFrame,
    rental: DataFrame,
    inventory: DataFrame,
    film: DataFrame,
    payment: DataFrame,
    moments: Sequence[datetime] | DataFrame,
) -> DataFrame:
    """`customer_balance` at several moments: (customer_id, as_of, rental_fees, late_fees, payments,
    balance), for every customer at each of a list of moments, or for the rows (customer_id, as_of)
    of a table whose customers exist."""
    known = customer.select("customer_id")
    if isinstance(moments, DataFrame):
        wanted = moments.select("customer_id", "as_of").join(known, "customer_id", "left_semi")
    else:
        wanted = known.select("customer_id", F.explode(F.array(*[ntz(m) for m in moments])).alias("as_of"))
    sums = prefix_sums(balance_events(rental, inventory, film, payment), wanted, "customer_id", AMOUNTS)
    balance = F.col("rental_fees") + F.col("late_fees") - F.col("payments")
    return sums.withColumn("balance", balance.cast(TOTAL))
