"""The database's functions for SQL users, over views of the base tables.

They take one key at a time but are expanded into the calling query, so a call for every
row of a table becomes a join or an aggregation. ``kinomart.functions.rental`` holds the
same as jobs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from kinomart.plans.models import REPORTS, STAGING, Models
from kinomart.sources.schemas import SCHEMAS

# The database's own names of two relations.
VIEW_NAMES = {"nicer_film_list": "nicer_but_slower_film_list"}

_STOCK = """(p_film_id BIGINT, p_store_id BIGINT) RETURNS TABLE (p_film_count BIGINT)
    RETURN SELECT inventory_id FROM inventory LEFT {join} JOIN rental
        ON rental.inventory_id = inventory.inventory_id AND rental.return_date IS NULL
        WHERE film_id = p_film_id AND store_id = p_store_id"""

FUNCTIONS = {
    # An item the inventory does not know counts as in stock, whatever its rentals say.
    "inventory_in_stock": """(p_inventory_id {item}) RETURNS BOOLEAN
        RETURN (SELECT count(*) FROM rental JOIN inventory USING (inventory_id)
                WHERE return_date IS NULL AND inventory_id = p_inventory_id) = 0""",
    "inventory_held_by_customer": """(p_inventory_id {item}) RETURNS BIGINT
        RETURN (SELECT min(customer_id) FROM rental
                WHERE return_date IS NULL AND inventory_id = p_inventory_id)""",
    "film_in_stock": _STOCK.format(join="ANTI"),
    "film_not_in_stock": _STOCK.format(join="SEMI"),
    "get_customer_balance": """(p_customer_id BIGINT, p_effective_date TIMESTAMP_NTZ)
        RETURNS DECIMAL(20,2)
        RETURN coalesce((
            SELECT sum(rental_rate) + sum(greatest(
                extract(DAY FROM return_date - rental_date) - rental_duration, 0))
            FROM rental JOIN inventory USING (inventory_id) JOIN film USING (film_id)
            WHERE customer_id = p_customer_id AND rental_date <= p_effective_date), 0)
        - coalesce((
            SELECT sum(amount) FROM payment
            WHERE customer_id = p_customer_id AND payment_date <= p_effective_date), 0)""",
    "rewards_report": """(min_monthly_purchases INT, min_dollar_amount_purchased DECIMAL(10,2))
        RETURNS TABLE ({customer})
        RETURN SELECT {names} FROM customer LEFT SEMI JOIN (
            SELECT customer_id FROM payment
            WHERE payment_date >= trunc(add_months(current_date(), -3), 'MM')
              AND payment_date < trunc(add_months(current_date(), -2), 'MM')
            GROUP BY customer_id
            HAVING sum(amount) > min_dollar_amount_purchased
               AND count(customer_id) > min_monthly_purchases) USING (customer_id)
        WHERE assert_true(min_monthly_purchases <> 0 AND min_dollar_amount_purchased <> 0,
            'both limits of rewards_report must be greater than 0') IS NULL""",
}


def register_group_concat(spark: SparkSession) -> None:
    """The aggregate under its name in the source database: ``group_concat(text, ', ') WITHIN GROUP
    (ORDER BY text)``, also with DISTINCT. SQL functions cannot hold aggregates, so it is a second
    name of the session's ``listagg``; NULLs are skipped, a group of NULLs gives NULL."""
    functions = spark._jsparkSession.sessionState().functionRegistry()
    identifier = spark._jvm.org.apache.spark.sql.catalyst.FunctionIdentifier
    known = identifier("listagg")
    functions.registerFunction(
        identifier("group_concat"), functions.lookupFunction(known).get(), functions.lookupFunctionBuilder(known).get()
    )


def register(spark: SparkSession, models: Models, relations: Iterable[str] | None = None) -> None:
    """Views of all base tables, staging models and reports, and the functions over them."""
    for name in relations or [*SCHEMAS, *STAGING, *REPORTS]:
        models[name].createOrReplaceTempView(VIEW_NAMES.get(name, name))
    customer = models["customer"]
    columns = {
        "customer": ", ".join(f"{name} {dtype}" for name, dtype in customer.dtypes),
        "names": ", ".join(customer.columns),
        "item": dict(models["inventory"].dtypes)["inventory_id"],
    }
    register_group_concat(spark)
    for name, body in FUNCTIONS.items():
        text = body.format(**columns)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{text}")
