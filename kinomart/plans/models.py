"""All named relations over one set of base tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from kinomart.functions import rental as fn
from kinomart.plans import marts, reports, staging

# Relation -> function and the relations it reads.
STAGING: dict[str, tuple[Callable[..., DataFrame], list[str]]] = {
    f"stg_{name}": (getattr(staging, f"stg_{name}"), [name])
    for name in (
        "address", "category", "city", "country", "customer", "film", "film_category",
        "inventory", "payment", "rental", "store",
    )
}

DIMENSIONS: dict[str, tuple[Callable[..., DataFrame], list[str]]] = {
    "dim_customer": (marts.dim_customer, ["stg_customer", "stg_address", "stg_city", "stg_country"]),
    "dim_film": (marts.dim_film, ["stg_film", "stg_film_category", "stg_category"]),
    "dim_store": (marts.dim_store, ["stg_store", "stg_address", "stg_city", "stg_country"]),
    "dim_date": (marts.dim_date, ["stg_rental", "stg_payment"]),
}

MARTS: dict[str, tuple[Callable[..., DataFrame], list[str]]] = DIMENSIONS | {
    "fct_rental": (marts.fct_rental, ["stg_rental", "stg_payment", "stg_inventory", "stg_film"]),
    "rental_analytics": (
        marts.rental_analytics_of_rentals,
        ["stg_rental", "stg_payment", "stg_inventory", "stg_film", *DIMENSIONS],
    ),
}

REPORTS: dict[str, tuple[Callable[..., DataFrame], list[str]]] = {
    "actor_info": (reports.actor_info, ["actor", "film", "category", "film_category", "film_actor"]),
    "customer_list": (reports.customer_list, ["customer", "address", "city", "country"]),
    "film_list": (reports.film_list, ["film", "category", "film_category", "film_actor", "actor"]),
    "nicer_film_list": (
        reports.nicer_film_list, ["film", "category", "film_category", "film_actor", "actor"],
    ),
    "sales_by_film_category": (
        reports.sales_by_film_category,
        ["payment", "rental", "inventory", "film", "film_category", "category"],
    ),
    "sales_by_store": (
        reports.sales_by_store,
        ["payment", "rental", "inventory", "store", "address", "city", "country", "staff"],
    ),
    "staff_list": (reports.staff_list, ["staff", "address", "city", "country"]),
}

STOCK: dict[str, tuple[Callable[..., DataFrame], list[str]]] = {
    "inventory_in_stock": (fn.inventory_in_stock, ["inventory", "rental"]),
    "film_in_stock": (fn.film_in_stock, ["inventory", "rental"]),
    "film_not_in_stock": (fn.film_not_in_stock, ["inventory", "rental"]),
    "inventory_holder": (fn.inventory_holder, ["inventory", "rental"]),
}

RELATIONS = STAGING | MARTS | REPORTS | STOCK


class Models:
    """Look up a relation by name: a base table, or a model over other relations.

    A relation is built once and stays lazy. ``put`` replaces one, say by its stored copy,
    for every model looked up afterwards.
    """

    def __init__(self, load: Callable[[str], DataFrame]):
        self._load = load
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            if name in RELATIONS:
                build, inputs = RELATIONS[name]
                self._known[name] = build(*[self[i] for i in inputs])
            else:
                self._known[name] = self._load(name)
        return self._known[name]

    def put(self, name: str, df: DataFrame) -> None:
        self._known[name] = df
