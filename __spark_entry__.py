"""Entry points for running and checking the jobs on the given tables."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import oracles
from kinomart.functions import balances
from kinomart.functions import rental as fn
from kinomart.functions.columns import last_day, ntz
from kinomart.operators import check_state, digest_tree, history
from kinomart.operators import quality as q
from kinomart.operators.aggregates import assemble, list_pieces
from kinomart.operators.refresh import refresh_diff, upsert_stamped
from kinomart.operators.text_index import phrase_search, token_index
from kinomart.plans import checks, pipeline
from kinomart.plans.deltas import MaintainedMarts
from kinomart.plans.models import MARTS, RELATIONS, STAGING, Models
from kinomart.session import materialize, size_shuffles, work_folder
from kinomart.sources import tables
from kinomart.sources.schemas import SCHEMAS
from kinomart.sources.text import NULL_MARK, read_dump
from kinomart.sources.tpch import TpchSources

Query = Callable[[SparkSession, str], DataFrame]

# The training-data operators may be left out; everything else works without them.
HAS_LLM = importlib.util.find_spec("kinomart.llm") is not None
if HAS_LLM:
    import corpus_pipeline
    from kinomart.llm import oracles as llm_oracles
    from kinomart.llm import queries as llm_queries


def _sources(spark: SparkSession, folder: str) -> TpchSources:
    sources = TpchSources(spark, folder)
    size_shuffles(spark, sources.bytes())
    return sources


def _models(spark: SparkSession, folder: str) -> Models:
    return Models(_sources(spark, folder))


def _relation(name: str) -> Query:
    return lambda spark, folder: _models(spark, folder)[name]


def rental_analytics(spark: SparkSession, folder: str) -> DataFrame:
    """The dimensions are stored first, so that the joins know their true sizes."""
    models = pipeline.with_stored_dimensions(_models(spark, folder), work_folder(spark))
    return models["rental_analytics"]


def customer_balance(spark: SparkSession, folder: str) -> DataFrame:
    m = _models(spark, folder)
    return fn.customer_balance(
        m["customer"], m["rental"], m["inventory"], m["film"], m["payment"], datetime(1998, 7, 1)
    )


def rewards_report(spark: SparkSession, folder: str) -> DataFrame:
    m = _models(spark, folder)
    return fn.rewards_report(m["customer"], m["payment"], date(1998, 7, 15), 1, "5.00")


def last_day_of_month(spark: SparkSession, folder: str) -> DataFrame:
    return _models(spark, folder)["rental"].select(
        "rental_id", "rental_date", last_day("rental_date").alias("month_end")
    )


def mart_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    place = work_folder(spark)
    models = pipeline.with_stored_dimensions(_models(spark, folder), place)
    pipeline.with_stored_fact(models, place)
    return reduce(
        DataFrame.union,
        [
            models[name].agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("relation"), "n_rows")
            for name in STAGING | MARTS
        ],
    )


def copy_text_film(spark: SparkSession, folder: str) -> DataFrame:
    """Films written as dump text and loaded back with the declared schema."""
    film = _models(spark, folder)["film"]
    path = f"{work_folder(spark)}/film"
    missing = F.lit(None).cast("string")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in film.columns]
    fields += [F.coalesce(missing, F.lit(NULL_MARK)), F.lit("")]
    film.select(F.concat_ws("\t", *fields)).write.text(path)
    return read_dump(spark, "film", path).drop("special_features", "fulltext")


def ingested_customer_list(spark: SparkSession, folder: str) -> DataFrame:
    return tables.ingest_names(_models(spark, folder)["customer_list"])


def _fact_check(check: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: check(_models(spark, folder)["fct_rental"])


def dq_relationships(spark: SparkSession, folder: str) -> DataFrame:
    """The declared references, and the undeclared one from customers to stores."""
    m = _models(spark, folder)
    references = {
        "stg_rental": {"customer_id": (m["stg_customer"], "customer_id")},
        "stg_payment": {"customer_id": (m["stg_customer"], "customer_id")},
        "stg_inventory": {"film_id": (m["stg_film"], "film_id")},
        "stg_customer": {"store_id": (m["stg_store"], "store_id")},
        "fct_rental": {
            "customer_id": (m["dim_customer"], "customer_id"),
            "film_id": (m["dim_film"], "film_id"),
            "store_id": (m["dim_store"], "store_id"),
        },
    }
    return reduce(
        DataFrame.union,
        [
            q.orphan_keys(m[child], parents).select(
                F.lit(child).alias("relation"), "column", "value", "n_records"
            )
            for child, parents in references.items()
        ],
    )


def dq_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    """The declared lists, and a narrower one for ratings."""
    models = pipeline.with_stored_dimensions(_models(spark, folder), work_folder(spark))
    lists = {
        "dim_film": checks.ACCEPTED["dim_film"],
        "rental_analytics": checks.ACCEPTED["rental_analytics"] | {"film_rating": ("G", "PG", "PG-13")},
    }
    return reduce(
        DataFrame.union,
        [
            q.unexpected_values(models[r], accepted).select(
                F.lit(r).alias("relation"), "column", "value", "n_records"
            )
            for r, accepted in lists.items()
        ],
    )


def dq_singular_orphans(spark: SparkSession, folder: str) -> DataFrame:
    m = _models(spark, folder)
    return q.orphan_rentals(m["fct_rental"], m["dim_customer"])


def dq_singular_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return q.revenue_mismatches(rental_analytics(spark, folder))


def _plain_audit(audit: Callable[[Models], DataFrame]) -> Query:
    return lambda spark, folder: audit(_models(spark, folder))


def dq_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The full build, and its report of the declared checks."""
    return pipeline.build(spark, _sources(spark, folder), work_folder(spark), report=checks.summary)[1]


def dq_unique_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Customers' payments of one day and amount, by fingerprints first."""
    return q.not_unique_wide(_models(spark, folder)["payment"], "rental_id", "customer_id", "payment_date", "amount")


def dq_orphans_found(spark: SparkSession, folder: str) -> DataFrame:
    """The check for orphans against customers of which some are gone."""
    m = _models(spark, folder)
    return q.orphan_rentals(m["fct_rental"], m["dim_customer"].where(F.col("customer_id") % 50 != 7))


def dq_negatives_found(spark: SparkSession, folder: str) -> DataFrame:
    """The check for negative payments over a fact with refunds."""
    refund = F.when(F.col("payment_id") % 97 == 5, -F.col("payment_amount")).otherwise(F.col("payment_amount"))
    return q.negative_payments(_models(spark, folder)["fct_rental"].withColumn("payment_amount", refund.cast("decimal(12,2)")))


def dq_mismatches_found(spark: SparkSession, folder: str) -> DataFrame:
    """The check of the total over a wide table in which some totals are off, others by a cent only."""
    off = F.when(F.col("rental_id") % 97 == 3, F.lit("0.02")).when(F.col("rental_id") % 97 == 4, F.lit("0.01")).otherwise(F.lit("0"))
    wide = rental_analytics(spark, folder)
    return q.revenue_mismatches(wide.withColumn("total_revenue", (F.col("total_revenue") + off.cast("decimal(3,2)")).cast("decimal(12,2)")))


def loaded_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Stored films without some columns, and with missing ratings, loaded with the columns' defaults."""
    place = work_folder(spark)
    film = _models(spark, folder)["film"].drop("last_update", "rental_rate")
    materialize(film.withColumn("rating", F.nullif("rating", F.lit("NR"))), f"{place}/film")
    load = tables.loader(spark, "parquet", place, defaults=True, loaded_at="2020-01-01 00:00:00")
    return load("film").select("film_id", "rental_duration", "rental_rate", "replacement_cost", "rating", "last_update")


def defaults_now(spark: SparkSession, folder: str) -> DataFrame:
    """Films whose time of load defaults to the moment of the query."""
    film = tables.with_defaults(_models(spark, folder)["film"].drop("last_update"), "film")
    age = F.localtimestamp() - F.col("last_update")
    return film.select("film_id", (age < F.expr("INTERVAL 1 DAY")).alias("is_recent"))


def sql_group_concat(spark: SparkSession, folder: str) -> DataFrame:
    """The aggregate in SQL: titles, and distinct ratings, of each category."""
    from kinomart.functions.sql import register_group_concat

    m = _models(spark, folder)
    register_group_concat(spark)
    films = m["film"].join(m["film_category"].select("film_id", "category_id"), "film_id")
    return spark.sql(
        """SELECT category_id, group_concat(title, ', ') WITHIN GROUP (ORDER BY title) AS titles,
                  group_concat(DISTINCT rating, ', ') WITHIN GROUP (ORDER BY rating) AS ratings
           FROM {films} GROUP BY category_id""",
        films=films,
    )


def base_changes(spark: SparkSession, folder: str) -> DataFrame:
    """What the base tables' refresh changes over an earlier build's, table by table."""
    place = work_folder(spark)
    pipeline.store_relations(Models(_earlier_tables(spark, folder)), place, SCHEMAS)
    return pipeline.changes(spark, TpchSources(spark, folder), place)


def long_lists(spark: SparkSession, folder: str) -> DataFrame:
    """The days of all payments of an amount as ordered lists in pieces: each day with its first place."""
    paid = _models(spark, folder)["payment"].select("amount", F.col("payment_date").cast("string").alias("day"))
    pieces = list_pieces(paid, ["amount"], "day", piece_rows=1000)
    rows = pieces.select("amount", "piece", F.posexplode("texts").alias("place", "t"))
    before = F.sum("t._n").over(Window.partitionBy("amount", "piece").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    totals = pieces.select("amount", "piece", F.coalesce(
        F.sum("n_texts").over(Window.partitionBy("amount").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    ).alias("carried"))
    placed = rows.withColumn("before", F.coalesce(before, F.lit(0))).join(totals, ["amount", "piece"])
    return placed.select("amount", F.col("t._text").alias("day"), F.col("t._n").alias("n_texts"), (F.col("carried") + F.col("before") + 1).alias("first_place"))


def category_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Each category's titles, put together from pieces."""
    m = _models(spark, folder)
    films = m["film"].join(m["film_category"].select("film_id", "category_id"), "film_id")
    return assemble(list_pieces(films, ["category_id"], "title", piece_rows=50), ["category_id"], "titles")


PHRASES = ("small ring", "Brand 2 red", "economy brand 17", "gear", "hot hot", "brand", "ring small", "nowhere at all", "...")


def phrase_hits(spark: SparkSession, folder: str) -> DataFrame:
    """Where phrases begin in the films' descriptions and titles."""
    index = token_index(_models(spark, folder)["film"], "film_id", ["description", "title"], left_out=[""])
    return phrase_search(index, "film_id", PHRASES)


def _rentals_as_of(rental: DataFrame, moment: date) -> DataFrame:
    """The rental table as it looked at a moment: later rentals and returns are unknown."""
    known = F.col("return_date") < ntz(moment)
    return rental.where(F.col("rental_date") < ntz(moment)).withColumn(
        "return_date", F.when(known, F.col("return_date"))
    )


def refresh_rentals(spark: SparkSession, folder: str) -> DataFrame:
    """What changed in the whole rental table since an earlier refresh."""
    rental = _models(spark, folder)["rental"]
    return refresh_diff(_rentals_as_of(rental, date(1998, 1, 1)), rental, ["rental_id"])


def upsert_rentals(spark: SparkSession, folder: str) -> DataFrame:
    """All rentals and returns since an earlier state applied to it."""
    rental = _models(spark, folder)["rental"]
    start = ntz(date(1998, 1, 1))
    updates = rental.where((F.col("rental_date") >= start) | (F.col("return_date") >= start))
    return upsert_stamped(
        _rentals_as_of(rental, date(1998, 1, 1)), updates, ["rental_id"], ntz(date(1999, 1, 1))
    )


#: Rows of a leaf of stored refreshes, so that the given tables have several.
LEAF_ROWS = 5_000
EARLIER = date(1998, 1, 1)


def refresh_tree_diff(spark: SparkSession, folder: str) -> DataFrame:
    """What `refresh_diff` says, from the digest trees of two stored refreshes."""
    rental, place = _models(spark, folder)["rental"], work_folder(spark)
    old = digest_tree.store_refresh(_rentals_as_of(rental, EARLIER), ["rental_id"], f"{place}/old", leaf_rows=LEAF_ROWS)
    new = digest_tree.store_refresh(rental, ["rental_id"], f"{place}/new", old)
    return digest_tree.tree_diff(old, new)


def changed_payments(spark: SparkSession, folder: str) -> DataFrame:
    """The payments of two stored refreshes that differ: the later ones have other amounts for some
    orders, lack the payments of others, and have new ones."""
    payment, place = _models(spark, folder)["payment"], work_folder(spark)
    order = F.col("rental_id") % 1000
    before = payment.where(order != 3).select(
        *[F.when(order == 1, F.col(c) + 1).otherwise(F.col(c)).cast("decimal(6,2)").alias(c) if c == "amount" else c for c in payment.columns]
    )
    after = payment.where(order != 2).withColumn("amount", F.col("amount").cast("decimal(6,2)"))
    old = digest_tree.store_refresh(before, ["payment_id"], f"{place}/old", leaf_rows=LEAF_ROWS)
    new = digest_tree.store_refresh(after, ["payment_id"], f"{place}/new", old)
    return digest_tree.changed_rows(old, new).select(
        "payment_id", F.col("old.amount").alias("old_amount"), F.col("new.amount").alias("new_amount")
    )


#: Moments of refreshes in the order in which they arrive: one is late, and comes twice.
REFRESHES = tuple(datetime(y, 1, 1) for y in (1995, 1997, 1998, 1996, 1996))


def _rental_history(spark: SparkSession, folder: str) -> DataFrame:
    rental, place = _models(spark, folder)["rental"], work_folder(spark)
    known = history.start(_rentals_as_of(rental, REFRESHES[0]), ["rental_id"], REFRESHES[0])
    for i, moment in enumerate(REFRESHES[1:], 1):
        # Stored after each refresh, as it would be: the next one starts from the table.
        known = materialize(known, f"{place}/{i}")
        known = history.apply_refresh(known, _rentals_as_of(rental, moment), ["rental_id"], moment, REFRESHES[:i])
    return known


def row_history(spark: SparkSession, folder: str) -> DataFrame:
    """From when to when each rental looked how, by refreshes that arrive in any order."""
    return _rental_history(spark, folder).select("rental_id", "return_date", "valid_from", "valid_to")


def row_history_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """The rentals as they were at the moment of the late refresh."""
    return history.as_of(_rental_history(spark, folder), datetime(1996, 1, 1))


#: The ends of 1994's to 1998's half years.
BALANCE_DAYS = tuple(datetime(y, m, 1) for y in range(1994, 1999) for m in (1, 7))


def customer_balances(spark: SparkSession, folder: str) -> DataFrame:
    m = _models(spark, folder)
    return balances.customer_balances(m["customer"], m["rental"], m["inventory"], m["film"], m["payment"], BALANCE_DAYS)


def _earlier_tables(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """The base tables of an earlier refresh: later rentals, returns and payments are missing, some items,
    too, and some films and customers differ."""
    load = _sources(spark, folder)

    def earlier(name: str) -> DataFrame:
        df = load(name)
        if name == "rental":
            return _rentals_as_of(df, EARLIER)
        if name == "payment":
            return df.where(F.col("payment_date") < ntz(EARLIER))
        if name == "inventory":
            return df.where(F.col("film_id") % 50 != 1)
        if name == "film":
            rate = F.when(F.col("film_id") % 50 == 2, F.col("rental_rate") + 1).otherwise(F.col("rental_rate"))
            return df.withColumn("rental_rate", rate.cast("decimal(4,2)"))
        if name == "customer":
            return df.withColumn("email", F.when(F.col("customer_id") % 50 != 3, F.col("email"))).where("customer_id % 50 != 4")
        return df

    return earlier


def _maintained(spark: SparkSession, folder: str) -> MaintainedMarts:
    kept = MaintainedMarts(spark, work_folder(spark), LEAF_ROWS)
    kept.build(_earlier_tables(spark, folder))
    kept.refresh(TpchSources(spark, folder))
    return kept


def maintained_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The fact of an earlier refresh after the changes since."""
    return _maintained(spark, folder)["fct_rental"]


def maintained_analytics(spark: SparkSession, folder: str) -> DataFrame:
    """The wide table of an earlier refresh after the changes since."""
    return _maintained(spark, folder)["rental_analytics"]


def dq_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The fact's declared checks: states of an earlier refresh, those of changed leaves made anew."""
    place = work_folder(spark)
    earlier, now = Models(_earlier_tables(spark, folder)), _models(spark, folder)
    old = digest_tree.store_refresh(earlier["fct_rental"], ["rental_id"], f"{place}/old", leaf_rows=LEAF_ROWS)
    new = digest_tree.store_refresh(now["fct_rental"], ["rental_id"], f"{place}/new", old)
    declared = checks.of_relation(now, "fct_rental")
    check_state.update_states(old, declared, None, f"{place}/states-old")
    check_state.update_states(new, declared, f"{place}/states-old", f"{place}/states-new")
    return check_state.report(new, declared, f"{place}/states-new")


def full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The stored rental table of an earlier refresh, overwritten by the current one; of the tables
    found at the source, one without any key is left out."""
    rental = _models(spark, folder)["rental"]
    place = work_folder(spark)
    database = f"refresh_{place[-12:]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{place}'")
    for state in (_rentals_as_of(rental, date(1998, 1, 1)), rental):
        found = {"rental_copy": state, "rental_view": state}
        tables.replicate(found.__getitem__, found, database, {"rental_copy": ("rental_id",)})
    if list(tables.discover(spark, database)) != ["rental_copy"]:
        raise ValueError("a relation without key was copied")
    return spark.table(f"{database}.rental_copy")


def staged_views(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and distinct first columns of the staging views, by SQL."""
    models = _models(spark, folder)
    pipeline.register_views(models)
    return reduce(
        DataFrame.union,
        [
            spark.sql(
                f"SELECT '{name}' AS relation, count(*) AS n_rows,"
                f" count(DISTINCT {models[name].columns[0]}) AS n_keys FROM {name}"
            )
            for name in STAGING
        ],
    )


def stored_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Rentals and inventory written as files and loaded back with the declared keys."""
    models, place = _models(spark, folder), work_folder(spark)
    items = models["inventory"].select(
        F.xxhash64("inventory_id").alias("inventory_id"), F.col("film_id").cast("int"), "store_id", "last_update"
    )
    rentals = models["rental"].withColumn("inventory_id", F.xxhash64("inventory_id"))
    materialize(items, f"{place}/inventory")
    materialize(rentals, f"{place}/rental")
    load = tables.loader(spark, "parquet", place)
    return load("rental").join(load("inventory"), "inventory_id", "left").select(
        "rental_id", "customer_id", "film_id", "store_id"
    )


def column_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Films without rating and load time, filled with the columns' defaults."""
    film = _models(spark, folder)["film"].drop("last_update")
    unrated = film.withColumn("rating", F.nullif("rating", F.lit("NR")))
    return tables.with_defaults(unrated, "film", "2020-01-01 00:00:00").select(
        "film_id", "rental_duration", "rental_rate", "replacement_cost", "rating", "last_update"
    )


def title_token_index(spark: SparkSession, folder: str) -> DataFrame:
    index = token_index(_models(spark, folder)["film"], "film_id", ["title", "description"])
    return index.withColumn("positions", F.concat_ws(",", F.col("positions").cast("array<string>")))


def entry(spark: SparkSession) -> DataFrame:
    return rental_analytics(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    named: dict[str, Query] = {name: _relation(name) for name in RELATIONS}
    named |= {
        "rental_analytics": rental_analytics,
        "customer_balance": customer_balance,
        "rewards_report": rewards_report,
        "last_day_of_month": last_day_of_month,
        "mart_row_counts": mart_row_counts,
        "copy_text_film": copy_text_film,
        "ingested_customer_list": ingested_customer_list,
        "dq_unique": _fact_check(lambda f: q.not_unique(f, "rental_id")),
        "dq_not_null": _fact_check(lambda f: q.null_rows(f, "film_id").select("rental_id", "customer_id")),
        "dq_relationships": dq_relationships,
        "dq_accepted_values": dq_accepted_values,
        "dq_accepted_range": _fact_check(
            lambda f: q.out_of_range_rows(f, "rental_duration_days", 0).select(
                "rental_id", "payment_id", "rental_duration_days"
            )
        ),
        "dq_singular_orphans": dq_singular_orphans,
        "dq_singular_negative_payment": _fact_check(q.negative_payments),
        "dq_singular_return_before_rental": _fact_check(q.returned_before_rented),
        "dq_singular_revenue": dq_singular_revenue,
        "dq_primary_key": _plain_audit(checks.primary_keys),
        "dq_foreign_key": _plain_audit(checks.foreign_keys),
        "dq_unique_index": _plain_audit(checks.unique_indexes),
        "dq_enum": _plain_audit(lambda m: checks.rating_enum(m).drop("column")),
        "dq_domain": _plain_audit(checks.release_year_domain),
        "dq_summary": dq_summary,
        "refresh_diff": refresh_rentals,
        "upsert_stamped": upsert_rentals,
        "title_token_index": title_token_index,
        "dq_unique_wide": dq_unique_wide,
        "dq_orphans_found": dq_orphans_found,
        "dq_negatives_found": dq_negatives_found,
        "dq_mismatches_found": dq_mismatches_found,
        "loaded_defaults": loaded_defaults,
        "defaults_now": defaults_now,
        "sql_group_concat": sql_group_concat,
        "base_changes": base_changes,
        "long_lists": long_lists,
        "category_titles": category_titles,
        "phrase_hits": phrase_hits,
        "refresh_tree_diff": refresh_tree_diff,
        "changed_payments": changed_payments,
        "row_history": row_history,
        "row_history_as_of": row_history_as_of,
        "customer_balances": customer_balances,
        "maintained_fact": maintained_fact,
        "maintained_analytics": maintained_analytics,
        "dq_merged": dq_merged,
        "full_refresh": full_refresh,
        "staged_views": staged_views,
        "stored_keys": stored_keys,
        "column_defaults": column_defaults,
    }
    if HAS_LLM:
        named |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return named


def oracle_sql() -> dict[str, str]:
    named = oracles.oracle_sql()
    if HAS_LLM:
        named |= llm_oracles.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            named["pipeline"] = corpus_pipeline.ORACLE_SQL
    return named
