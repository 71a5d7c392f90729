"""What the plans must and must not hold."""

from datetime import date, datetime

import fixtures as fx
import pytest

import __spark_entry__ as entry
from kinomart import session
from kinomart.functions import rental as fn
from kinomart.plans import checks, marts, pipeline
from kinomart.plans.models import DIMENSIONS, RELATIONS, Models
from kinomart.sources.tpch import TpchSources

FOLDER = "/root/testdata/sf0.001"
LAZY = [*RELATIONS, "customer_balance", "rewards_report", "dq_enum", "dq_domain", "dq_relationships",
        "refresh_diff", "upsert_stamped", "title_token_index"]


@pytest.fixture(scope="module")
def models(spark):
    return Models(TpchSources(spark, FOLDER))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, models, name):
    df = models[name] if name in RELATIONS else entry.queries()[name](spark, FOLDER)
    text = plan(df)
    for word in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "SinglePartition"):
        assert word not in text, word


def test_a_narrow_select_reads_few_columns(models):
    text = plan(models["fct_rental"].select("rental_id", "payment_amount"))
    assert "o_orderpriority" not in text and "l_extendedprice" not in text
    text = plan(models["dim_film"].select("film_id", "title"))
    assert "p_retailprice" not in text and "p_brand" not in text


def test_filters_reach_the_scan(spark, models):
    m = models
    balance = fn.customer_balance(
        m["customer"], m["rental"], m["inventory"], m["film"], m["payment"], datetime(1998, 7, 1)
    )
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThanOrEqual(o_orderdate" in plan(balance)
    refresh = entry.refresh_rentals(spark, FOLDER)
    assert "LessThan(o_orderdate" in plan(refresh)
    assert date(1998, 1, 1).isoformat() in plan(refresh)


def test_checks_of_one_relation_share_a_scan(models):
    tests = checks._row_conditions("fct_rental")
    assert len(tests) == 4 + 3 + 2
    df = checks._count_rows(models["stg_film"], "stg_film", checks._row_conditions("stg_film"))
    assert plan(df).count("FileScan") == 1


def test_each_sum_of_sales_reuses_its_joins_shuffle(models):
    text = plan(models["sales_by_store"])
    assert text.count("Exchange hashpartitioning(inventory_id") <= 2


def test_text_lists_need_one_exchange_and_no_sample(spark, models):
    text = plan(models["film_list"])
    assert "rangepartitioning" not in text and "rangepartitioning" not in plan(models["actor_info"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(Models(TpchSources(spark, FOLDER))["actor_info"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "rangepartitioning" not in text


def test_cast_lists_are_not_shuffled_again_for_the_film(spark, models):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(Models(TpchSources(spark, FOLDER))["film_list"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lists = [line for line in text.splitlines() if "Exchange" in line or "listagg(_text" in line]
    first = next(i for i, line in enumerate(lists) if "listagg(_text" in line)
    # Above the lists there is only the exchange of the films themselves.
    assert sum("Exchange" in line for line in lists[:first]) == 1


def test_stock_is_one_join(models):
    text = plan(models["inventory_in_stock"])
    assert "LeftOuter" in text
    assert "IsNull" in text or "isnull(_out" in text


def test_one_customers_balance_reads_one_customer(models):
    m = models
    balance = fn.customer_balance(
        m["customer"], m["rental"], m["inventory"], m["film"], m["payment"], datetime(1998, 7, 1)
    )
    text = plan(balance.where("customer_id = 5"))
    assert text.count("EqualTo(o_custkey,5)") == 2 and "EqualTo(c_custkey,5)" in text


def test_partitioned_marts_are_pruned(spark, tmp_path):
    models = fx.models(spark)
    by_month = {"rental_analytics": ["rental_year", "rental_month"]}
    pipeline.with_stored_dimensions(models, str(tmp_path))
    expected = models["rental_analytics"].collect()
    pipeline.store_relations(models, str(tmp_path), ["rental_analytics"], by_month)
    wide = models["rental_analytics"]
    assert sorted(map(str, wide.collect())) == sorted(map(str, expected))
    june = wide.where("rental_year = 2005 and rental_month = 6")
    assert "PartitionFilters: [isnotnull(rental_year" in plan(june) and june.count() == 6


def test_shuffles_are_sized_by_the_input(spark):
    names = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        found = []
        for size in (0, 1 << 30, 6 << 30):
            session.size_shuffles(spark, size)
            found.append(int(spark.conf.get(names[0])))
            assert spark.conf.get(names[1]) == str(session.TASK_BYTES)
        assert found == [int(spark.conf.get("spark.sql.shuffle.partitions")), 256, 1536]
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def exchanges(df) -> list[str]:
    """A plan's exchanges by hash, from the top."""
    return [line for line in plan(df).splitlines() if "Exchange hashpartitioning(" in line]


def test_lines_are_dealt_by_order_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = exchanges(TpchSources(spark, FOLDER).payment())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One for the lines, for their numbers and the join; one for the orders.
    assert len(found) == 2
    assert all("l_linenumber" not in line.split("hashpartitioning(")[1].split(")")[0] for line in found)


def test_large_dimensions_join_rentals_before_payments_multiply_them(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = Models(TpchSources(spark, FOLDER))["rental_analytics"]
        found = exchanges(wide)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Above the one with the payments there is only that of the days.
    first = [i for i, line in enumerate(found) if "_part" in line][0]
    assert ["rental_date_id" in line for line in found[:first]] == [True]
    assert any("customer_id" in line for line in found[first:]) and any("film_id" in line for line in found[first:])


def test_no_shuffle_of_the_stored_wide_table_moves_the_fact(spark, tmp_path):
    models = Models(TpchSources(spark, FOLDER))
    pipeline.with_stored_dimensions(models, str(tmp_path))
    pipeline.with_stored_fact(models, str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(models["rental_analytics"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Payments leave their lists after the joins with customers, films and stores.
    above, below = text[: text.index("Generate inline(")], text[text.index("Generate inline(") :]
    assert above.count("Exchange hashpartitioning(") == above.count("Exchange hashpartitioning(rental_date_id") == 1
    # Both sides of the three joins, and the days.
    assert below.count("Exchange hashpartitioning(") == 7 and "fct_rental" not in text


def test_marts_of_listed_payments_equal_the_joined_ones(spark, tmp_path):
    for list_rows in (1, 10_000):
        models = fx.models(spark)
        inputs = [models[name] for name in ("stg_rental", "stg_payment", "stg_inventory", "stg_film")]
        paid = marts.paid_rentals(*inputs, list_rows)
        fact = marts.fct_rental_of_paid(paid)
        wide = marts.rental_analytics_of_paid(paid, *[models[name] for name in DIMENSIONS])
        for found, name in ((fact, "fct_rental"), (wide, "rental_analytics")):
            assert found.dtypes == models[name].dtypes
            assert sorted(map(str, found.collect())) == sorted(map(str, models[name].collect()))


def test_stored_tables_are_in_the_order_of_their_keys(spark, tmp_path):
    rows = spark.range(100).selectExpr("id * 7 % 100 AS id").coalesce(1)
    stored = session.materialize(rows, f"{tmp_path}/t", sort_by=["id"])
    assert [r.id for r in stored.collect()] == list(range(100))
    assert all(f.endswith(".zstd.parquet") for f in stored.inputFiles())


def test_film_terms_and_texts_share_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = exchanges(Models(TpchSources(spark, FOLDER))["rental_analytics"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    names = [line.split("hashpartitioning(")[1].split("#")[0] for line in found]
    # From the join with the payments down to that with the items, the rentals move once by each key.
    assert names[names.index("rental_id") + 1 : names.index("inventory_id")] == ["film_id", "customer_id", "store_id"]
