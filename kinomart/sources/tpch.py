"""The fifteen base tables derived from an order-and-line-item schema.

An order is a rental, a line number of an order a payment, a part a film, a supplier a
store, its manager and an actor. Keys are computed, never ranked, so no step needs an
order over a whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinomart.session import folder_bytes, folder_exists
from kinomart.sources.schemas import RATINGS

_DDL = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}

LOADED = "2006-02-15 10:00:00"


def _loaded() -> Column:
    return F.lit(LOADED).cast("timestamp_ntz").alias("last_update")


def _inventory_id() -> Column:
    # Both keys may take all of a bigint: 19 digits are left for the supplier.
    return F.expr("cast(l_partkey AS decimal(19,0)) * 10000000000000000000BD + l_suppkey").cast("decimal(38,0)")


def _category_id() -> Column:
    return F.conv(F.substring(F.md5("p_type"), 1, 12), 16, 10).cast("bigint")


def _name_part(column: str, index: int) -> Column:
    return F.split(column, "#")[index]


class TpchSources:
    """Call with the name of a base table to get it as a lazy DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __call__(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def bytes(self) -> int:
        """Bytes of the tables' files."""
        paths = [f"{self.folder}/{name}.parquet" for name in _DDL]
        return sum(folder_bytes(self.spark, p) for p in paths if folder_exists(self.spark, p))

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(_DDL[name]).parquet(f"{self.folder}/{name}.parquet")

    def rental(self) -> DataFrame:
        lines = self._read("lineitem").groupBy("l_orderkey").agg(
            F.max(_inventory_id()).alias("inventory_id"),
            F.max("l_shipdate").alias("shipped"),
            F.max("l_suppkey").alias("staff_id"),
        )
        orders = self._read("orders")
        return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select(
            F.col("o_orderkey").alias("rental_id"),
            F.col("o_orderdate").alias("rental_date"),
            "inventory_id",
            F.col("o_custkey").alias("customer_id"),
            F.when(F.col("o_orderstatus") != "O", F.col("shipped")).alias("return_date"),
            "staff_id",
            F.col("o_orderdate").alias("last_update"),
        )

    def payment(self) -> DataFrame:
        """Each line is a payment. Lines that share order and line number are counted through; an
        order's lines are few, and those that are alike in all of these columns change places. Lines are
        dealt by order once, for the numbers and for the join with the orders."""
        nth = F.row_number().over(
            Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_shipdate", "l_suppkey")
        )
        lines = self._read("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey")
        lines = lines.repartition("l_orderkey").withColumn("nth", nth)
        orders = self._read("orders").select("o_orderkey", "o_custkey")
        payment_id = "cast(l_orderkey AS decimal(19,0)) * 1000000000000000000BD + l_linenumber * 1000000000BD + nth"
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
            F.expr(payment_id).cast("decimal(38,0)").alias("payment_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_suppkey").alias("staff_id"),
            F.col("l_orderkey").alias("rental_id"),
            F.expr("cast(l_linenumber * 0.99 as decimal(5,2))").alias("amount"),
            F.col("l_shipdate").alias("payment_date"),
        )

    def _pairs(self) -> DataFrame:
        return self._read("lineitem").select("l_partkey", "l_suppkey").distinct()

    def inventory(self) -> DataFrame:
        return self._pairs().select(
            _inventory_id().alias("inventory_id"),
            F.col("l_partkey").alias("film_id"),
            F.col("l_suppkey").alias("store_id"),
            _loaded(),
        )

    def film_actor(self) -> DataFrame:
        return self._pairs().select(
            F.col("l_suppkey").alias("actor_id"), F.col("l_partkey").alias("film_id"), _loaded()
        )

    def film(self) -> DataFrame:
        ratings = F.array(*[F.lit(r) for r in RATINGS])
        return self._read("part").select(
            F.col("p_partkey").alias("film_id"),
            F.col("p_name").alias("title"),
            F.concat_ws(" ", "p_type", "p_brand", "p_name").alias("description"),
            (F.col("p_size") + 1890).alias("release_year"),
            F.lit(1).alias("language_id"),
            (F.col("p_size") % 7 + 1).alias("rental_duration"),
            F.expr("cast((p_partkey % 7) * 0.99 as decimal(4,2))").alias("rental_rate"),
            F.when(F.col("p_size") != 50, F.col("p_size") * 4).alias("length"),
            F.expr("cast(floor(p_retailprice / 10) + 0.99 as decimal(5,2))").alias("replacement_cost"),
            F.when(F.col("p_size") == 13, F.lit("NR"))
            .otherwise(F.get(ratings, F.col("p_partkey") % 5))
            .alias("rating"),
            _loaded(),
        )

    def category(self) -> DataFrame:
        return (
            self._read("part").select("p_type").distinct()
            .select(_category_id().alias("category_id"), F.col("p_type").alias("name"), _loaded())
        )

    def film_category(self) -> DataFrame:
        return self._read("part").select(
            F.col("p_partkey").alias("film_id"), _category_id().alias("category_id"), _loaded()
        )

    def customer(self) -> DataFrame:
        active = F.col("c_acctbal") >= 0
        return self._read("customer").select(
            F.col("c_custkey").alias("customer_id"),
            (F.col("c_custkey") * 7 % 128).alias("store_id"),
            _name_part("c_name", 0).alias("first_name"),
            _name_part("c_name", 1).alias("last_name"),
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.org")).alias("email"),
            (F.col("c_custkey") * 2).alias("address_id"),
            active.alias("activebool"),
            F.lit("2006-02-14").cast("date").alias("create_date"),
            _loaded(),
            active.cast("int").alias("active"),
        )

    def staff(self) -> DataFrame:
        return self._read("supplier").select(
            F.col("s_suppkey").alias("staff_id"),
            _name_part("s_name", 0).alias("first_name"),
            _name_part("s_name", 1).alias("last_name"),
            (F.col("s_suppkey") * 2 + 1).alias("address_id"),
            F.concat(F.lower(F.replace("s_name", F.lit("#"), F.lit("."))), F.lit("@example.org")).alias("email"),
            F.col("s_suppkey").alias("store_id"),
            (F.col("s_acctbal") >= 0).alias("active"),
            F.lower(F.col("s_name")).alias("username"),
            _loaded(),
        )

    def store(self) -> DataFrame:
        return self._read("supplier").select(
            F.col("s_suppkey").alias("store_id"),
            F.col("s_suppkey").alias("manager_staff_id"),
            (F.col("s_suppkey") * 2 + 1).alias("address_id"),
            _loaded(),
        )

    def actor(self) -> DataFrame:
        return self._read("supplier").select(
            F.col("s_suppkey").alias("actor_id"),
            _name_part("s_name", 0).alias("first_name"),
            _name_part("s_name", 1).alias("last_name"),
            _loaded(),
        )

    def address(self) -> DataFrame:
        def rows(name: str, key: Column, tail: int, nation: str, district: Column) -> DataFrame:
            number = key.cast("string")
            return self._read(name).select(
                (key * 2 + tail).alias("address_id"),
                F.concat(number, F.lit(" Main Street")).alias("address"),
                F.lit(None).cast("string").alias("address2"),
                district.alias("district"),
                F.col(nation).alias("city_id"),
                F.when(key % 10 != 0, F.concat(F.lit("Z"), number)).alias("postal_code"),
                F.concat(F.lit("555-"), number).alias("phone"),
                _loaded(),
            )

        return rows("customer", F.col("c_custkey"), 0, "c_nationkey", F.col("c_mktsegment")).union(
            rows("supplier", F.col("s_suppkey"), 1, "s_nationkey", F.lit("SUPPLIER"))
        )

    def city(self) -> DataFrame:
        return self._read("nation").select(
            F.col("n_nationkey").alias("city_id"),
            F.col("n_name").alias("city"),
            F.col("n_regionkey").alias("country_id"),
            _loaded(),
        )

    def country(self) -> DataFrame:
        return self._read("region").select(
            F.col("r_regionkey").alias("country_id"), F.col("r_name").alias("country"), _loaded()
        )

    def language(self) -> DataFrame:
        return self.spark.range(1).select(
            F.lit(1).alias("language_id"), F.lit("English").alias("name"), _loaded()
        )
