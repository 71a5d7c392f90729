"""Table sources and sinks: parquet, catalog, JDBC, full-refresh replication."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kinomart.session import THREADS
from kinomart.sources.schemas import DEFAULTS, INGEST_NAMES, PRIMARY_KEYS, SCHEMAS, STAMPED
from kinomart.sources.text import read_dump
from kinomart.sources.tpch import TpchSources


def declared(df: DataFrame, table: str) -> DataFrame:
    """The table's declared columns in their declared types, a missing one as NULLs.

    Files and catalogs may hold narrower or wider numbers; the casts raise where a value does not
    fit, and never wrap it.
    """
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SCHEMAS[table]
        ]
    )


def read_parquet(spark: SparkSession, table: str, folder: str) -> DataFrame:
    return declared(spark.read.parquet(f"{folder}/{table}"), table)


def loader(
    spark: SparkSession,
    kind: str,
    folder: str,
    files: Mapping[str, str] | None = None,
    defaults: bool = False,
    loaded_at: str | None = None,
) -> Callable[[str], DataFrame]:
    """Base tables by name: ``parquet`` folders, ``dump`` files or catalog ``table`` names.

    ``files`` names dump files that are not called after their table. With ``defaults`` the
    columns' defaults fill missing columns and NULLs, as of ``loaded_at`` or now.
    """
    files = files or {}
    readers: dict[str, Callable[[str], DataFrame]] = {
        "parquet": lambda name: read_parquet(spark, name, folder),
        "dump": lambda name: read_dump(spark, name, f"{folder}/{files.get(name, f'{name}.dat')}"),
        "table": lambda name: declared(spark.table(f"{folder}.{name}"), name),
        "tpch": TpchSources(spark, folder),
    }
    read = readers[kind]
    return (lambda name: with_defaults(read(name), name, loaded_at)) if defaults else read


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    partitions: int = 16,
) -> DataFrame:
    """Full table read over JDBC, split on the first key column by its range."""
    key = PRIMARY_KEYS[table][0]
    bounds = spark.read.jdbc(
        url, f"(select min({key}) lo, max({key}) hi from {table}) b", properties=dict(properties)
    ).first()
    if bounds is None or bounds.lo is None:
        return spark.read.jdbc(url, table, properties=dict(properties))
    return spark.read.jdbc(
        url, table, column=key, lowerBound=bounds.lo, upperBound=bounds.hi + 1,
        numPartitions=partitions, properties=dict(properties),
    )


def discover(spark: SparkSession, database: str | None = None) -> dict[str, StructType]:
    """Schemas of the tables and views of one database."""
    names = [t.name for t in spark.catalog.listTables(database) if not (database and t.isTemporary)]
    prefix = f"{database}." if database else ""
    return {name: spark.table(prefix + name).schema for name in names}


def select_tables(
    found: Iterable[str],
    keys: Mapping[str, tuple[str, ...]] = PRIMARY_KEYS,
    source_keys: Mapping[str, tuple[str, ...]] | None = None,
) -> dict[str, tuple[str, ...]]:
    """Tables to copy and their keys: the configured key wins over the source's own, and a
    relation without any key (likely a view) is left out."""
    source_keys = source_keys or {}
    chosen = {name: keys.get(name) or source_keys.get(name) for name in found}
    return {name: key for name, key in chosen.items() if key}


def with_defaults(df: DataFrame, table: str, loaded_at: str | None = None) -> DataFrame:
    """Fill missing columns and NULLs with the table's column defaults, as of a moment or now."""
    defaults = dict(DEFAULTS.get(table, {}))
    moment = f"timestamp_ntz '{loaded_at}'" if loaded_at else "localtimestamp()"
    if table in STAMPED:
        defaults["last_update"] = moment
    if table == "customer":
        defaults["create_date"] = f"date({moment})"
    types = {f.name: f.dataType for f in SCHEMAS[table]}
    filled = {}
    for name, sql in defaults.items():
        value = F.expr(sql).cast(types[name])
        filled[name] = F.coalesce(F.col(name), value) if name in df.columns else value
    return df.withColumns(filled)


def ingest_names(df: DataFrame) -> DataFrame:
    """Rename columns whose source names the warehouse does not take."""
    return df.withColumnsRenamed(INGEST_NAMES)


def replicate(
    load: Callable[[str], DataFrame],
    tables: Iterable[str],
    database: str | None = None,
    source_keys: Mapping[str, tuple[str, ...]] | None = None,
) -> list[str]:
    """Full refresh: overwrite each target table with the whole source table.

    Tables without a configured key are copied if ``source_keys`` has one for them.
    """

    def copy(name: str) -> str:
        target = f"{database}.{name}" if database else name
        ingest_names(load(name)).write.mode("overwrite").format("parquet").saveAsTable(target)
        return target

    with ThreadPoolExecutor(THREADS) as pool:
        return list(pool.map(copy, select_tables(tables, source_keys=source_keys)))
