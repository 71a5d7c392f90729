"""Checks with states that are kept for each leaf of a stored relation and merged into its report.

A leaf's state holds what its rows add to every check: failing rows by condition, unexpected values,
referring values, and fingerprints of keys. A later refresh reads the leaves whose digests changed, and
takes the other states as they are. Merging is exact: parents are looked up when the report is made, and
fingerprints that occur twice are settled by the real keys, read from the leaves that hold them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinomart.operators.digest_tree import LEAF, Refresh
from kinomart.operators.quality import any_null
from kinomart.session import materialize

STATE = "_leaf bigint, kind string, name string, value string, print bigint, n bigint"
FAILING, UNEXPECTED, REFERRING, KEYS = "failing rows", "unexpected values", "referring values", "keys"


@dataclass(frozen=True)
class Checks:
    """What is checked: failing conditions by name; accepted values and parents (with their key) by column;
    columns of keys."""

    conditions: Mapping[str, str] = field(default_factory=dict)
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)
    references: Mapping[str, tuple[DataFrame, str]] = field(default_factory=dict)
    unique: Sequence[tuple[str, ...]] = ()


def _print(key: Sequence[str]) -> Column:
    return F.xxhash64(*key)


def _key_name(key: Sequence[str]) -> str:
    return "_".join(key)


def leaf_checks(rows: DataFrame, checks: Checks) -> DataFrame:
    """The states of rows with a leaf column. All conditions are one scan; so are all values and prints,
    which are counted before they are shuffled."""
    parts = []
    if checks.conditions:
        counted = rows.groupBy(LEAF).agg(*[F.expr(f"count_if({c})").alias(f"n{i}") for i, c in enumerate(checks.conditions.values())])
        each = [
            F.struct(F.lit(FAILING).alias("kind"), F.lit(name).alias("name"), F.lit(None).cast("string").alias("value"),
                     F.lit(None).cast("long").alias("print"), F.col(f"n{i}").alias("n"))
            for i, name in enumerate(checks.conditions)
        ]
        parts.append(counted.select(LEAF, F.inline(F.array(*each))))

    def entry(kind: str, name: str, value: Column, mark: Column, wanted: Column) -> Column:
        row = F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"), value.cast("string").alias("value"), mark.cast("long").alias("print"))
        return F.when(wanted, row)

    nothing = F.lit(None)
    entries = [entry(UNEXPECTED, c, F.col(c), nothing, ~F.col(c).isin(*values)) for c, values in checks.accepted.items()]
    entries += [entry(REFERRING, c, F.col(c), nothing, F.col(c).isNotNull()) for c in checks.references]
    entries += [entry(KEYS, _key_name(k), nothing, _print(k), ~any_null(k)) for k in checks.unique]
    if entries:
        found = rows.select(LEAF, F.inline(F.array_compact(F.array(*entries))))
        parts.append(found.groupBy(LEAF, "kind", "name", "value", "print").agg(F.count("*").alias("n")))
    return reduce(DataFrame.union, parts)


def _leaves(refresh: Refresh) -> DataFrame:
    return refresh.tree.where("level = 0").select(F.col("node").alias(LEAF), "n_rows", "first", "second")


def update_states(refresh: Refresh, checks: Checks, before: str | None, folder: str) -> int:
    """Write the states of a stored relation to `folder`, taking those of unchanged leaves from the folder
    `before`; returns how many leaves were read. The checks are the same as before."""
    spark, now = refresh.spark, _leaves(refresh)
    if before is None:
        changed, kept = now, None
    else:
        then = spark.read.parquet(f"{before}/leaves")
        same = reduce(Column.__and__, [F.col(f"n.{c}").eqNullSafe(F.col(f"t.{c}")) for c in now.columns])
        changed = now.alias("n").join(then.alias("t"), same, "left_anti")
        alike = now.alias("n").join(then.alias("t"), same, "left_semi").select(F.col(LEAF).alias("_same"))
        states = spark.read.schema(STATE).parquet(f"{before}/states")
        kept = states.join(alike, F.col(LEAF).eqNullSafe(F.col("_same")), "left_semi")
    leaves = [r[LEAF] for r in changed.select(LEAF).collect()]
    wanted = F.col(LEAF).isin([x for x in leaves if x is not None]) | (F.col(LEAF).isNull() if None in leaves else F.lit(False))
    fresh = leaf_checks(refresh.rows.where(F.coalesce(wanted, F.lit(False))), checks)
    materialize(fresh.unionByName(kept) if kept is not None else fresh, f"{folder}/states")
    materialize(now, f"{folder}/leaves")
    return len(leaves)


def report(refresh: Refresh, checks: Checks, folder: str) -> DataFrame:
    """(check, failures) from the states: rows that meet a condition, unexpected values, rows whose
    reference has no parent, and keys that occur more than once. Names are those of the full report."""
    states = refresh.spark.read.schema(STATE).parquet(f"{folder}/states")

    def of(kind: str) -> DataFrame:
        return states.where(F.col("kind") == kind)

    found = [of(FAILING).select(F.col("name").alias("check"), "n")]
    values = of(UNEXPECTED).select("name", "value").distinct()
    found.append(values.select(F.concat(F.lit("accepted_values_"), "name"), F.lit(1).cast("long")))
    for column, (parent, key) in checks.references.items():
        keys = parent.select(F.col(key).cast("string").alias("value"))
        mine = of(REFERRING).where(F.col("name") == column).groupBy("value").agg(F.sum("n").alias("n"))
        found.append(mine.join(keys, "value", "left_anti").select(F.lit(f"relationships_{column}"), "n"))
    for key in checks.unique:
        prints = of(KEYS).where(F.col("name") == _key_name(key))
        twice = prints.groupBy("print").agg(F.sum("n").alias("n")).where("n > 1").select("print")
        leaves = prints.join(twice, "print", "left_semi").select(LEAF).distinct()
        # The leaf column is a folder: those without such prints are not opened.
        rows = refresh.rows.select(LEAF, *key).where(~any_null(key)).join(leaves, LEAF, "left_semi")
        twice = twice.withColumnRenamed("print", "_print")
        keys = rows.withColumn("_print", _print(key)).join(twice, "_print", "left_semi")
        repeated = keys.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1")
        found.append(repeated.select(F.lit(f"unique_{_key_name(key)}"), F.lit(1).cast("long")))
    names = [*checks.conditions, *[f"accepted_values_{c}" for c in checks.accepted]]
    names += [f"relationships_{c}" for c in checks.references] + [f"unique_{_key_name(k)}" for k in checks.unique]
    every = refresh.spark.range(1).select(F.explode(F.array(*map(F.lit, names))).alias("check"), F.lit(0).cast("long").alias("n"))
    return reduce(DataFrame.union, [every, *found]).groupBy("check").agg(F.sum("n").alias("failures"))
