"""Stored refreshes, row history, balances, maintained marts and merged check states, by hand."""

import random
import shutil
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import fixtures as fx
import pytest
from pyspark.sql import functions as F

from kinomart.functions import balances
from kinomart.functions import rental as fn
from kinomart.operators import check_state, digest_tree, history
from kinomart.operators import quality as q
from kinomart.operators.refresh import refresh_diff
from kinomart.plans import checks
from kinomart.plans.deltas import FACT, WIDE, MaintainedMarts
from kinomart.plans.models import Models
from kinomart.session import materialize
from kinomart.sources.schemas import PRIMARY_KEYS

SCHEMA = "k bigint, a string, b int"


def bag(df):
    return Counter(map(tuple, df.collect()))


def counts(df):
    return {r.change: r.n_rows for r in df.collect()}


def versions(seed, n=300):
    """Two states of a table: most rows alike, some changed, added, removed, repeated, without key."""
    rng = random.Random(seed)
    old = [(k, rng.choice("xyz"), rng.choice([None, 1, 2])) for k in range(-20, n)]
    new = [r for r in old if rng.random() > 0.01 or r[0] > 200]
    new = [(k, a + "!", b) if rng.random() < 0.01 else (k, a, b) for k, a, b in new]
    # Nulls that change places.
    new = [(k, None, 1) if k == 40 else (k, a, b) for k, a, b in new]
    old = [(k, "1", None) if k == 40 else (k, a, b) for k, a, b in old]
    old += [(5, "again", 1), (None, "no key", 1)]
    new += [(5, "again", 1), (6, "twice", 2), (None, "no key", 1), (None, "no key", 2), (9000, "far", 1)]
    rng.shuffle(new)
    return old, new


@pytest.mark.parametrize("seed, leaf_rows, max_nodes", [(1, 10, 512), (2, 10, 2), (3, 1000, 512)])
def test_tree_diff_is_the_full_join(spark, tmp_path, monkeypatch, seed, leaf_rows, max_nodes):
    monkeypatch.setattr(digest_tree, "MAX_NODES", max_nodes)
    a, b = (spark.createDataFrame(rows, SCHEMA) for rows in versions(seed))
    old = digest_tree.store_refresh(a, ["k"], f"{tmp_path}/old", leaf_rows=leaf_rows)
    new = digest_tree.store_refresh(b, ["k"], f"{tmp_path}/new", old)
    assert counts(digest_tree.tree_diff(old, new)) == counts(refresh_diff(a, b, ["k"]))
    first = {}
    for side, df in (("old", a), ("new", b)):
        for r in df.where("k is not null").collect():
            key = (r.a is not None, r.a or "", r.b is not None, r.b or 0)
            first.setdefault(r.k, {}).setdefault(side, []).append((key, (r.a, r.b)))
    least = {k: {s: min(rows)[1] for s, rows in sides.items()} for k, sides in first.items()}
    expected = {k: (v.get("old"), v.get("new")) for k, v in least.items() if v.get("old") != v.get("new")}
    found = {r.k: tuple(s and (s.a, s.b) for s in (r.old, r.new)) for r in digest_tree.changed_rows(old, new).collect()}
    assert found == expected


def test_tree_diff_reads_changed_leaves_only(spark, tmp_path):
    a = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("a"))
    b = a.withColumn("a", F.when(F.col("k") == 555, "y").otherwise(F.col("a")))
    old = digest_tree.store_refresh(a, ["k"], f"{tmp_path}/old", leaf_rows=50)
    new = digest_tree.store_refresh(b.orderBy(F.desc("k")), ["k"], f"{tmp_path}/new", old)
    leaves = sorted(Path(f"{tmp_path}/old/rows").glob("_leaf=*"))
    assert len(leaves) == 20
    for side in ("old", "new"):
        for leaf in Path(f"{tmp_path}/{side}/rows").glob("_leaf=*"):
            if leaf.name != "_leaf=11":
                shutil.rmtree(leaf)
    assert counts(digest_tree.tree_diff(old, new)) == {"changed": 1, "unchanged": 999}
    plan = digest_tree.changed_leaves(old, new).new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_leaf" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_small_leaves_do_not_become_many_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(digest_tree, "MANY_LEAVES", 20)
    a = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("a")).union(spark.sql("SELECT 7L, 'again' UNION ALL SELECT NULL, 'none'"))
    b = a.withColumn("a", F.when(F.col("k") == 555, "y").otherwise(F.col("a")))
    old = digest_tree.store_refresh(a, ["k"], f"{tmp_path}/old", leaf_rows=1)
    new = digest_tree.store_refresh(b, ["k"], f"{tmp_path}/new", old)
    assert 10 < len(list(Path(f"{tmp_path}/old/rows").glob("_leaf=*"))) <= 21
    assert not Path(f"{tmp_path}/old/staged").exists()
    assert counts(digest_tree.tree_diff(old, new)) == counts(refresh_diff(a, b, ["k"]))
    assert [r.k for r in digest_tree.changed_rows(old, new).collect()] == [555]


def test_tree_of_other_keys_columns_and_nothing(spark, tmp_path):
    a = spark.createDataFrame([("a", 1, 1.5), ("b", 2, None), ("b", 3, 0.0)], "k string, n int, v double")
    old = digest_tree.store_refresh(a, ["k", "n"], f"{tmp_path}/old", leaf_rows=1)
    new = digest_tree.store_refresh(a.where("n < 3"), ["k", "n"], f"{tmp_path}/new", old)
    assert counts(digest_tree.tree_diff(old, new)) == {"unchanged": 2, "removed": 1}
    wider = a.withColumn("w", F.lit(1))
    other = digest_tree.store_refresh(wider, ["k", "n"], f"{tmp_path}/other", old)
    assert counts(digest_tree.tree_diff(old, other)) == counts(refresh_diff(a, wider, ["k", "n"])) == {"changed": 3}
    empty = digest_tree.store_refresh(a.limit(0), ["k", "n"], f"{tmp_path}/empty", old)
    assert counts(digest_tree.tree_diff(empty, old)) == {"added": 3}
    assert counts(digest_tree.tree_diff(empty, empty)) == {}
    reopened = digest_tree.open_refresh(spark, f"{tmp_path}/old")
    assert reopened.layout == old.layout and reopened.schema == old.schema and bag(reopened.rows) == bag(old.rows)
    with pytest.raises(ValueError):
        digest_tree.store_refresh(a, ["k"], f"{tmp_path}/bad", old)


def test_digests_see_copies_and_places_of_nulls(spark, tmp_path):
    def stored(name, rows, like=None):
        return digest_tree.store_refresh(spark.createDataFrame(rows, SCHEMA), ["k"], f"{tmp_path}/{name}", like)

    one = stored("one", [(1, None, 1), (2, "x", None)])
    assert digest_tree.differing_nodes(one, stored("same", [(2, "x", None), (1, None, 1)], one))[1] == []
    others = [[(1, "1", None), (2, "x", None)], [(1, None, 1)] * 3 + [(2, "x", None)], [(1, None, 1), (2, "x", 0)]]
    for i, (rows, leaf) in enumerate(zip(others, (0, 0, 1), strict=True)):
        assert digest_tree.differing_nodes(one, stored(str(i), rows, one))[1] == [leaf]


DAYS = [datetime(2000, 1, 1) + timedelta(days=i) for i in range(7)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_history_of_refreshes_in_any_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    states = {d: [(k, rng.choice("pq"), rng.choice([None, 1])) for k in range(12) if rng.random() < 0.7] for d in DAYS[:5]}
    order = list(states) + [rng.choice(list(states))]
    rng.shuffle(order)
    known, seen = None, []
    for i, day in enumerate(order):
        state = spark.createDataFrame(states[day], SCHEMA)
        known = history.start(state, ["k"], day) if known is None else history.apply_refresh(known, state, ["k"], day, seen)
        known.write.parquet(f"{tmp_path}/{i}")
        known, seen = spark.read.parquet(f"{tmp_path}/{i}"), [*seen, day]
    for i, day in enumerate(sorted(states)):
        assert bag(history.as_of(known, day)) == Counter(states[day]), day
        assert bag(history.as_of(known, day + timedelta(hours=5))) == Counter(states[day])
    rows = known.orderBy("k", "valid_from").collect()
    for x, y in zip(rows, rows[1:]):
        if x.k == y.k:  # in order, without overlap, and never two intervals where one would do
            assert x.valid_to <= y.valid_from and ((x.a, x.b) != (y.a, y.b) or x.valid_to < y.valid_from)


def test_late_and_repeated_updates(spark):
    start = history.start(spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1)], SCHEMA), ["k"], DAYS[0])
    later = history.apply_updates(start, spark.createDataFrame([(1, "z", 1), (None, "n", 1)], SCHEMA), ["k"], DAYS[5])
    rows = [(1, "m", 1, DAYS[2], False), (1, "l", 1, DAYS[2], False), (2, "b", 1, DAYS[3], False), (3, "c", 1, DAYS[4], True), (4, "d", 1, DAYS[1], False), (4, "d", 1, None, False)]
    updates = spark.createDataFrame(rows, SCHEMA + ", day timestamp_ntz, gone boolean")
    final = history.apply_updates(later, updates, ["k"], F.col("day"), F.col("gone"))
    assert bag(final) == Counter(
        [
            (1, "a", 1, DAYS[0], DAYS[2]), (1, "m", 1, DAYS[2], DAYS[5]), (1, "z", 1, DAYS[5], None),
            (2, "b", 1, DAYS[0], None), (3, "c", 1, DAYS[0], DAYS[4]), (4, "d", 1, DAYS[1], None),
        ]
    )
    assert bag(history.unusable(updates, ["k"], F.col("day")).select("k")) == Counter([(4,)])
    # A row that ends, and comes back as it was.
    back = history.apply_updates(final, spark.createDataFrame([(3, "c", 1)], SCHEMA), ["k"], DAYS[6])
    assert bag(back.where("k = 3").select("valid_from", "valid_to")) == Counter([(DAYS[0], DAYS[4]), (DAYS[6], None)])
    again = history.apply_updates(back, spark.createDataFrame([(3, "c", 1)], SCHEMA), ["k"], DAYS[4])
    assert bag(again.where("k = 3").select("valid_from", "valid_to")) == Counter([(DAYS[0], None)])


def shop(spark, rentals=400):
    """One customer with a third of all rentals."""
    rng = random.Random(9)
    rows = fx.base()
    start = datetime(2005, 1, 1)
    rows["rental"], rows["payment"] = [], []
    for i in range(rentals):
        out = start + timedelta(hours=rng.randrange(24 * 300))
        back = (out + timedelta(hours=rng.randrange(300))).isoformat(sep=" ") if rng.random() < 0.8 else None
        customer = 1 if rng.random() < 0.3 else rng.choice([1, 2, 3, 8])
        rows["rental"].append(fx.rental(i, rng.choice([1, 2, 3, 9, 77]), customer, out.isoformat(sep=" "), back))
        for j in range(rng.randrange(3)):
            day = (out + timedelta(hours=rng.randrange(400))).isoformat(sep=" ")
            rows["payment"].append(fx.payment(i * 10 + j, i, f"{rng.randrange(1, 900) / 100:.2f}", customer, day))
    return rows


def loaded(spark, rows):
    return Models(lambda name: fx.table(spark, name, rows[name]))


def test_balances_equal_one_balance_at_a_time(spark):
    rows = shop(spark)
    m = loaded(spark, rows)
    tables = [m[n] for n in ("rental", "inventory", "film", "payment")]
    moments = [datetime(2004, 12, 1), datetime(2005, 3, 1), rows["rental"][7]["rental_date"], datetime(2005, 3, 31, 23, 59, 59), datetime(2007, 1, 1)]
    every = balances.customer_balances(m["customer"], *tables, moments)
    expected = Counter()
    for moment in moments:
        one = fn.customer_balance(m["customer"], *tables, moment)
        expected += Counter((r.customer_id, moment, *r[1:]) for r in one.collect())
    assert bag(every) == expected
    pairs = spark.createDataFrame([(1, moments[1]), (1, moments[1]), (3, moments[4]), (8, moments[4]), (None, moments[4]), (2, None)], "customer_id bigint, as_of timestamp_ntz")
    asked = balances.customer_balances(m["customer"], *tables, pairs)
    assert bag(asked) == Counter({k: n for k, n in expected.items() if k[:2] in {(1, moments[1]), (3, moments[4])}})


def test_balances_deal_a_customer_by_bucket(spark):
    events = spark.range(4000).select(F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 20_000).cast("timestamp_ntz").alias("at"), F.lit(1).cast("decimal(20,2)").alias("v"))
    asked = events.where("minute(at) = 0").select("k", F.col("at").alias("as_of"))
    found = balances.prefix_sums(events, asked, "k", ["v"])
    assert bag(found) == Counter((1, r.at, Decimal(r.n)) for r in events.selectExpr("at", "cast(rank() over (order by at) as bigint) n").collect() if r.at.minute == 0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "bucket" in plan.split("hashpartitioning(k")[1]


def changed_shop(rows):
    """Late returns, a new and a lost payment, a moved item, a new rate, a customer gone, a rental gone."""
    new = {name: [dict(r) for r in table] for name, table in rows.items()}
    new["rental"][3]["return_date"] = datetime(2006, 1, 1)
    new["rental"][4]["inventory_id"] = 2
    del new["rental"][10]
    new["rental"].append(fx.rental(9_999, 1, 3, "2005-08-01 08:00:00"))
    new["payment"].append(fx.payment(99_999, 20, "1.11"))
    del new["payment"][5]
    return new


def files(folder):
    return {p.relative_to(folder) for p in Path(folder).glob("rows/_leaf=*/*.parquet")}


def test_marts_follow_a_refresh(spark, tmp_path):
    rows = shop(spark, 120)
    kept = MaintainedMarts(spark, f"{tmp_path}/marts", leaf_rows=10)
    kept.build(loaded(spark, rows).__getitem__)
    before = {name: files(f"{tmp_path}/marts/{name}") for name in (FACT, WIDE)}
    assert len(before[FACT]) > 10
    new = changed_shop(rows)
    written = kept.refresh(loaded(spark, new).__getitem__)
    full = loaded(spark, new)
    for name in (FACT, WIDE):
        assert bag(kept[name]) == bag(full[name])
        after = files(f"{tmp_path}/marts/{name}")
        assert 0 < written[name] <= 7
        # Leaves without a change keep their files.
        assert len(before[name] - after) <= written[name] and len(before[name] & after) >= 5
        fresh = digest_tree.store_refresh(full[name], ["rental_id"], f"{tmp_path}/full-{name}", kept.mart(name))
        assert bag(kept.mart(name).tree) == bag(fresh.tree)
    assert kept.refresh(loaded(spark, new).__getitem__) == {FACT: 0, WIDE: 0}
    # Dimension rows and terms: all rows of a film, a customer.
    newer = {name: [dict(r) for r in table] for name, table in new.items()}
    newer["film"][0]["rental_rate"] = Decimal("3.50")
    newer["inventory"] = [r for r in newer["inventory"] if r["inventory_id"] != 2]
    newer["customer"] = newer["customer"][:2]
    newer["city"][0]["city"] = "Cusco"
    kept.refresh(loaded(spark, newer).__getitem__)
    last = loaded(spark, newer)
    for name in (FACT, WIDE):
        assert bag(kept[name]) == bag(last[name])


def test_a_leaf_that_loses_all_rows(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("a"))
    stored = digest_tree.store_refresh(rows, ["k"], f"{tmp_path}/t", leaf_rows=10)
    gone = spark.range(30, 40).select(F.col("id").alias("k"))
    assert digest_tree.replace_keys(stored, gone, rows.limit(0), f"{tmp_path}/work") == 1
    assert bag(stored.rows.drop("_leaf")) == bag(rows.where("k not between 30 and 39"))
    fresh = digest_tree.store_refresh(rows.where("k not between 30 and 39"), ["k"], f"{tmp_path}/f", stored)
    assert bag(fresh.tree) == bag(stored.tree)


def declared(models):
    declared = checks.of_relation(models, "fct_rental")
    return check_state.Checks(declared.conditions, {"staff_id": (1, 2)}, declared.references, [("rental_id",), ("payment_id",), ("customer_id", "rental_date")])


def full_report(models):
    fact, wanted = models["fct_rental"], declared(models)
    found = {name: fact.where(c).count() for name, c in wanted.conditions.items()}
    found |= {f"accepted_values_{c}": q.unexpected_values(fact, {c: v}).count() for c, v in wanted.accepted.items()}
    for c, parent in wanted.references.items():
        found[f"relationships_{c}"] = sum(r.n_records for r in q.orphan_keys(fact, {c: parent}).collect())
    return found | {f"unique_{'_'.join(k)}": q.not_unique(fact, *k).count() for k in wanted.unique}


def test_check_states_merge_to_the_full_report(spark, tmp_path):
    rows = shop(spark, 120)
    for r in rows["rental"][::9]:
        r["staff_id"] = 7
    old_models, new_models = loaded(spark, rows), loaded(spark, changed_shop(rows))

    def stored(models, name, like=None):
        return digest_tree.store_refresh(models["fct_rental"], ["rental_id"], f"{tmp_path}/{name}", like, 10)

    old = stored(old_models, "old")
    assert check_state.update_states(old, declared(old_models), None, f"{tmp_path}/s0") > 10
    found = {r.check: r.failures for r in check_state.report(old, declared(old_models), f"{tmp_path}/s0").collect()}
    expected = full_report(old_models)
    assert found == expected and expected["unique_rental_id"] > 0 and expected["relationships_customer_id"] > 0
    new = stored(new_models, "new", old)
    assert check_state.update_states(new, declared(new_models), f"{tmp_path}/s0", f"{tmp_path}/s1") <= 7
    found = {r.check: r.failures for r in check_state.report(new, declared(new_models), f"{tmp_path}/s1").collect()}
    assert found == full_report(new_models)
    assert check_state.update_states(new, declared(new_models), f"{tmp_path}/s1", f"{tmp_path}/s2") == 0


def test_keys_of_stored_refreshes_are_declared():
    assert PRIMARY_KEYS["rental"] == ("rental_id",) and PRIMARY_KEYS["payment"] == ("payment_id",)


def test_a_refresh_reads_each_table_once(spark):
    old = spark.createDataFrame([(1, None, 5), (None, None, 6), (None, 2, 6), (3, 3, 7)], "a int, b int, v int")
    new = spark.createDataFrame([(1, None, 5), (None, None, 6), (None, None, 7), (3, 3, 8), (3, 3, 9)], "a int, b int, v int")
    found = refresh_diff(old, new, ["a", "b"])
    assert {tuple(r) for r in found.collect()} == {
        ("without key in old", 3), ("without key in new", 3), ("changed", 1), ("repeated in new", 1)
    }
    scans = found._jdf.queryExecution().optimizedPlan().toString()
    assert scans.count("LogicalRDD") == 2


def test_replaced_leaves_are_moved_not_written_again(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("a"))
    stored = digest_tree.store_refresh(rows, ["k"], f"{tmp_path}/t", leaf_rows=10)
    kept = files(f"{tmp_path}/t")
    some = spark.range(25, 45).select(F.col("id").alias("k"))
    assert digest_tree.replace_keys(stored, some, some.withColumn("a", F.lit("y")), f"{tmp_path}/work") == 3
    new = rows.withColumn("a", F.when(F.col("k").between(25, 44), "y").otherwise("x"))
    assert bag(stored.rows.drop("_leaf")) == bag(new)
    # The new files have left the folder in which they were made, and the old ones lie beside it.
    assert files(f"{tmp_path}/work") == set() and files(f"{tmp_path}/t") - kept
    old = {p.relative_to(f"{tmp_path}/work/old") for p in Path(f"{tmp_path}/work/old").glob("*/*.parquet")}
    assert {Path("rows") / p for p in old} == kept - files(f"{tmp_path}/t")
    # Once more, over what the first replacement left behind.
    assert digest_tree.replace_keys(stored, some, some.withColumn("a", F.lit("y")), f"{tmp_path}/work") == 3
    assert bag(stored.rows.drop("_leaf")) == bag(new)


def test_the_wide_mart_is_built_from_lists_and_dealt_as_the_fact(spark, tmp_path, monkeypatch):
    staged = []
    monkeypatch.setattr(digest_tree, "materialize", lambda df, path, *more: (staged.append(path), materialize(df, path, *more))[1])
    models = loaded(spark, shop(spark, 60))
    kept = MaintainedMarts(spark, f"{tmp_path}/marts", leaf_rows=10)
    kept.build(models.__getitem__)
    assert not any("/staged" in p for p in staged if f"/{FACT}/" in p or f"/{WIDE}/" in p)
    assert kept.mart(FACT).layout == kept.mart(WIDE).layout and not list(Path(f"{tmp_path}/marts").glob("work-*"))
    for name in (FACT, WIDE):
        assert bag(kept[name]) == bag(models[name])
