import random
from collections import Counter, defaultdict

import fixtures as fx
import pytest
from fixtures import at
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinomart.operators.aggregates import assemble, group_concat, list_pieces
from kinomart.operators.joins import left_join_split
from kinomart.operators.refresh import refresh_diff, refresh_report, rejected_updates, upsert_stamped
from kinomart.operators.text_index import phrase_search, token_index, words_of
from kinomart.sources.schemas import PRIMARY_KEYS


def joined(left, right):
    """Left join by hand."""
    by_key = defaultdict(list)
    for key, value in right:
        if key is not None:
            by_key[key].append(value)
    return Counter((k, a, v) for k, a in left for v in by_key.get(k, [None]))


@pytest.mark.parametrize("hot_rows", [1, 3, 50, 10_000])
def test_split_join(spark, hot_rows):
    rng = random.Random(hot_rows)
    # One key with a third of all right rows, some unmatched on either side, some NULL.
    left = [(k, f"l{k}") for k in range(30)] + [(5, "again"), (None, "none")]
    right = [(rng.choice([5, rng.randrange(20, 60), rng.randrange(60)]), i) for i in range(600)]
    right += [(None, 1000), (None, 1001)]
    out = left_join_split(
        spark.createDataFrame(left, "k int, a string"),
        spark.createDataFrame(right, "k int, v int"),
        "k", hot_rows,
    )
    assert out.columns == ["k", "a", "v"]
    assert Counter(map(tuple, out.collect())) == joined(left, right)


def test_split_join_keeps_equal_rows(spark):
    left = spark.createDataFrame([(1, "x")], "k int, a string")
    right = spark.createDataFrame([(1, 7)] * 9, "k int, v int")
    assert left_join_split(left, right, "k", 2).count() == 9


def test_split_join_with_nothing_to_match(spark):
    left = spark.createDataFrame([(1, "x")], "k int, a string")
    right = spark.createDataFrame([], "k int, v int")
    assert [tuple(r) for r in left_join_split(left, right, "k", 1).collect()] == [(1, "x", None)]


@pytest.mark.parametrize("list_rows", [1, 3, 10_000])
def test_split_join_with_lists(spark, list_rows):
    left = [(1, "a"), (1, "again"), (2, "b"), (3, "none"), (None, "null")]
    right = [(1, 10 + i) for i in range(7)] + [(2, None), (2, 5), (9, 1), (None, 2)]
    lists = left_join_split(
        spark.createDataFrame(left, "k int, a string"), spark.createDataFrame(right, "k int, v int"), "k", list_rows, listed=True
    )
    found = Counter((r.k, r.a, v) for r in lists.collect() for v in (r.v if r.v is not None else [None]))
    assert found == joined(left, right)
    # Without hot keys there is one row for each left row.
    assert list_rows < 10_000 or lists.count() == len(left)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([1, 2, None]), st.text("abcé,", max_size=3) | st.none()),
                min_size=1, max_size=40))
def test_group_concat_by_hand(spark, pairs):
    groups = defaultdict(list)
    for key, text in pairs:
        groups[key].append(text)
    expected = {}
    for key, texts in groups.items():
        known = sorted((t for t in texts if t is not None), key=lambda t: t.encode())
        expected[key] = ", ".join(known) if known else None
    df = spark.createDataFrame(pairs, "k int, t string")
    assert {r.k: r.x for r in group_concat(df, ["k"], "t", "x").collect()} == expected


def test_group_concat_of_one_large_group(spark):
    df = spark.range(0, 20_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.lpad(F.reverse(F.col("id").cast("string")), 6, "0").alias("t"),
    )
    hot = group_concat(df, ["k"], "t", "x").where("k = 0").first().x
    assert hot.split(", ") == sorted(str(i)[::-1].rjust(6, "0") for i in range(0, 20_000, 3))


ITEM = "id int, name string, n int, last_update timestamp_ntz"
OLD, NEW = at("2005-01-01 00:00:00"), at("2006-01-01 00:00:00")


def test_refresh_diff(spark):
    old = spark.createDataFrame([(1, "a", None, OLD), (2, "b", 1, OLD), (3, "c", 1, OLD)], ITEM)
    new = spark.createDataFrame([(1, "a", None, OLD), (2, "b", None, OLD), (4, "d", 1, OLD)], ITEM)
    got = {r.change: r.n_rows for r in refresh_diff(old, new, ["id"]).collect()}
    assert got == {"unchanged": 1, "changed": 1, "removed": 1, "added": 1}


def test_refresh_diff_of_a_table_of_keys(spark):
    old = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    new = spark.createDataFrame([(1, 2), (2, 2)], "a int, b int")
    got = {r.change: r.n_rows for r in refresh_diff(old, new, ["a", "b"]).collect()}
    assert got == {"unchanged": 1, "removed": 1, "added": 1}


def test_refresh_report_covers_every_table(spark):
    rows = fx.base()
    more = rows | {"city": rows["city"] * 1 + [rows["city"][0] | {"city_id": 2}], "actor": []}
    report = refresh_report(
        lambda n: fx.table(spark, n, rows[n]), lambda n: fx.table(spark, n, more[n]), PRIMARY_KEYS
    )
    got = {(r.relation, r.change): r.n_rows for r in report.collect()}
    assert {k: n for k, n in got.items() if k[1] != "unchanged"} == {
        ("city", "added"): 1, ("actor", "removed"): 3,
    }
    assert got["rental", "unchanged"] == 7 and got["film_actor", "unchanged"] == 3


def test_upsert_stamps_changed_rows_only(spark):
    target = spark.createDataFrame(
        [(1, "a", None, OLD), (2, "b", 1, OLD), (3, "c", None, OLD), (4, "d", 1, OLD)], ITEM
    )
    updates = spark.createDataFrame(
        [(1, "a", None, None), (2, "b", None, None), (3, "x", None, None), (5, "e", 1, OLD)], ITEM
    )
    stamp = F.lit("2006-01-01").cast("timestamp_ntz")
    out = upsert_stamped(target, updates, ["id"], stamp)
    assert out.columns == target.columns
    assert {tuple(r) for r in out.collect()} == {
        (1, "a", None, OLD), (2, "b", None, NEW), (3, "x", None, NEW), (4, "d", 1, OLD),
        (5, "e", 1, OLD),
    }


def test_token_index(spark):
    films = fx.table(spark, "film", [
        fx.film(1, "The Dark-Sea", description="A sea, the SEA!"),
        fx.film(2, None, description="Dark"),
        fx.film(3, "", description=None),
    ])
    got = {
        (r.token, r.film_id): r.positions
        for r in token_index(films, "film_id", ["title", "description"]).collect()
    }
    assert got == {("dark", 1): [2], ("sea", 1): [3, 5, 7], ("dark", 2): [1]}


@pytest.mark.parametrize("distinct", [False, True])
def test_list_pieces(spark, distinct):
    """A group with nine tenths of all texts, copies, NULLs, a group of NULLs, a NULL group."""
    rng = random.Random(4)
    rows = [("big" if rng.random() < 0.9 else rng.choice("abc"), rng.choice([f"t{rng.randrange(2000):05}", "same"])) for _ in range(3000)]
    rows += [("none", None), ("big", None), (None, "x"), (None, "y"), ("q", "it's, so")]
    df = spark.createDataFrame(rows, "g string, t string")
    pieces = list_pieces(df, ["g"], "t", distinct, parts=6, piece_rows=100)
    lists = defaultdict(list)
    for g, t in rows:
        if t is not None:
            lists[g].append(t)
    lists = {g: sorted(set(ts)) if distinct else sorted(ts) for g, ts in lists.items()}
    found = defaultdict(list)
    for r in pieces.orderBy("g", "piece").collect():
        assert len(r.texts) <= 100 and r.n_texts == sum(t._n for t in r.texts)
        found[r.g].append((r.piece, [t._text for t in r.texts for _ in range(t._n)]))
    assert {g: [t for _, ts in parts for t in ts] for g, parts in found.items()} == lists
    assert all([p for p, _ in parts] == list(range(1, len(parts) + 1)) for parts in found.values())
    assert len(found["big"]) > 5
    whole = {r.g: r.texts for r in assemble(pieces, ["g"], "texts").collect()}
    assert whole == {g: ", ".join(ts) for g, ts in lists.items()}


def test_a_large_group_lies_in_several_tasks(spark):
    df = spark.range(20_000).select(F.lit("g").alias("g"), F.format_string("%06d", "id").alias("t"))
    pieces = list_pieces(df, ["g"], "t", parts=8, piece_rows=100_000)
    sizes = [r.n_texts for r in pieces.collect()]
    assert len(sizes) >= 7 and max(sizes) < 5_000 and sum(sizes) == 20_000


def test_phrase_search_equals_a_scan(spark):
    rng = random.Random(6)
    words = ["the", "red", "fox", "a", "of", "ox"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(12))) for _ in range(200)]
    texts += [None, "", "Red--FOX! red fox", "the " * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    phrases = ["red fox", "the", "the the the", "Red, fox", "fox of a", "ox ox", "unknown", "red unknown", "", "a of the"]
    index = token_index(df, "id", ["t"], left_out=[""])
    found = Counter(map(tuple, phrase_search(index, "id", phrases).collect()))
    expected = Counter()
    for p in phrases:
        wanted = words_of(p)
        for i, t in enumerate(texts):
            own = words_of(t or "")
            for at in range(len(own)):
                if wanted and own[at : at + len(wanted)] == wanted:
                    expected[p, i, at + 1] += 1
    assert found == expected
    plan = phrase_search(index, "id", phrases)._jdf.queryExecution().executedPlan().toString()
    # Words meet by word and row; only the caller's list and its words are broadcast.
    assert "SortMergeJoin [token" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_updates_with_repeated_and_missing_keys(spark):
    schema = "k int, v string, last_update timestamp_ntz"
    t1, t2, t3, now = (at(f"2006-01-0{d} 00:00:00") for d in (1, 2, 3, 9))
    target = spark.createDataFrame([(1, "a", t1), (2, "b", t1), (None, "n", t1)], schema)
    updates = spark.createDataFrame([(1, "x", t2), (1, "y", t3), (1, "z", t2), (3, "c", t2), (3, "d", t2), (None, "m", t2)], schema)
    out = Counter(map(tuple, upsert_stamped(target, updates, ["k"], F.lit(now).cast("timestamp_ntz")).collect()))
    assert out == Counter([(1, "y", now), (2, "b", t1), (3, "d", t2), (None, "n", t1)])
    assert {r.reason: r.n_rows for r in rejected_updates(updates, ["k"]).collect()} == {"without key": 1, "repeated key": 3}
