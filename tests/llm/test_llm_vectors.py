"""Whitening and hard negatives against brute force over exact numbers."""

import math
from fractions import Fraction

import numpy as np
import pytest
from kinomart.llm import hard_negatives, queries, whitening
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, block string, white string, n string, anchor string"
MORE = ("?",) * 5


def table(spark, rows):
    return spark.createDataFrame([(*r, *MORE) for r in rows], SCHEMA)


def odd_rows():
    random = np.random.default_rng(5)
    rows = [(i, [float(x) for x in random.normal(0, 0.3, 6)], int(i % 3)) for i in range(1, 120)]
    rows += [rows[3], rows[3], (500, rows[7][1], 0), (501, rows[7][1], 1), (None, rows[9][1], 1), (None, rows[9][1], 2)]
    rows += [(50, None, 1), (600, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (650, [math.nan] + [0.0] * 5, 1), (700, [math.inf] + [0.0] * 5, 1)]
    return [*rows, (750, [1.0, 2.0], 0), (800, [], 0), (850, [-9.0, 9.0, 4.0, -4.0, 1.0, 0.5], None), (900, [0.0] * 6, 1)]


def counted(rows):
    return [r for r in rows if r[1] is not None and len(r[1]) == 6 and all(x is not None and math.isfinite(x) for x in r[1])]


def check_whitening(given, found):
    """given: (key, vector); found: rows of the query."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in given], object)
    n, size = x.shape
    sums = x.sum(axis=0)
    d = n * x - sums
    cov = np.array([[float(Fraction(int((d[:, i] * d[:, j]).sum()), n**3)) for j in range(size)] for i in range(size)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    white = (d / n).astype(float) @ axes / np.sqrt(values)
    by_component = {}
    for r in found:
        by_component.setdefault(r.component, []).append(r)
    assert sorted(by_component) == list(range(1, min(8, size) + 1))
    for k, rows in by_component.items():
        assert len(rows) == n and {r.n for r in rows} == {n}
        expected = sorted((key is None, key or 0, int((row * row).sum()), abs(round(w, 6))) for (key, _), row, w in zip(given, d, white[:, k - 1], strict=True))
        actual = sorted((r.vec_id is None, r.vec_id or 0, r.deviation, abs(round(r.whitened, 6))) for r in rows)
        for a, b in zip(actual, expected, strict=True):
            assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=2e-6)
        signs = {np.sign(r.whitened) * np.sign(w) for r in rows if r.vec_id is not None for (key, _), w in zip(given, white[:, k - 1], strict=True) if key == r.vec_id and abs(w) > 1e-6}
        assert len(signs) == 1
        assert rows[0].explained == pytest.approx(values[k - 1] / np.trace(cov), rel=1e-9)
        assert rows[0].identity_error < 1e-9


def test_whitening_of_odd_rows(spark):
    rows = odd_rows()
    found = whitening.whitened_components(table(spark, rows)).collect()
    check_whitening([(r[0], r[1]) for r in counted(rows)], found)


def test_whitening_query(spark):
    given = [(r.vec_id, r.embedding) for r in queries.read(spark, FOLDER, "embeddings").collect()]
    check_whitening(given, queries.op12_whitening(spark, FOLDER).collect())


def test_whitening_of_large_numbers(spark):
    """Squares beyond a long are summed exactly; a deviation beyond a long is null."""
    random = np.random.default_rng(6)
    rows = [(i, [float(np.float32(x)) for x in random.normal(1e9, 1e8, 3)], 0) for i in range(40)]
    x = np.array([[math.floor(1024 * c) + 100_000 for c in r[1]] for r in rows], object)
    white, basis = whitening.whiten(table(spark, rows))
    d = len(x) * x - x.sum(axis=0)
    assert basis.sums == tuple(int(s) for s in x.sum(axis=0))
    cov = [[float(Fraction(int((d[:, i] * d[:, j]).sum()), 40**3)) for j in range(3)] for i in range(3)]
    assert np.allclose(basis.vectors @ np.diag(basis.values) @ basis.vectors.T, cov, rtol=1e-9)
    assert {r.deviation for r in white.collect()} == {None}


def test_whitening_without_variance(spark):
    assert whitening.whitened_components(table(spark, [])).collect() == []
    assert whitening.whitened_components(table(spark, [(1, None, 0), (2, [math.nan], 0)])).collect() == []
    alone = whitening.whitened_components(table(spark, [(1, [0.5, 2.0], 0)])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    line = whitening.whitened_components(table(spark, [(1, [0.0, 2.0], 0), (2, [1.0, 2.0], 0)])).collect()
    assert sorted((r.vec_id, r.component, r.whitened) for r in line if r.component == 2) == [(1, 2, None), (2, 2, None)]
    assert {abs(r.whitened) for r in line if r.component == 1} == {1.0}


def brute_negatives(rows, positives=5, negatives=3):
    """rows: (key, vector, label); the expected rows as sorted tuples."""
    size = max((len(r[1]) for r in rows), default=0)
    q = np.array([[math.floor(256 * float(np.float32(c))) for c in r[1]] for r in rows], np.int64).reshape(len(rows), size)
    scores, made = q @ q.T, []
    for a, (key, _, label) in enumerate(rows):
        if key is None or key % 50:
            continue
        order = sorted(range(len(rows)), key=lambda i: (-scores[a, i], rows[i][0] is None, rows[i][0] or 0))
        near = [i for i in order if i != a and rows[i][2] == label][:positives]
        for p in near:
            fit = [i for i in order if rows[i][2] != label and 50 * scores[a, p] <= 100 * scores[a, i] <= 95 * scores[a, p]]
            made += [(key, rows[p][0], k + 1, rows[i][0], int(scores[a, p]), int(scores[a, i])) for k, i in enumerate(fit[:negatives])]
    return sorted(made, key=str)


def mined(df, **more):
    return sorted((tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 50 == 0, **more).collect()), key=str)


def test_hard_negatives_of_odd_rows(spark):
    rows = odd_rows()
    expected = brute_negatives([r for r in counted(rows) if r[2] is not None])
    assert len(expected) > 10
    assert mined(table(spark, rows)) == expected


def test_hard_negatives_over_many_blocks(spark, monkeypatch):
    """Small blocks, coarse numbers with many ties, one label with a third of the rows."""
    random = np.random.default_rng(7)
    rows = [(i, [float(x) for x in random.integers(-3, 4, 24) / 256], 0 if i % 3 else int(i % 5)) for i in range(0, 1500)]
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 8 * 24 * 100)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    assert mined(table(spark, rows).repartition(5, "vec_id")) == brute_negatives(rows)


def test_bounds_drop_candidates():
    """Columns in falling order of the anchor's components leave few candidates for the last ones."""
    random = np.random.default_rng(8)
    columns = random.integers(-9, 10, (64, 2000))
    row = {"rows": np.arange(2000), "ids": np.arange(2000), "missing": np.zeros(2000, bool), "labels": np.zeros(2000, np.int64), "columns": columns}
    block = hard_negatives.Block({k: np.ascontiguousarray(v).tobytes() for k, v in row.items()})
    anchor = (1000 * 0.8 ** np.arange(64)).astype(np.int64)[random.permutation(64)]
    scan = hard_negatives.Scan(block, anchor, np.ones(2000, bool))
    assert (np.diff(np.abs(scan.weights)) <= 0).all()
    sizes = []
    step = scan.step
    scan.step = lambda: (sizes.append(len(scan.at)), step())[1]
    at, scores = scan.nearest(5)
    exact = anchor @ columns
    assert list(scores) == sorted(exact, reverse=True)[:5] and list(exact[at]) == list(scores)
    assert sizes[-1] <= 20 and sizes[3] < 400


def test_hard_negatives_without_rows(spark):
    assert mined(table(spark, [])) == []
    assert mined(table(spark, [(0, [1.0], 1)])) == []
    assert mined(table(spark, [(0, [1.0], 1), (1, [1.0], None), (50, None, 1)])) == []
    # A positive with a negative score has an empty window; one of score 0 takes zeros.
    assert mined(table(spark, [(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.6], 2)])) == []
    assert mined(table(spark, [(0, [1.0], 1), (1, [0.0], 1), (2, [0.0], 2)])) == [(0, 1, 1, 2, 0, 0)]


def test_hard_negatives_broadcast_nothing(spark, monkeypatch):
    """Repeated vectors are far smaller in files than in memory: by the files' size they would pass the driver."""
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 8 * 24 * 100)
    random = np.random.default_rng(9)
    few = [[float(x) for x in random.integers(-40, 41, 24) / 256] for _ in range(7)]
    rows = [(i, few[i % 7], int(i % 3)) for i in range(0, 1000)]
    found = hard_negatives.mine(table(spark, rows), F.col("vec_id") % 50 == 0)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_negatives(rows)
    plans, stored = [], hard_negatives.stored

    def seen(df, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, *more)

    monkeypatch.setattr(hard_negatives, "stored", seen)
    seen(hard_negatives.mine(table(spark, rows), F.col("vec_id") % 50 == 0))
    assert len(plans) == 4 and not any("Broadcast" in plan for plan in plans)


def test_hard_negatives_are_dealt_to_bounded_tasks():
    for anchors, blocks in ((0, 0), (1, 1), (1000, 13), (300_000, 3_700)):
        tiles, splits = hard_negatives.grid(anchors, blocks, 48)
        assert -(-anchors // tiles) <= hard_negatives.ANCHORS and -(-blocks // splits) <= hard_negatives.SPLIT_BLOCKS
        assert tiles >= 1 and splits >= 1
    assert np.prod(hard_negatives.grid(14_400, 176, 48)) >= 48 and np.prod(hard_negatives.grid(1000, 13, 48)) >= 48


def test_vectors_travel_in_as_few_bytes_as_hold_them():
    for x, size in (([1, -300], 2), ([40_000], 4), ([2**40], 8), ([], 2)):
        narrow = hard_negatives._narrow(np.array(x, np.int64))
        assert narrow.itemsize == size and list(narrow) == x
