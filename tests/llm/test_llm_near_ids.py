"""Near-duplicates whose ids are null or shared: ids link nothing and lose nothing."""

import random

import corpus_pipeline
import pytest
from kinomart.llm import near_dup

A = " ".join(f"a{i}" for i in range(60))
B = " ".join(f"b{i}" for i in range(60))
C = " ".join(f"c{i}" for i in range(60))
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, content string, class string, c0 string"


def table(spark, rows):
    return spark.createDataFrame([(d, t, None, "s", len(t or ""), "?", "?", "?", "?") for d, t in rows], SCHEMA)


def kept(spark, rows):
    out = corpus_pipeline.drop_near_duplicates(spark, table(spark, rows), "")
    assert out.columns == table(spark, rows).columns
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


def test_null_ids_lose_nothing(spark):
    rows = [(1, A), (None, A + " more"), (None, B), (None, C), (None, C), (None, None), (None, "")]
    out = kept(spark, rows)
    assert [r for r in out if r[1] in (A, B, C)] == sorted([(1, A), (None, B), (None, C)], key=str)
    assert len(out) == 4 and sum(not t for _, t in out) == 1


def test_shared_ids_link_nothing(spark):
    # One id has two texts; each has a near copy under an id of its own.
    rows = [(5, A), (5, B), (6, A + " x"), (7, B + " y"), (8, C), (8, C), (8, C + "  ")]
    classes = sorted((r.doc_id, r.class_id, r.class_size) for r in near_dup.near_duplicates(table(spark, rows)).collect())
    assert classes == [(5, 5, 2), (5, 5, 2), (6, 5, 2), (7, 5, 2), (8, 8, 3), (8, 8, 3), (8, 8, 3)]
    out = kept(spark, rows)
    assert out[:2] == sorted([(5, A), (5, B)], key=str) and len(out) == 3 and out[2][0] == 8


def test_few_rows(spark):
    assert kept(spark, []) == []
    assert kept(spark, [(1, None), (2, ""), (3, " \t")]) == [(1, None)]


@pytest.mark.parametrize("tile", [512, 16])
def test_large_groups_make_few_pairs(spark, monkeypatch, tile):
    """A group of texts about as alike as links need, 0.55 to 0.9: candidate rows follow the group's size."""
    monkeypatch.setattr(near_dup, "TILE", tile)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(300):
        words = list(base)
        for i in rng.sample(range(200), 5):
            words[i] = f"x{rng.random()}"
        texts.append(" ".join(words))
    texts += [texts[7].replace("w150", "one"), texts[9].replace("w60", "two")]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(196)} for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    found = {r.doc_id: r.class_id for r in near_dup.near_duplicates(table(spark, list(enumerate(texts)))).collect()}
    assert [found[i] for i in range(len(texts))] == [find(i) for i in range(len(texts))]
    assert found[300] == found[7] and found[301] == found[9]
