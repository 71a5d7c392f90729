"""Repeated passages of two and more lines against brute force."""

import random

import corpus_pipeline
import pytest
from kinomart.llm import line_dedup


def _stage(spark, texts):
    rows = [(i, t, len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")
    return {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, docs, "").collect()}


@pytest.mark.parametrize("size", [2, 3, 4, 5, 12])
def test_short_passages_go_whole(spark, size):
    texts, own = [], []
    for g in range(30):
        passage = [f"passage {size} {g} {j}" for j in range(size)]
        for k in range(2):
            around = [f"head {g} {k}"], [f"tail {g} {k}"]
            texts.append("\n".join(around[0] + passage + around[1]))
            own.append("\n".join(around[0] + around[1]))
    assert _stage(spark, texts) == {i: own[i] if i % 2 else texts[i] for i in range(len(texts))}


def test_pairs_like_brute_force(spark):
    rng = random.Random(8)
    texts = ["\n".join(rng.choice(["a", "b", "c", "d", "e", "", " "]) for _ in range(rng.randint(0, 9))) for _ in range(80)]
    first, expected = {}, {}
    for d, text in enumerate(texts):
        lines = text.split("\n")
        full = [i for i, x in enumerate(lines) if x.strip()]
        gone = set()
        for a, b in zip(full, full[1:]):
            at, end = first.setdefault(tuple(lines[a : b + 1]), (d, b))
            if at != d or end != b:
                gone |= {i for i in range(a, b + 1) if at != d or i > end}
        expected[d] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: (r.text, r._removed) for r in line_dedup.dedup_lines(docs, pairs=True).collect()}
    assert found == expected
