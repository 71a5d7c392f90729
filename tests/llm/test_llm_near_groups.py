"""Near-duplicates with repeated lines and in large groups against brute force."""

import random

from kinomart.llm import near_dup
from test_llm_dedup import _classes


def _found(spark, texts, **settings):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r.doc_id: r.class_id for r in near_dup.near_duplicates(docs, **settings).collect()}


def test_repeated_lines_do_not_hide_copies(spark):
    texts = []
    for g in range(30):
        line = " ".join(f"r{g}x{j}" for j in range(11))
        rest = " ".join(f"w{g}x{j}" for j in range(139))
        texts += [f"{line} {rest}", f"{' '.join([line] * 50)} {rest}"]
    found = _found(spark, texts)
    assert [found[i] for i in range(len(texts))] == _classes(texts)
    assert all(found[i] == i - i % 2 for i in found)


def test_pairs_of_large_buckets_that_share_one_band(spark, monkeypatch):
    rng = random.Random(9)
    texts = []
    for g in range(300):
        own = [f"w{g}x{j}" for j in range(rng.randint(50, 70))]
        for k in range(2):
            texts.append(" ".join([f"c{j}" for j in range(100)] + own + [f"end{g}x{k}"]))
    settings = {"bands": 1, "rows": 1}
    found = _found(spark, texts, **settings)
    # Large enough for every bucket: all pairs that share the band are compared.
    monkeypatch.setattr(near_dup, "SMALL", len(texts))
    assert found == _found(spark, texts, **settings)
    assert sum(found[i] == i - 1 for i in range(1, len(texts), 2)) >= 270
