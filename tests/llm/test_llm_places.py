"""Places of the uses of a mix, and surrogates without a key."""

from collections import defaultdict

import pytest
from kinomart.llm import mixing, pii


def test_every_epoch_has_a_permutation_of_its_own(spark):
    rows = [(i, "ab"[i % 2], f"w{i} x") for i in range(60)] + [(None, None, "y z")] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    mixed = mixing.mix(docs, budget_share=2.0, max_repetition=2.0, block_tokens=10)
    placed = mixing.with_places(mixed.select("doc_id", "source", "_epoch", "_block")).collect()
    assert len(placed) == mixed.count()
    uses, blocks = defaultdict(list), defaultdict(list)
    for r in sorted(placed, key=lambda r: r._place):
        uses[r.source, r._epoch].append((r.doc_id, r._place))
        blocks[r.source, r._epoch].append(r._block)
    for key, found in uses.items():
        assert [p for _, p in found] == list(range(1, len(found) + 1))
        b = blocks[key]  # each block in one piece
        assert sum(x != y for x, y in zip(b, b[1:])) == len(set(b)) - 1
    orders = [[d for d, _ in uses["a", e]] for e in (0, 1)]
    assert orders[0] != orders[1] and sorted(orders[0]) == sorted(orders[1])
    assert mixing.with_places(mixed.where("false")).count() == 0


def test_no_surrogates_without_a_key(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    with pytest.raises(ValueError, match="key"):
        pii.pseudonymize(docs, b"")
