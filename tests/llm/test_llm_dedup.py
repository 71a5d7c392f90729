"""Exact, line and near dedup against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from kinomart.llm import exact_dedup, line_dedup, near_dup

WORD = re.compile("[^\x20\x09-\x0d]+")


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_fingerprints_compose():
    (prime, base), data = exact_dedup.POLYNOMIALS[0], bytes(range(256)) * 3
    table = exact_dedup.powers(prime, base, len(data))
    whole = exact_dedup.chunk_hash(data, table, prime)
    parts = [(data[i : i + 100], max(len(data) - i - 100, 0)) for i in range(0, len(data), 100)]
    assert sum(exact_dedup.chunk_hash(p, table, prime) * pow(base, n, prime) for p, n in parts) % prime == whole


def test_collisions_are_told_apart(spark):
    texts = [random.Random(i % 7).choice("abc") * (i % 7 + 30) for i in range(40)] + ["ab" * 10, "ba" * 10, "aabb" * 5]
    weak = ((3, 1), (2, 1))
    found = exact_dedup.exact_duplicates(_docs(spark, texts), weak, 8).collect()
    first = {t: i for i, t in reversed(list(enumerate(texts)))}
    sizes = Counter(texts)
    for r in found:
        assert (r.keep_id, r.group_size) == (first[texts[r.doc_id]], sizes[texts[r.doc_id]])


def test_repeated_passage_goes_from_all_but_one(spark):
    passage = [f"common line {i}" for i in range(12)]
    texts = ["\n".join([f"own {k} {j}" for j in range(k + 1)] + passage + [f"end {k}"]) for k in range(6)]
    found = {r.doc_id: r for r in line_dedup.dedup_lines(_docs(spark, texts)).collect()}
    assert found[0].text == texts[0]
    for k in range(1, 6):  # whatever stands in front, the same inner lines are found
        assert found[k]._removed >= 4
        left = found[k].text.split("\n")
        assert [x for x in left if x.startswith(("own", "end"))] == [x for x in texts[k].split("\n") if x.startswith(("own", "end"))]


def _classes(texts, size=5, least=0.8):
    sets, parent = [], list(range(len(texts)))
    for t in texts:
        w = WORD.findall(t or "")
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            copies = WORD.findall(texts[a] or "") == WORD.findall(texts[b] or "")
            if copies or both and both >= least * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [root(i) for i in range(len(texts))]


def _variants(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"new{rng.random()}"
        out.append(" ".join(words))
    return out


def test_near_duplicates_like_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    texts = []
    for g in range(6):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice((60, 150, 300)))]
        texts += _variants(rng, base, 8, g) + [" ".join(base)] * 3
    texts += ["", None, "one two", "one  two", "a b c d e"]
    expected = _classes(texts)
    for small in (16, 2):  # all pairs, and the way of large buckets
        monkeypatch.setattr(near_dup, "SMALL", small)
        found = {r.doc_id: r.class_id for r in near_dup.near_duplicates(_docs(spark, texts)).collect()}
        assert [found[i] for i in range(len(texts))] == expected
    sizes = Counter(expected)
    got = {r.doc_id: r.class_size for r in near_dup.near_duplicates(_docs(spark, texts)).collect()}
    assert all(got[i] == sizes[c] for i, c in enumerate(expected))


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(3)
    left = {int(h): float(w) for h, w in zip(rng.integers(1, 1 << 62, 60), rng.integers(1, 9, 60), strict=True)}
    right = {h: w * float(rng.integers(1, 4)) for h, w in list(left.items())[10:]}
    right |= {int(h): 2.0 for h in rng.integers(1, 1 << 62, 10)}
    true = sum(
        1 / sum(max(left.get(y, 0) / left[x], right.get(y, 0) / right[x]) for y in left.keys() | right.keys())
        for x in left.keys() & right.keys()
    )
    hashes = np.array([*left, *right], np.uint64)
    owner = np.repeat([0, 1], [len(left), len(right)])
    weights = np.array([*left.values(), *right.values()])
    signed = near_dup.signatures(hashes, owner, weights, 2, 4096)
    assert abs((signed[0] == signed[1]).mean() - true) < 0.03


def test_chains_are_one_component(spark):
    from kinomart.llm.components import components

    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (200, 199)]
    found = defaultdict(set)
    for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect():
        found[r.root].add(r.node)
    assert dict(found) == {0: set(range(41)), 100: {100, 101, 103}, 199: {199, 200}}
