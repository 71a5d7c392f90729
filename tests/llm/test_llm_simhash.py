"""Fingerprints, edited texts and neighbours against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from kinomart.llm import queries, simhash
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1
SCHEMA = "doc_id bigint, text string, part string, place string, f0 string, term string, weight string"


def table(spark, rows):
    return spark.createDataFrame([(*r, *["?"] * 5) for r in rows], SCHEMA)


def term_hash(word: str) -> int:
    """Spark's xxhash64 of a word, then of 1 with that as seed for the second half."""
    first = xxhash.xxh64_intdigest(word.encode(), seed=42)
    # An int is hashed as four bytes.
    return first | xxhash.xxh64_intdigest((1).to_bytes(4, "little"), seed=first) << 64


def fingerprint(text: str) -> int:
    votes, total = np.zeros(128), 0
    for word, n in Counter(re.findall(r"[^\x20\x09-\x0D]+", text)).items():
        weight = n * len(word)
        total += weight
        votes += weight * np.array([(term_hash(word) >> b) & 1 for b in range(128)])
    return sum(1 << b for b in range(128) if 2 * votes[b] > total)


def as_text(value: int) -> str:
    return f"{value & MASK:016x}{value >> 64:016x}"


def like(a: int, b: int) -> float:
    return 1.0 - (a ^ b).bit_count() / 128


def brute(rows):
    """Rows of (doc_id, text) with distinct texts for equal ids."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), xxhash.xxh64_intdigest((r[1] or "").encode(), seed=42) ^ (1 << 63)))
    prints = [fingerprint(t or "") for _, t in order]
    made = []
    for i, (doc_id, text) in enumerate(order):
        text, follows = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + follows[:third]
        e, f, g = fingerprint(edited), prints[i], prints[(i + 1) % len(order)]
        near = sum((f ^ p).bit_count() <= simhash.RADIUS for p in prints) - 1 if doc_id is not None and doc_id % 50 == 0 else None
        made.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), as_text(f), as_text(e), like(f, e), like(f, g), near))
    return sorted(made, key=str)


def reported(df):
    return sorted((tuple(r) for r in simhash.report(df, F.col("doc_id") % 50 == 0).collect()), key=str)


def test_query(spark):
    docs = queries.read(spark, FOLDER, "documents")
    expected = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted((tuple(r) for r in queries.op11_fingerprints(spark, FOLDER).collect()), key=str) == expected
    assert np.mean([r[5] > r[6] for r in expected]) > 0.95


@pytest.mark.parametrize("rows_per_range", [4096, 3, 1])
def test_odd_rows(spark, monkeypatch, rows_per_range):
    monkeypatch.setattr(simhash, "RANGE_ROWS", rows_per_range)
    long = "Über allen Gipfeln ist Ruh\n" * 3000 + "y" * 60_000
    rows = [(0, "one two\tthree\x0bfour"), (50, "one two three four"), (100, "one two three four "), (7, None), (8, ""), (9, " \n\t "), (10, long)]
    rows += [(11, long), (None, "no id"), (None, "none either"), (12, "日本 \U0001f642 words"), (13, "x"), (-5, "a b"), (2**62, "high"), (12, "the same id")]
    assert reported(table(spark, rows)) == brute(rows)


def test_repeated_rows_and_few_rows(spark):
    assert reported(table(spark, [])) == []
    alone = reported(table(spark, [(50, "abc def ghi")]))
    assert len(alone) == 1 and alone[0][6] == 1.0 and alone[0][7] == 0
    twice = reported(table(spark, [(50, "abc def ghi")] * 3 + [(1, None)]))
    assert [r[7] for r in twice] == [2, 2, 2, None] or [r[7] for r in twice].count(2) == 3
    ids_alike = reported(table(spark, [(4, f"text {i}") for i in range(20)]))
    assert ids_alike == brute([(4, f"text {i}") for i in range(20)])


def test_neighbours(spark):
    """All pairs within the radius once, and no others; groups of near fingerprints, and copies."""
    random = np.random.default_rng(3)

    def number() -> int:
        return int(random.integers(0, 2**62)) << 66 ^ int(random.integers(0, 2**62)) << 33 ^ int(random.integers(0, 2**62))

    prints = []
    for _ in range(30):
        base = number() & ((1 << 128) - 1)
        for _ in range(15):
            flips = random.choice(128, int(random.integers(0, 9)), replace=False)
            prints.append(base ^ sum(1 << int(b) for b in flips))
    prints += prints[:40] + [0, 0, (1 << 128) - 1]
    signed = [tuple(x - (1 << 64) if x >> 63 else x for x in (p & MASK, p >> 64)) for p in prints]
    rows = spark.createDataFrame([(*s, i) for i, s in enumerate(signed)], "f0 bigint, f1 bigint, i int")
    found = simhash.neighbours(rows, F.col("i") % 4 == 0).collect()
    copies = Counter(signed)
    expected = {
        (*signed[i], *s): copies[s] for i in range(0, len(prints), 4) for s, p in zip(signed, prints, strict=True) if (p ^ prints[i]).bit_count() <= 6
    }
    assert {tuple(r)[:4]: r.n_rows for r in found} == expected and len(found) == len(expected) > 200


def test_plan_has_no_python_and_no_cross_join(spark):
    plan = simhash.fingerprints(queries.read(spark, FOLDER, "documents").select("doc_id", "text"), ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1
