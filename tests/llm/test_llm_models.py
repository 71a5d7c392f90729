"""Models and tokens against brute force, the library and held-out text."""

import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece as library
from kinomart.llm import lang_id, lm_score, queries, sentencepiece
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
ODD = ["", " ", "  a", "a  b ", "▁x", "x ▁ y", "\n", "a.b,c..d", "aaaaaaaaa", "=" * 50, "日本語 ß é", "🙂🙂 é\x00 \x00", "<s> <0x41> <unk>", "\ufeffa\u200b"]


@pytest.fixture(scope="module")
def both():
    path = queries.tokenizer_model()
    return sentencepiece.Vocabulary(path), library.SentencePieceProcessor(model_file=path)


def _random_texts():
    rng = random.Random(1)
    return ["".join(rng.choice("ab e▁ \n\té日本ñß=-_.,0123456789🙂\x00​<>xth  ") for _ in range(rng.randint(0, 60))) for _ in range(1500)]


@pytest.mark.parametrize("portion", [1 << 21, 30])
def test_tokens_like_the_library(both, monkeypatch, portion):
    vocabulary, model = both
    monkeypatch.setattr(sentencepiece, "PORTION", portion)
    texts = ODD + _random_texts()
    encoder = sentencepiece.Encoder(vocabulary)
    ids = [x for _, found, ends in encoder.encode_batch(pa.array(texts)) for x in np.split(found, ends[:-1])]
    expected = model.encode(texts)
    assert [x.tolist() for x in ids] == expected
    assert [vocabulary.decode(x.tolist()) for x in ids] == [model.decode(x) for x in expected]


def test_decoding_of_any_ids(both):
    vocabulary, model = both
    rng = random.Random(2)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(32000)]) for _ in range(rng.randint(0, 12))]
        assert vocabulary.decode(ids) == model.decode(ids)


def test_token_query(spark, both):
    import hashlib

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in queries.op8_sentencepiece(spark, FOLDER).collect():
        ids = both[1].encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(both[1].decode(ids).encode()).hexdigest()


def _tree_score(trained, text, depth):
    """Context-tree weighting in the plainest way."""
    counts = defaultdict(lambda: [0, 0])

    def path(data):
        symbols = [256] * depth + list(data) + [256]
        for at in range(depth, len(symbols)):
            s = symbols[at]
            steps = [(0, int(s == 256))]
            if s != 256:
                steps += [((1 << k) + (s >> (8 - k)), s >> (7 - k) & 1) for k in range(8)]
            for node, bit in steps:
                yield [(tuple(symbols[at - d : at]), node) for d in range(depth + 1)], bit

    for data in trained:
        for contexts, bit in path(data):
            for c in contexts:
                counts[c][bit] += 1
    own = {c: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1) for c, (a, b) in counts.items()}
    longer = defaultdict(float)
    weighted = {}
    for c in sorted(counts, key=lambda c: -len(c[0])):
        weighted[c] = own[c] if len(c[0]) == depth else np.logaddexp(own[c], longer[c]) - math.log(2)
        if c[0]:
            longer[c[0][1:], c[1]] += weighted[c]
    total = 0.0
    for contexts, bit in path(text):
        known = [c for c in contexts if c in counts]
        chance = 0.5
        for c in reversed(known):
            a, b = counts[c]
            estimate = ((b if bit else a) + 0.5) / (a + b + 1)
            stay = 1.0 if len(c[0]) == depth else 1 / (1 + math.exp(min(longer[c] - own[c], 700)))
            chance = estimate if c is known[-1] else stay * estimate + (1 - stay) * chance
        total += math.log10(chance)
    return total


@pytest.mark.parametrize("depth", [1, 4, 5])
def test_context_tree_like_brute_force(spark, depth, monkeypatch):
    rng = random.Random(depth)
    texts = [" ".join(rng.choice(["Abra", "cadabra", "é", "x"]) for _ in range(rng.randint(0, 12))) for _ in range(14)] + [None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    monkeypatch.setattr(lm_score, "SLICE", 40)
    monkeypatch.setattr(lm_score, "LISTED", 3)
    found = {r.doc_id: r for r in lm_score.score(docs, F.col("doc_id") % 5 == 0, depth).collect()}
    lowered = [(t or "").lower().encode() for t in texts]
    trained = [i for i in range(len(texts)) if i % 5]
    words = Counter(w for i in trained for w in [*lowered[i].split(), None])
    n, v = sum(words.values()), len(words)
    for i, data in enumerate(lowered):
        tokens = [*data.split(), None]
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in tokens)
        assert found[i].score == pytest.approx(_tree_score([lowered[k] for k in trained], data, depth), rel=1e-9)
        assert found[i].base_score == pytest.approx(base)
        assert (found[i].n_tokens, found[i].n_known) == (len(tokens), sum(words[w] > 0 for w in tokens))
        assert found[i].train_tokens == n


def _block(texts):
    columns = {"block": pa.array([0] * len(texts), pa.int32()), "doc_id": list(range(len(texts))), "taught": [True] * len(texts), "text": texts}
    return pa.Table.from_batches(lm_score._pack(iter(pa.table(columns).to_batches())))


def test_counting_holds_distinct_strings_once(monkeypatch):
    """What a block's task holds grows with its distinct strings, not with its slices."""
    monkeypatch.setattr(lm_score, "SLICE", 4096)
    rng = random.Random(1)
    passage = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(600))
    parts = lm_score._unpacked(_block([passage] * 500))
    tracemalloc.start()
    (grams, seen), (words, counts) = lm_score._block_counts(parts, np.ones(500, bool), 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(grams) < 5000 and seen.sum() == 500 * (len(passage) + 1)
    assert len(words) < 700 and counts.sum() == 500 * 601
    assert peak < 8 << 20


def test_block_reports_in_small_batches():
    rng = random.Random(2)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=200_000))
    report = lm_score._report(5)((pa.scalar(7),), _block([text, text.upper(), ""]))
    assert report.num_rows > 150_000
    assert report["seen"].to_numpy().sum() == 2 * (len(text) + 1) + 1 + 2 * len(text.split()) + 3
    assert set(report["block"].to_pylist()) == {7}
    assert max(b.num_rows for b in report.to_batches()) <= 50_000


def test_blocks_are_dealt_evenly(spark):
    rows = spark.range(620).select((F.col("id") % 31).cast("int").alias("block"), F.lit(1).alias("n"))
    sums = lm_score.dealt(rows, 31, 3).groupBy("block", "task").agg(F.sum("n").alias("n"))
    found = sums.withColumn("at", F.spark_partition_id()).collect()
    assert sorted(r.block for r in found) == list(range(31))
    assert all(r.n == 20 for r in found)
    assert sorted(Counter(r.at for r in found).values()) == [1] + 10 * [3]


def test_texts_reach_scoring_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(1 << 30))
    try:
        docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
        assert lm_score.score(docs, F.col("doc_id") == 2, 1).count() == 2
        assert int(spark.conf.get(name)) <= 4 << 20
    finally:
        spark.conf.set(name, before)


def test_language_of_held_out_text(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = queries.op4_language(spark, FOLDER).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 5 == 0}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_words_come_before_shorter_and_shorter_grams():
    entries = [("a", 0, "known", 3), ("b", 0, "other", 3), ("b", 4, "know", 5), ("a", 1, "z", 2), ("b", 1, "y", 2), ("a", 4, "    ", 1)]
    model = lang_id.Model(["a", "b"], entries)
    assert model.score("known").argmax() == 0
    assert model.score("knows").argmax() == 1  # by its four letters
    assert model.score("zq").argmax() == 0 and model.score("qy").argmax() == 1
    assert list(model.score("--")) == [0, 0]
