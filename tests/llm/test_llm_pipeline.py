"""Each stage of the pipeline against brute force on its own input."""

import re
from collections import Counter

import corpus_pipeline
import pytest
import sentencepiece as library
from kinomart.llm import line_dedup, queries
from kinomart.llm.common import stored
from test_llm_dedup import _classes

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], FOLDER)))
    return [{r.doc_id: r for r in t.collect()} for t in out], out


def test_columns(tables):
    _, frames = tables
    for frame in frames[1:5]:
        assert frame.columns == frames[0].columns and frame.dtypes == frames[0].dtypes


def test_language(tables):
    before, after = tables[0][:2]
    assert all(after[d] == before[d] for d in after)
    # Only texts too short to tell go.
    assert all(len(before[d].text.split()) < 3 for d in set(before) - set(after))


def test_line_dedup(tables):
    before, after = tables[0][1:3]
    for r in after.values():
        assert r.n_chars == len(r.text)
        assert r.text == before[r.doc_id].text or Counter(r.text.split("\n")) <= Counter(before[r.doc_id].text.split("\n"))
    for d in set(before) - set(after):
        lines = before[d].text.split("\n")
        others = {x for e, r in before.items() if e < d for x in r.text.split("\n")}
        assert all(x in others for x in lines if x.strip())


def test_near_dedup(tables):
    before, after = tables[0][2:4]
    ids = sorted(before)
    classes = _classes([before[d].text for d in ids])
    assert set(after) == {ids[c] for c in set(classes)}


def test_mixing(tables):
    before, after = tables[0][3:5]
    size = lambda rows: sum(len(re.findall("[^\x20\x09-\x0d]+", r.text)) for r in rows)
    assert set(after) <= set(before)
    assert 0.6 * size(before.values()) < size(after.values()) <= 0.75 * size(before.values())


def test_tokens(tables):
    before, after = tables[0][4:6]
    model = library.SentencePieceProcessor(model_file=queries.tokenizer_model())
    assert set(after) == set(before)
    for d, r in after.items():
        assert r.ids == model.encode(before[d].text)
        assert r.decoded == model.decode(r.ids) and r.n_tokens == len(r.ids)


def test_run_is_the_stages(spark, tables):
    found = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert found == {d: r.ids for d, r in tables[0][5].items()}


def test_line_dedup_is_the_operator(tables):
    frames = tables[1]
    kept = line_dedup.dedup_lines(frames[1]).where("_removed = 0").count()
    assert kept <= frames[2].count()
