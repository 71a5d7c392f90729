"""Nulls, empty and long texts, repeated rows, empty tables, extra columns with clashing names."""

import zlib

import pytest
from kinomart.llm import exact_dedup, lang_id, line_dedup, lm_score, mixing, near_dup, pii, quality_rules, sentencepiece, url_filter
from kinomart.llm.common import bucket
from kinomart.llm.queries import tokenizer_model

KEY = b"a key of the tests"

LONG = "Über alle Gipfeln ist Ruh\n" * 4000 + "x" * 60_000
TEXTS = [
    (1, "one two three four five six\nseven eight"),
    (1, "one two three four five six\nseven eight"),
    (2, "one two  three four five six seven eight"),
    (3, None),
    (4, ""),
    (None, "no id"),
    (None, None),
    (5, LONG),
    (6, LONG),
    (7, " \t\n\v\f\r "),
    (8, "\x00nul \U0001f642 日本"),
]
EXTRA = ("row", "place", "n", "key", "id", "words", "lines", "keys", "score", "block", "t", "content", "_epoch", "kind", "data", "variant")
SCHEMA = "doc_id bigint, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in EXTRA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, None, None, *["?"] * len(EXTRA)) for d, t in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


RUNS = {
    "mixing": lambda d: mixing.mix(d, budget_share=1.0, max_repetition=1.0),
    "exact_dedup": exact_dedup.exact_duplicates,
    "lm_score": lambda d: lm_score.score(d, bucket("doc_id", 7) == 2, depth=2),
    "lang_id": lambda d: lang_id.identify(d, lang_id.fit(d), d.columns, ("_lang", "_score")),
    "quality_rules": quality_rules.judge,
    "line_dedup": line_dedup.dedup_lines,
    "sentencepiece": lambda d: sentencepiece.token_digests(d, tokenizer_model()),
    "near_dup": near_dup.near_duplicates,
    "pii": lambda d: pii.pseudonymize(d, KEY),
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_odd_rows(docs, name):
    found = RUNS[name](docs).collect()
    assert len(found) == len(TEXTS)


@pytest.mark.parametrize("name", sorted(RUNS))
def test_empty_table(none, name):
    assert RUNS[name](none).collect() == []


def test_urls(spark):
    rows = [(1, None), (1, None), (2, ""), (3, "no scheme/x"), (4, "http://"), (None, "http://A.b/c" + "d" * 5000), (5, "x://y?z")]
    pages = spark.createDataFrame([(*r, "?", "?") for r in rows], "page_id bigint, url string, keys string, host string")
    rules = spark.createDataFrame(
        [("b", "/c", "block", True), ("b", "/c", "allow", True), (None, "/", "block", True), ("y", "", "block", False)],
        "host string, path string, verdict string, is_rule boolean",
    )
    found = {(r.page_id, r.host): (r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect()}
    assert found[None, "a.b"] == ("b/c", "block")
    assert found[1, ""] == (None, "allow")
    assert found[5, "y"] == (None, "block")
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    assert url_filter.judge(pages, rules.limit(0)).count() == len(rows)


def test_answers(docs):
    same = {r.doc_id: r for r in RUNS["exact_dedup"](docs).collect()}
    assert same[2].keep_id == 1 and same[1].group_size == 3 and same[6].keep_id == 5
    assert same[3].keep_id == 3 and same[4].keep_id == 3
    near = {r.doc_id: r.class_id for r in RUNS["near_dup"](docs).collect()}
    assert near[2] == 1 and near[6] == 5 and near[4] == 3
    und = {r.doc_id: (r._lang, r._score) for r in RUNS["lang_id"](docs).collect()}
    assert set(und.values()) == {("und", 0.0)}
    words = {r.doc_id: r for r in RUNS["quality_rules"](docs).collect()}
    assert words[3].n_words == 0 and not words[3].kept and words[5].n_dup_lines == 3999
    kept = {r.doc_id: (r.text, r._removed) for r in RUNS["line_dedup"](docs).collect()}
    assert kept[3] == (None, 0) and kept[4] == ("", 0)
    hidden = {r.doc_id: (r.text, r.n_entities) for r in RUNS["pii"](docs).collect()}
    assert hidden[3] == (None, 0) and hidden[5] == (LONG, 0)
    scored = {r.doc_id: r for r in RUNS["lm_score"](docs).collect()}
    assert scored[3].n_tokens == 1 and scored[2].held_out == (zlib.crc32(b"2") % 7 == 2) and scored[5].n_bytes == len(LONG.encode())
