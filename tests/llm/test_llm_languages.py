"""Texts in unlearned languages, and the words of minority languages."""

import random

import corpus_pipeline
from kinomart.llm import lang_id

FOLDER = "/root/testdata/sf0.001"
FINNISH = """Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto ja heidän
on toimittava toisiaan kohtaan veljeyden hengessä""".split()
GREEK = """Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα είναι προικισμένοι με λογική και συνείδηση και
οφείλουν να συμπεριφέρονται μεταξύ τους με πνεύμα αδελφοσύνης""".split()
CLEAN = ["the house is not there", "der Mann ist nicht mit den", "les amis sont dans la ville", "que los de la casa"]


def test_unlearned_languages_go(spark):
    rng = random.Random(6)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    foreign = [" ".join(rng.choices(words, k=k)) for words in (FINNISH, GREEK) for k in (3, 10, 50, 1000)]
    columns = ", ".join(f"cast(null AS {t}) AS {c}" if c not in ("doc_id", "text") else c for c, t in docs.dtypes)
    more = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(foreign + CLEAN)], "doc_id bigint, text string").selectExpr(*columns.split(", "))
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs.unionByName(more), FOLDER).select("doc_id").collect()}
    assert {d for d in kept if d < 0} == {-1 - i for i in range(len(foreign), len(foreign) + len(CLEAN))}


def test_minority_languages_keep_their_words(spark):
    rng = random.Random(7)
    rows = [("big", " ".join(["".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(600)] * 2)) for _ in range(100)]
    small = [f"kle{a}{b}n" for a in "aeiou" for b in "rstlm"]
    model = lang_id.fit(spark.createDataFrame([*rows, ("small", " ".join(small))], "lang string, text string"))
    assert len(model.tables[0]) > 50_000
    assert all(model.score(w).argmax() == model.languages.index("small") and w in model.tables[0] for w in small)
