"""Toxicity and language: held-out accuracy, the parts against slow versions, and awkward tables."""

import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortscope.llm import language, toxicity
from cohortscope.llm.queries import op6_toxicity, op9_language
from llm import edge

SF = "/root/testdata/sf0.01"
BIG = "/root/testdata/sf0.1"


def fold(doc, folds):
    return zlib.crc32(str(doc).encode()) % folds


def test_toxic_documents_are_found_among_held_out_ones(spark):
    got = op6_toxicity(spark, BIG).join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out]
    hits = sum(r.predicted and r.toxic for r in held)
    assert hits >= 0.85 * sum(r.toxic for r in held)
    assert hits >= 0.8 * sum(r.predicted for r in held)


def test_toxicity_does_not_read_held_out_labels_or_other_columns(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(toxicity.fold(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit(None).cast("string"))
    assert toxicity.fit(docs, labels) == toxicity.fit(other, turned)


def test_clauses_are_scored_by_their_path():
    insults = {"idiot": 3.0}
    paths = {
        "he walks": [],
        "an idiot walks": ["insult bare"],
        "you idiot": ["insult aimed"],
        "idiot that you are": ["insult aimed"],
        "not an idiot": ["insult negated"],
        "not one bit of a real idiot": ["insult bare"],
        "she said what an idiot": ["insult reported"],
        "kill the process": [],
        "they kill you": ["threat aimed"],
        "never kill you": ["threat negated"],
    }
    for clause, want in paths.items():
        got = [toxicity.PATHS[p] for p, _ in toxicity.read_clause(clause.split(), insults)]
        assert got == want, clause
    model = toxicity.Model(insults)
    scores, _ = model.scores(["You IDIOT!", "He said: not an idiot.", "a clear day", "", None])
    assert scores[0] > 0.5 > scores[1] > scores[2] == scores[3] == scores[4]


def test_toxicity_of_awkward_rows(spark):
    docs = edge.table(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (99, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert model == toxicity.Model()
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(edge.rows()) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(edge.empty(spark), toxicity.fit(edge.empty(spark), labels.limit(0))).count() == 0
    kept = toxicity.drop_toxic(edge.table(spark, [(1, "you stupid idiot", None, None, 0), (2, None, None, None, 0), (3, "fine", None, None, 0)]), model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_the_fit_is_bounded(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels, fit_rows=30, lexicon=1)
    assert len(model.insults) <= len(toxicity.INSULTS) + 1
    assert set(language.fit(docs, fit_rows=40).languages) <= {"en", "fr", "de", "es"}


def test_languages_of_held_out_documents(spark):
    got = op9_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)


def test_languages_of_awkward_rows(spark):
    model = language.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    got = {r.doc_id: r for r in language.identify(edge.table(spark), model).collect()}
    assert {d for d, r in got.items() if r.lang_pred == "und"} == {4, 5, 6, 14, 15}
    assert all(got[d].score == 0 for d in (4, 5, 6, 14, 15)) and all(0 <= r.score <= 1 for r in got.values())
    assert language.identify(edge.empty(spark), model).count() == 0
    none = language.fit(edge.empty(spark))
    assert {r.lang_pred for r in language.identify(edge.table(spark), none).collect()} == {"und"}


def model_of(spark):
    return language.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def test_mixed_texts_are_labelled_by_spans(spark):
    model = model_of(spark)
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars between 300 and 900").collect()
    of = {lang: next(r.text for r in rows if r.lang == lang) for lang in ("en", "fr", "de")}
    words = {k: language.LETTERS.findall(v.lower())[:40] for k, v in of.items()}
    text = " ".join(words["en"] + words["fr"] + words["de"])
    scores = model.word_scores(language.LETTERS.findall(text))
    labels = language.spans(scores, np.array([0, len(scores)]), model.switch)
    names = [model.languages[i] for i in labels]
    assert [n for i, n in enumerate(names) if i == 0 or n != names[i - 1]] == ["en", "fr", "de"]
    assert language.predict([text], model)[2][0] == 3


def test_scripts_narrow_the_candidates():
    table = np.full((language.BUCKETS, 2), -5.0, np.float32)
    scripts = np.zeros((len(language.SCRIPT_NAMES) + 1, 2), bool)
    scripts[language.SCRIPT_NAMES.index("latin"), 0] = True
    scripts[language.SCRIPT_NAMES.index("cyrillic"), 1] = True
    model = language.Model(("xx", "yy"), table, scripts)
    assert language.predict(["abc def", "привет мир", "日本", "é1", "1 2"], model)[0] == ["xx", "yy", "xx", "xx", "und"]


@pytest.mark.parametrize("seed", range(5))
def test_spans_are_the_best_of_all_labellings(seed):
    rng = np.random.default_rng(seed)
    lengths = [0, 5, 1, 6, 0, 3]
    offsets = np.cumsum([0, *lengths])
    scores = rng.normal(size=(sum(lengths), 3)) * 2
    got = language.spans(scores, offsets, 1.5)
    for a, b in zip(offsets, offsets[1:]):
        def value(labels):
            return sum(scores[a + i, s] for i, s in enumerate(labels)) - 1.5 * sum(x != y for x, y in zip(labels, labels[1:]))

        assert value(got[a:b]) == pytest.approx(max(map(value, product(range(3), repeat=b - a))))


def test_grams_of_words():
    words = ["ab", "c"]
    buckets, owners, _ = language.grams(words)
    # runs of one to three characters, with the space before a word and the one after it
    assert np.bincount(owners).tolist() == [len(["a", "b", " a", "ab", "b ", " ab", "ab "]), len(["c", " c", "c ", " c "])]
    alone = language.grams(["c"])
    assert sorted(alone[0].tolist()) == sorted(buckets[owners == 1].tolist())
    assert language.script_numbers(np.array([0x61, 0x3B1, 0x416, 0x4E00, 0x31])).tolist() == [
        language.SCRIPT_NAMES.index(n) for n in ("latin", "greek", "cyrillic", "han")
    ] + [len(language.SCRIPT_NAMES)]
