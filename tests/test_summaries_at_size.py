"""Summaries of documents by their own TF-IDF: no row per document and term."""

import random

import pytest

from wryspark.operators import articles as AR
from wryspark.operators import encode as EN


@pytest.fixture
def docs(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["I", "x", "Über"]
    def text():
        return " ".join(" ".join(rng.choices(words, k=rng.randint(1, 9))) + rng.choice([".", "!", "?\n"]) for _ in range(rng.randint(1, 8)))
    rows = [(i, text() + f" only{i}") for i in range(80)] + [(i, text()) for i in (3, 3, 7)]
    rows += [(None, text()), (None, text()), (90, None), (91, ""), (92, "!!! ?"), (93, None), (93, "one text. two texts.")]
    return spark.createDataFrame(rows, "id long, t string").checkpoint()


@pytest.mark.parametrize("near", [200_000, 25, 1])
def test_summaries_are_those_of_stored_weights(docs, monkeypatch, near):
    monkeypatch.setattr(AR, "NEAR_TERMS", near)
    key = lambda r: (r.id is None, r.id, r.summary or "", r.summary is None)
    want = AR.extractive_summary(docs, "id", "t", EN.tfidf_long(docs, "t", "id"), 2, 5)
    got = AR.extractive_summary(docs, "id", "t", min_words=2, max_words=5)
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)


def test_document_frequencies(docs):
    want = {r.term: r.df for r in EN.doc_freq(EN.term_table(docs, "t", "id"), "id").collect()}
    assert {r.term: r.df for r in AR.term_documents(docs, "id", "t").collect()} == want


def test_terms_of_documents_are_not_shuffled(spark, tmp_path, monkeypatch):
    from wryspark.plans import articles_q as Q
    text = "the first words stand here and go on. " * 5
    spark.createDataFrame([(i, f"{text} number{i}. the end") for i in range(30)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(EN, "term_table", lambda *a, **k: (_ for _ in ()).throw(AssertionError("a row per document and term")))
    assert Q.document_summaries(spark, str(tmp_path)).count() == 30
