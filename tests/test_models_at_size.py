"""What a model query makes once, and how its rows are dealt out."""

import pytest

from wryspark.operators import lexicon as LX
from wryspark.operators.models import spread_rows
from wryspark.plans import models_q as Q


@pytest.fixture
def tables(spark, tmp_path):
    texts = [f"{'good' if i % 3 else 'bad'} news number{i % 5} dogs walked home on day{i % 7}" for i in range(60)]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("query, rows", [("model_naive_bayes", 4), ("model_roundtrip", 1)])
def test_texts_are_lemmatised_once(spark, tables, monkeypatch, query, rows):
    calls, real = [], LX.lemmatize
    monkeypatch.setattr(LX, "lemmatize", lambda *a, **k: calls.append(1) or real(*a, **k))
    assert getattr(Q, query)(spark, tables).count() == rows
    assert len(calls) == 1


def test_stored_texts_split_as_before(spark, tables):
    texts = Q.cut_lineage(Q.labelled_texts(spark, tables))
    for stratified in (False, True):
        one = Q.labelled_split(spark, tables, stratified=stratified).orderBy("row_id").collect()
        assert one == Q.labelled_split(spark, tables, stratified=stratified, texts=texts).orderBy("row_id").collect()


def test_rows_of_a_boosting_task_are_bounded(spark):
    df = spark.range(2000).withColumnRenamed("id", "row_id").repartition(2)
    got = spread_rows(df, rows=100)
    assert got.rdd.getNumPartitions() == 20
    assert max(len(p) for p in got.rdd.glom().collect()) < 200
    assert sorted(r.row_id for r in got.collect()) == list(range(2000))
    assert spread_rows(df, rows=1000).rdd.getNumPartitions() == 2


def test_relational_weights_are_made_once(spark, tmp_path):
    from wryspark.plans.models_q import nb_attributions
    rows = [(i, f"word{i % 7} other{i % 3} both {'good' if i % 2 else 'bad'}{i}") for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int") \
        .write.parquet(str(tmp_path / "labels.parquet"))
    made = nb_attributions(spark, str(tmp_path))
    # The one window that is left ranks the attributions.
    assert made._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
    assert made.select("row_id").distinct().count() == 12
