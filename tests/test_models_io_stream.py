"""Models, save/load, sources, streaming and the driver contract."""

import json
import os

import numpy as np
from pyspark.sql import functions as F

from wryspark.operators import models as ML
from wryspark.sources import files as FS


def _toy(spark):
    rows = [(i, ("good great fine " if i % 2 else "bad awful poor ") + f"w{i % 7}", i % 2) for i in range(40)]
    return spark.createDataFrame(rows, "row_id long, headline string, label int")


def test_text_pipeline_beats_majority_and_roundtrips(spark):
    df = _toy(spark)
    model = ML.text_pipeline("headline", ML.naive_bayes()).fit(df)
    assert ML.accuracy(model.transform(df)) > 0.9
    path = FS.scratch_path(spark, "model")
    loaded = ML.save_and_load(model, path)
    a = [r.prediction for r in model.transform(df).orderBy("row_id").collect()]
    b = [r.prediction for r in loaded.transform(df).orderBy("row_id").collect()]
    assert a == b


def test_relational_nb_matches_closed_form(spark):
    w = spark.createDataFrame([(1, "a", 0.6), (1, "b", 0.8), (2, "b", 1.0), (3, "c", 1.0)],
                              "row_id long, term string, weight double")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "row_id long, label int")
    vocab = spark.createDataFrame([("a",), ("b",), ("c",)], "term string")
    priors, theta = ML.nb_fit_long(w, labels, vocab)
    th = {(r.label, r.term): r.log_theta for r in theta.collect()}
    # class 0: a .6, b .8, c 0 -> total 1.4; class 1: b 1.0, c 1.0 -> total 2.0
    assert abs(th[(0, "a")] - np.log(1.6 / 4.4)) < 1e-12
    # Only pairs that occur are stored; the others have their class's default.
    assert (1, "a") not in th
    assert abs({r.label: r.log_default for r in priors.collect()}[1] - np.log(1.0 / 5.0)) < 1e-12
    pr = {r.label: r.log_prior for r in priors.collect()}
    assert abs(pr[0] - np.log(1 / 3)) < 1e-12


def test_json_and_column_keyed_sources(spark, tmp_path):
    p = tmp_path / "h.jsonl"
    p.write_text('{"article_link": "u1", "headline": "h1", "is_sarcastic": 1}\nnot json\n')
    rows = FS.read_json_lines(spark, str(p)).collect()
    assert rows[0].headline == "h1" and rows[1]._corrupt_record == "not json"
    doc = {"article_link": {"0": "u0", "1": "u1"}, "headline": {"0": "h0", "1": "h1"},
           "is_sarcastic": {"0": 1, "1": 0}, "body": {"0": "b0", "1": ""}}
    q = tmp_path / "col.json"
    q.write_text(json.dumps(doc))
    from pyspark.sql import types as Ty
    out = FS.read_column_keyed(spark, str(q), {"article_link": Ty.StringType(), "headline": Ty.StringType(),
                                               "is_sarcastic": Ty.IntegerType(), "body": Ty.StringType()},
                               key_column="headline").orderBy("row_key").collect()
    assert [(r.row_key, r.article_link, r.is_sarcastic, r.body) for r in out] == [(0, "u0", 1, "b0"), (1, "u1", 0, "")]


def test_csv_sink_keeps_arrays_as_json(spark):
    df = spark.createDataFrame([(1, "a, \"b\"\nc", ["x", "y"])], "id long, t string, toks array<string>")
    path = FS.scratch_path(spark, "csv")
    FS.write_csv(df, path)
    from pyspark.sql import types as Ty
    schema = Ty.StructType([Ty.StructField("id", Ty.LongType()), Ty.StructField("t", Ty.StringType()),
                            Ty.StructField("toks", Ty.StringType())])
    r = FS.read_csv(spark, path, schema).first()
    assert r.t == "a, \"b\"\nc" and json.loads(r.toks) == ["x", "y"]


def test_stream_equals_batch(spark):
    from wryspark.operators.articles import lead_sentence
    from wryspark.streaming import live as LV
    df = spark.createDataFrame([(1, "One two. Three."), (2, "Solo"), (3, "")], "row_id long, text string")
    src = FS.scratch_path(spark, "src")
    FS.write_json_lines(df, src)
    root = FS.scratch_path(spark, "out")
    out = LV.summarise_stream(spark, src, os.path.join(root, "sink"), os.path.join(root, "ckpt"))
    got = {r.row_id: r.summary for r in out.collect()}
    exp = {r.row_id: r.s for r in df.select("row_id", lead_sentence("text").alias("s")).collect()}
    assert got == exp == {1: "One two.", 2: "Solo", 3: ""}


def test_driver_contract(spark):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    df = E.entry(spark)
    assert df.columns == ["is_sarcastic", "rank", "word", "count"]
    assert df.count() > 0


def test_link_lookup_fallback(spark):
    from wryspark.operators.articles import lookup_bodies
    prefix = "x" * 30
    articles = spark.createDataFrame([("http://a", "body a"), ("http://b", "body b")], "url string, body string")
    links = spark.createDataFrame([(1, "http://a"), (2, prefix + "http://b"), (3, "http://zzz")],
                                  "id long, link string")
    got = {r.id: r.body for r in lookup_bodies(links, "link", articles).collect()}
    assert got == {1: "body a", 2: "body b", 3: ""}


def test_stream_scoring_equals_batch(spark):
    from wryspark.streaming import live as LV
    df = _toy(spark)
    model = ML.text_pipeline("headline", ML.naive_bayes()).fit(df)
    src = FS.scratch_path(spark, "score-src")
    FS.write_json_lines(df.select("row_id", F.col("headline").alias("text")), src)
    root = FS.scratch_path(spark, "score-out")
    out = LV.score_stream(spark, src, model, os.path.join(root, "sink"), os.path.join(root, "ckpt"),
                          text_col="headline")
    got = {r.row_id: r.prediction for r in out.collect()}
    exp = {r.row_id: int(r.prediction) for r in model.transform(df).collect()}
    assert got == exp
