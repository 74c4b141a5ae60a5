"""Model choice on a validation slice, saved kernel features, live summaries."""

import math
import os

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from wryspark.operators import encode as EN
from wryspark.operators import models as ML
from wryspark.operators import selection as SL
from wryspark.operators import split as SP
from wryspark.operators.articles import extractive_summary
from wryspark.sources import files as FS
from wryspark.streaming import live as LV


def _labelled(spark, n=300):
    words = ["good great fine", "bad awful poor", "odd even"]
    rows = [(i, f"{words[i % 2]} {words[2] if i % 5 else 'noise'} w{i % 11} w{i % 7}", int(i % 2 == 0) if i % 13 else 1) for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, headline string, label int").repartition(3)


def test_three_slices(spark):
    df = _labelled(spark)
    cut = SL.three_way_split(df).select("row_id", "split").collect()
    sizes = {s: sum(r.split == s for r in cut) for s in ("train", "val", "test")}
    assert sizes == {"test": 60, "val": 30, "train": 210}
    test = {r.row_id for r in SP.random_split(df, 0.2).filter("split = 'test'").collect()}
    assert {r.row_id for r in cut if r.split == "test"} == test


def _plain_nb(rows, alpha):
    """rows: {id: (label, split, {term: weight})}"""
    train = [(lab, w) for lab, s, w in rows.values() if s == "train"]
    terms = {t for _, w in train for t in w}
    classes = sorted({lab for lab, _ in train})
    n_cj = {c: {t: sum(w.get(t, 0.0) for lab, w in train if lab == c) for t in terms} for c in classes}
    out = {"val": [], "test": []}
    for lab, s, w in rows.values():
        if s != "train":
            score = [math.log(sum(x == c for x, _ in train) / len(train)) + sum(
                v * math.log((n_cj[c][t] + alpha) / (sum(n_cj[c].values()) + alpha * len(terms))) for t, v in w.items()) for c in classes]
            out[s].append(classes[score.index(max(score))] == lab)
    return {s: sum(v) / len(v) for s, v in out.items()}


def test_smoothing_grid_against_plain_python(spark):
    data = SL.three_way_split(_labelled(spark)).checkpoint()
    train = data.filter("split = 'train'")
    idf = EN.tfidf_fit(train, "headline")
    weights = EN.tfidf_apply(data, idf, "headline").checkpoint()
    alphas = [0.001, 0.5, 1.0, 200.0]
    got = {r.alpha: r for r in SL.nb_grid(weights, data.select("row_id", "label", "split"), alphas).collect()}
    rows = {r.row_id: (r.label, r.split, {}) for r in data.collect()}
    for r in weights.collect():
        rows[r.row_id][2][r.term] = r.weight
    want = {a: _plain_nb(rows, a) for a in alphas}
    best = max(alphas, key=lambda a: (want[a]["val"], -a))
    for a in alphas:
        assert abs(got[a].val_accuracy - want[a]["val"]) < 1e-12 and got[a].chosen == (a == best)
        assert (got[a].test_accuracy is None) == (a != best)
    assert abs(got[best].test_accuracy - want[best]["test"]) < 1e-12


def test_the_choice_does_not_see_the_test_slice(spark):
    data = SL.three_way_split(_labelled(spark)).checkpoint()
    feats = Pipeline(stages=EN.tfidf_stages("headline", "features")).fit(data.filter("split = 'train'")).transform(data) \
        .select("row_id", "label", "split", "features").checkpoint()
    nb = ML.naive_bayes()
    grid = [("nb", nb, {"smoothing": a}) for a in (0.1, 1.0, 50.0)]
    one = SL.fit_grid(feats, grid).collect()
    turned = feats.withColumn("label", F.when(F.col("split") == "test", 1 - F.col("label")).otherwise(F.col("label")))
    two = SL.fit_grid(turned, grid).collect()
    assert [(r.model, r.val_accuracy, r.chosen) for r in one] == [(r.model, r.val_accuracy, r.chosen) for r in two]
    chosen = [r for r in one if r.chosen]
    assert len(chosen) == 1 and chosen[0].val_accuracy == max(r.val_accuracy for r in one)
    assert abs(chosen[0].test_accuracy + [r for r in two if r.chosen][0].test_accuracy - 1) < 1e-9


def test_kernel_features_are_saved(spark):
    df = _labelled(spark, 80)
    model = ML.text_pipeline("headline", ML.kernel_svm(num_features=40)).fit(df)
    loaded = ML.save_and_load(model, FS.scratch_path(spark, "svm"))
    a = model.transform(df).orderBy("row_id").select("prediction", "rff").collect()
    assert a == loaded.transform(df).orderBy("row_id").select("prediction", "rff").collect()
    unfitted = Pipeline(stages=ML.kernel_svm(num_features=40))
    path = FS.scratch_path(spark, "svm-stages")
    unfitted.write().overwrite().save(path)
    assert Pipeline.load(path).getStages()[0].getOrDefault("numFeatures") == 40


def test_live_summaries_equal_the_batch(spark):
    rows = [(i, " ".join(f"Word{j} common{(i + j) % 5} talks about thing{(i * j) % 17}." for j in range(i % 9))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "no stop here at all"), (103, "only unseen terms qqqq. zzzz rrrr.")]
    docs = spark.createDataFrame(rows, "row_id long, text string")
    known = docs.filter("row_id <> 103")
    root = FS.scratch_path(spark, "live")
    src, sink, ckpt = (os.path.join(root, x) for x in ("src", "sink", "ckpt"))
    weights = LV.store_term_weights(known, "text", "row_id", os.path.join(root, "idf"))
    FS.write_json_lines(docs.filter("row_id < 20").repartition(3), src)
    first = LV.summarise_stream_extractive(spark, src, weights, sink, ckpt, files_per_batch=2)
    assert first.count() == 20
    # New files come later; the job goes on where it stopped.
    docs.filter("row_id >= 20").repartition(2).write.mode("append").json(src)
    got = {r.row_id: r.summary for r in LV.summarise_stream_extractive(spark, src, weights, sink, ckpt).collect()}
    batch = extractive_summary(docs, "row_id", "text", EN.tfidf_apply(docs, spark.read.parquet(weights), "text"))
    assert got == {r.row_id: r.summary for r in batch.collect()} and len(got) == 44
    assert got[103] == "only unseen terms qqqq. zzzz rrrr." and got[101] == ""


def test_sentences_are_scored_inside_their_document(spark):
    rows = [(1, "plain words stand here. rare zebra. plain words again."), (2, "One two. Three four."), (2, "Five six. Zebra seven."),
            (3, None), (4, ""), (None, "First here. Zebra there."), (5, "No weight. At all.")]
    docs = spark.createDataFrame(rows, "row_id long, text string")
    weights = spark.createDataFrame([(1, "rare", 0.5), (1, "zebra", 0.9), (1, "plain", 0.1), (2, "zebra", 1.0), (None, "zebra", 1.0)],
                                    "row_id long, term string, weight double")
    out = extractive_summary(docs, "row_id", "text", weights, 1, 2)
    got = sorted((r.row_id or 0, r.summary if r.summary is not None else "-") for r in out.collect())
    assert got == [(0, "First here."), (1, "rare zebra."), (2, "Three four."), (2, "Zebra seven."), (3, "-"), (4, ""), (5, "No weight.")]
    # Only texts that share an id are taken apart again; sentences and terms are not.
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1


def test_tokens_are_made_once(spark, tmp_path):
    from wryspark.plans.features_q import token_arrays
    spark.createDataFrame([(1, "It's a dog... yes.")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = token_arrays(spark, str(tmp_path))
    assert out._jdf.queryExecution().optimizedPlan().toString().count(r"\.{2,}") == 2  # one tokenising, with and without apostrophes
    assert out.first().filtered_tokens == ["dog", "yes"]
