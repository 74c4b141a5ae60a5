"""Landmark kernel features against an exact kernel SVM; distinct sketches."""

import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from wryspark.operators import models as ML
from wryspark.operators.sketches import store_sketches, stored_distinct
from wryspark.sources import files as FS


def _svm(gram, y, c=1.0, rounds=200):
    """Dual coordinate descent of a hinge-loss SVM without intercept: the
    decision values on its own rows."""
    a, f = np.zeros(len(y)), np.zeros(len(y))
    for _ in range(rounds):
        for i in range(len(y)):
            new = min(max(a[i] + (1 - y[i] * f[i]) / gram[i, i], 0.0), c)
            f += (new - a[i]) * y[i] * gram[i]
            a[i] = new
    return f


def _rows(n=160, dim=60, seed=3):
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        kind = i % 4
        at = np.sort(rng.choice(np.arange(kind * 15, kind * 15 + 20) % dim, 5, replace=False))
        v = rng.random(5) + 0.2
        rows.append((at, v / np.linalg.norm(v)))
        labels.append(1 if kind in (0, 3) else -1)
    return rows, np.array(labels)


def test_landmarks_are_nearer_to_the_exact_kernel_svm(spark):
    rows, y = _rows()
    df = spark.createDataFrame([(i, Vectors.sparse(60, at.tolist(), v.tolist())) for i, (at, v) in enumerate(rows)], ["row_id", "features"])
    dense = np.zeros((len(rows), 60))
    for i, (at, v) in enumerate(rows):
        dense[i, at] = v
    _, gamma = ML.kernel_width(df, "features")
    exact = np.exp(-gamma * ((dense[:, None] - dense[None]) ** 2).sum(2))
    error, apart = {}, {}
    want = _svm(exact, y)
    for name, stage in (("random", ML.RandomFourierFeatures("features", "z", 60)), ("landmarks", ML.LandmarkFeatures("features", "z", 60))):
        z = np.array([r.z.toArray() for r in stage.fit(df).transform(df).orderBy("row_id").collect()])
        gram = z @ z.T
        error[name] = np.linalg.norm(gram - exact) / np.linalg.norm(exact)
        apart[name] = np.abs(_svm(gram + 1e-9 * np.eye(len(y)), y) - want).mean()
    assert error["landmarks"] < 0.5 * error["random"]
    assert apart["landmarks"] < 0.75 * apart["random"]


def test_all_rows_as_landmarks_give_the_kernel_itself_and_a_model_that_saves(spark):
    rows, y = _rows(40)
    df = spark.createDataFrame([(i, Vectors.sparse(60, at.tolist(), v.tolist()), float(y[i] > 0)) for i, (at, v) in enumerate(rows)],
                               ["row_id", "features", "label"])
    model = ML.LandmarkFeatures("features", "z", 100).fit(df)
    z = np.array([r.z.toArray() for r in model.transform(df).orderBy("row_id").collect()])
    _, gamma = ML.kernel_width(df, "features")
    dense = np.array([r.features.toArray() for r in df.orderBy("row_id").collect()])
    assert np.allclose(z @ z.T, np.exp(-gamma * ((dense[:, None] - dense[None]) ** 2).sum(2)), atol=1e-6)
    from pyspark.ml import Pipeline
    fitted = Pipeline(stages=ML.kernel_svm(num_features=20, landmarks=True)).fit(df)
    loaded = ML.save_and_load(fitted, FS.scratch_path(spark, "landmarks"))
    a, b = (m.transform(df).orderBy("row_id").select("prediction", "kernel").collect() for m in (fitted, loaded))
    assert a == b
    # Dense vectors have no list of places.
    d = spark.createDataFrame([(0, Vectors.dense([0.1, 0.2])), (1, Vectors.dense([0.9, 0.0]))], ["row_id", "features"])
    assert ML.LandmarkFeatures("features", "z", 5).fit(d).transform(d).count() == 2


def test_sketches_merge(spark):
    path = FS.scratch_path(spark, "sketch")
    n = 300_000
    one = spark.range(n).select(F.lit("a").alias("version"), F.concat(F.lit("t"), F.col("id") % 200_000).alias("t"))
    two = spark.range(n).select(F.lit("b").alias("version"), F.concat(F.lit("t"), F.col("id") + 150_000).alias("t"))
    few = spark.createDataFrame([("c", "t1"), ("c", "t1"), ("c", None), ("c", "new")], "version string, t string")
    store_sketches(one, "version", "t", path)
    before = {(r.kind, r.versions): r.n for r in stored_distinct(spark, path, ["a"]).collect()}
    store_sketches(two.unionByName(few), "version", "t", path)
    store_sketches(few.withColumn("t", F.lit("new too")), "version", "t", path)
    got = {(r.kind, r.versions): r.n for r in stored_distinct(spark, path, ["a", "b", "c", "none"]).collect()}
    assert got["distinct", "a"] == before["distinct", "a"] and abs(got["distinct", "a"] / 200_000 - 1) < 0.015
    assert abs(got["distinct", "b"] / 300_000 - 1) < 0.015 and abs(got["union", "a+b+c+none"] / 450_002 - 1) < 0.015
    assert abs(got["common", "a&b"] - 50_000) < 0.015 * 450_000
    assert got["distinct", "c"] == 3 and got["distinct", "none"] == got["common", "c&none"] == 0
