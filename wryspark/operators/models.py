"""Classifiers over TF-IDF features (L-01..L-09, E-05, S-07).

Everything is a ``pyspark.ml`` ``Pipeline``: fitting is distributed by
MLlib, scoring is ``PipelineModel.transform``. The only custom stages are
the smooth IDF (``encode.SmoothIDF``), the trees over sparse features
(``trees``), and the kernel features of the kernel-SVM stand-in; the random
ones regenerate their projection from a seed on each worker.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from .cbow import cbow_vectors
from .encode import tfidf_stages
from .split import shuffled
from .trees import SparseBoosting, SparseRandomForest


def logistic_regression(C: float, n_train: int, max_iter: int = 100, label_col: str = "label",
                        tol: float = 1e-4):
    """L-01: the inverse-strength ``C`` of the reference maps to
    ``regParam = 1 / (C * n)`` (its loss is summed, Spark's averaged);
    no feature standardisation; the reference library's stopping
    tolerance (1e-4) instead of Spark's 1e-6."""
    return LogisticRegression(featuresCol="features", labelCol=label_col, regParam=1.0 / (C * n_train),
                              elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=tol)


def naive_bayes(label_col: str = "label"):
    """L-02: multinomial NB, additive smoothing 1."""
    return NaiveBayes(featuresCol="features", labelCol=label_col, smoothing=1.0, modelType="multinomial")


class _FourierParams(HasInputCol, HasOutputCol):
    """What both stages keep as parameters, so that they save and load."""

    numFeatures = Param(Params._dummy(), "numFeatures", "number of random features", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the projection", TypeConverters.toInt)
    dim = Param(Params._dummy(), "dim", "length of the input vectors", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)


class RandomFourierFeatures(Estimator, _FourierParams, DefaultParamsReadable, DefaultParamsWritable):
    """L-03 feature map ``z(x) = sqrt(2/D) cos(W x + b)`` approximating an RBF
    kernel (Rahimi & Recht 2007) with ``gamma = 1 / (d * Var(X))``.

    Fitting computes Var(X) over all entries with one distributed
    aggregate; transforming regenerates ``W, b`` from the seed inside an
    Arrow ``pandas_udf`` (batched matrix product).
    """

    def __init__(self, inputCol="features", outputCol="rff", numFeatures=300, seed=42):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, numFeatures=numFeatures, seed=seed)

    def _fit(self, dataset):
        d, gamma = kernel_width(dataset, self.getInputCol())
        model = RandomFourierModel()
        model._set(inputCol=self.getInputCol(), outputCol=self.getOutputCol(), dim=d, gamma=gamma,
                   numFeatures=self.getOrDefault("numFeatures"), seed=self.getOrDefault("seed"))
        return model


def kernel_width(dataset: DataFrame, input_col: str) -> tuple[int, float]:
    """Length of the vectors and ``gamma = 1 / (d * Var(X))``, the variance
    over all entries. Only stored entries are read; the others add nothing."""
    parts = F.unwrap_udt(F.col(input_col))
    stats = dataset.select(F.coalesce(parts["size"], F.size(parts["values"])).alias("d"),
                           F.aggregate(parts["values"], F.lit(0.0), lambda a, x: a + x).alias("s"),
                           F.aggregate(parts["values"], F.lit(0.0), lambda a, x: a + x * x).alias("s2")) \
        .agg(F.max("d").alias("d"), F.sum("s").alias("s"), F.sum("s2").alias("s2"),
             F.count(F.lit(1)).alias("n")).first()
    cells = stats["n"] * stats["d"]
    var = stats["s2"] / cells - (stats["s"] / cells) ** 2
    return int(stats["d"]), 1.0 / (stats["d"] * var) if var > 0 else 1.0


class RandomFourierModel(Model, _FourierParams, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset):
        dim, D, gamma, seed = (self.getOrDefault(p) for p in ("dim", "numFeatures", "gamma", "seed"))

        @F.pandas_udf(Ty.ArrayType(Ty.DoubleType()))
        def rff(indices: pd.Series, values: pd.Series) -> pd.Series:
            rng = np.random.default_rng(seed)
            w = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(dim, D))
            b = rng.uniform(0.0, 2 * np.pi, size=D)
            # A sparse row multiplies only the rows of W that it has entries for.
            return pd.Series([np.sqrt(2.0 / D) * np.cos(np.asarray(v) @ (w if i is None else w[np.asarray(i)]) + b)
                              for i, v in zip(indices, values)])

        parts = F.unwrap_udt(F.col(self.getInputCol()))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(rff(parts["indices"], parts["values"])))


class _LandmarkParams(HasInputCol, HasOutputCol):
    numLandmarks = Param(Params._dummy(), "numLandmarks", "number of landmark rows", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the landmarks' choice", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    indices = Param(Params._dummy(), "indices", "entries of each landmark: places")
    values = Param(Params._dummy(), "values", "entries of each landmark: values")
    projection = Param(Params._dummy(), "projection", "kernel values to features")


class LandmarkFeatures(Estimator, _LandmarkParams, DefaultParamsReadable, DefaultParamsWritable):
    """L-03 feature map from the data itself (Nystroem): the kernel values of
    a row with landmark rows, turned so that dot products of features are the
    kernel's best approximation on the landmarks' span.

    Landmarks are the ``numLandmarks`` different rows that come first by a
    hash; they and one small eigenproblem are all that the driver holds."""

    def __init__(self, inputCol="features", outputCol="landmarks", numLandmarks=300, seed=42):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, numLandmarks=numLandmarks, seed=seed)

    def _fit(self, dataset):
        _, gamma = kernel_width(dataset, self.getInputCol())
        parts = F.unwrap_udt(F.col(self.getInputCol()))
        rows = dataset.select(F.coalesce(parts["indices"], F.sequence(F.lit(0), F.size(parts["values"]) - 1)).alias("i"),
                              parts["values"].alias("v")).distinct()
        # The hash of a row decides, so equal rows are one landmark.
        first = rows.orderBy(F.xxhash64(F.lit(self.getOrDefault("seed")), "i", "v"), "i", "v") \
            .limit(self.getOrDefault("numLandmarks")).collect()
        indices, values = [list(r.i) for r in first], [list(r.v) for r in first]
        kernel = _rbf(indices, values, _Landmarks(indices, values), gamma)
        size, turned = np.linalg.eigh((kernel + kernel.T) / 2)
        keep = size > 1e-10 * size.max()
        model = LandmarkModel()
        model._set(inputCol=self.getInputCol(), outputCol=self.getOutputCol(), gamma=gamma, indices=indices, values=values,
                   numLandmarks=len(first), seed=self.getOrDefault("seed"),
                   projection=(turned[:, keep] / np.sqrt(size[keep])).tolist())
        return model


class _Landmarks:
    """Landmark rows as a dense table over the places that any of them has."""

    def __init__(self, indices: list, values: list):
        self.places = np.unique(np.concatenate([np.asarray(i, np.int64) for i in indices]))
        self.table = np.zeros((len(self.places), len(indices)))
        for k, (i, v) in enumerate(zip(indices, values)):
            self.table[np.searchsorted(self.places, i), k] = v
        self.squares = (self.table ** 2).sum(0)


def _rbf(indices, values, landmarks: _Landmarks, gamma: float) -> np.ndarray:
    """Kernel values of sparse rows with the landmarks."""
    out = np.empty((len(values), landmarks.table.shape[1]))
    for r, (i, v) in enumerate(zip(indices, values)):
        v = np.asarray(v, float)
        i = np.arange(len(v)) if i is None else np.asarray(i)
        at = np.searchsorted(landmarks.places, i).clip(max=len(landmarks.places) - 1)
        shared = landmarks.places[at] == i
        out[r] = v @ v + landmarks.squares - 2 * (v[shared] @ landmarks.table[at[shared]])
    return np.exp(-gamma * np.maximum(out, 0))


class LandmarkModel(Model, _LandmarkParams, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset):
        gamma, indices, values, projection = (self.getOrDefault(p) for p in ("gamma", "indices", "values", "projection"))

        @F.pandas_udf(Ty.ArrayType(Ty.DoubleType()))
        def near(i: pd.Series, v: pd.Series) -> pd.Series:
            return pd.Series(list(_rbf(i, v, _Landmarks(indices, values), gamma) @ np.array(projection)))

        parts = F.unwrap_udt(F.col(self.getInputCol()))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(near(parts["indices"], parts["values"])))


def kernel_svm(label_col: str = "label", num_features: int = 300, seed: int = 42, landmarks: bool = False):
    """L-03: RBF-kernel SVM stand-in = kernel features + linear SVM. The
    features are random (Fourier) or, with ``landmarks``, made from the data."""
    features = LandmarkFeatures("features", "kernel", num_features, seed) if landmarks \
        else RandomFourierFeatures("features", "rff", num_features, seed)
    return [features, LinearSVC(featuresCol=features.getOutputCol(), labelCol=label_col, regParam=0.0, maxIter=100)]


def random_forest(label_col: str = "label", seed: int = 42):
    """L-04: 100 trees on all rows, sqrt features per split, to depth 30, the
    deepest that MLlib allows."""
    return SparseRandomForest(labelCol=label_col, numTrees=100, maxDepth=30, seed=seed)


def bounded_fit_rows(train: DataFrame, key: str = "row_id", limit: int = 200_000) -> DataFrame:
    """The ``limit`` rows that come first in the seeded order of ``key``; all
    rows, if there are no more. Rows are numbered in hash buckets, so no task
    sees more than its share of them. No query fits on such a cut."""
    return shuffled(train, key, name="_place").filter(F.col("_place") < limit).drop("_place")


#: Training rows that a task holds at most, about, where a row is one binned
#: whole number per feature, as in MLlib's boosting: 20 kB at 5,000 features.
BOOSTING_ROWS = 10_000


def spread_rows(train: DataFrame, key: str = "row_id", rows: int = BOOSTING_ROWS) -> DataFrame:
    """All rows, dealt out by ``key`` so that a task's share is about ``rows``
    however many there are; few rows stay as they are."""
    tasks = -(-train.count() // rows)
    return train.repartition(tasks, key) if tasks > train.rdd.getNumPartitions() else train


def gradient_boosting(label_col: str = "label"):
    """L-05: 100 rounds of depth-3 trees, step 0.1; the rows' scores are
    written every 10 rounds into the session's checkpoint folder. Nothing is
    drawn, so there is no seed."""
    return SparseBoosting(labelCol=label_col, maxIter=100, stepSize=0.1, maxDepth=3, checkpointInterval=10)


def dense_head(dim: int, n_classes: int = 2, label_col: str = "label", seed: int = 42):
    """L-06: one hidden layer of 50 units over a dense document vector."""
    return MultilayerPerceptronClassifier(featuresCol="features", labelCol=label_col,
                                          layers=[dim, 50, n_classes],
                                          seed=seed, maxIter=200)


def text_pipeline(text_col: str, classifier, max_features: int | None = None) -> Pipeline:
    """L-07: raw text -> TF-IDF -> classifier(s) in one ``Pipeline``."""
    stages = tfidf_stages(text_col, "features", max_features)
    stages += classifier if isinstance(classifier, list) else [classifier]
    return Pipeline(stages=stages)


def accuracy(scored: DataFrame, label_col: str = "label") -> float:
    return MulticlassClassificationEvaluator(labelCol=label_col, predictionCol="prediction",
                                             metricName="accuracy").evaluate(scored)


def word_vectors(df: DataFrame, tokens_col: str, seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """E-05: 100-d skip-gram vectors, window 5, words seen at least twice, one
    pass over the texts.

    Trained in shards (``cbow``): the vocabulary grows with the texts, and
    MLlib's ``Word2Vec`` holds it and both its vectors on the driver."""
    vec = cbow_vectors(df, id_col, tokens_col, size=100, window=5, min_count=2, rounds=1, step=0.025, seed=seed, skip=True)
    return vec.select("word", array_to_vector("vector").alias("vector"))


def save_and_load(model: PipelineModel, path: str) -> PipelineModel:
    """S-07."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def linear_batch_predictor(coefficients: np.ndarray, intercept: float):
    """L-08: a bring-your-own model for ``predict_batch_udf``: the factory
    runs once per Python worker and returns a batched predict function."""
    def make_predict_fn():
        w = np.asarray(coefficients, dtype=float)

        def predict(x: np.ndarray) -> np.ndarray:
            return 1.0 / (1.0 + np.exp(-(x @ w + intercept)))
        return predict
    return predict_batch_udf(make_predict_fn, return_type=Ty.DoubleType(), batch_size=32,
                             input_tensor_shapes=[[len(coefficients)]])


def nb_fit_long(train_weights: DataFrame, labels: DataFrame, vocab: DataFrame, alpha: float = 1.0,
                id_col: str = "row_id", label_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """L-02 in relational form with empirical class priors.

    ``theta = (N_cj + alpha) / (N_c + alpha * V)``, where ``N_cj`` sums the
    TF-IDF weights of term j over class c, over the fitted vocabulary (V
    terms). Returns ``priors (label, log_prior, log_default)``, one row per
    class, and ``theta (label, term, log_theta)`` for the pairs that occur;
    every other pair has the class's ``log_default``.
    """
    n = labels.agg(F.count(F.lit(1))).scalar()
    v = vocab.agg(F.count(F.lit(1))).scalar()
    ncj = train_weights.join(labels, id_col).groupBy(label_col, "term").agg(F.sum("weight").alias("ncj"))
    nc = ncj.groupBy(label_col).agg(F.sum("ncj").alias("nc"))
    priors = (labels.groupBy(label_col).agg(F.log(F.count(F.lit(1)) / n).alias("log_prior"))
              .join(nc, label_col, "left")
              .withColumn("log_default", F.log(alpha / (F.coalesce("nc", F.lit(0.0)) + alpha * v))))
    theta = ncj.join(nc, label_col).select(
        label_col, "term", F.log((F.col("ncj") + alpha) / (F.col("nc") + alpha * v)).alias("log_theta"))
    return priors.drop("nc"), theta


def nb_predict_long(weights: DataFrame, docs: DataFrame, priors: DataFrame, theta: DataFrame,
                    id_col: str = "row_id", label_col: str = "label") -> DataFrame:
    """Joint log-likelihood per (document, class) and the arg-max class
    (ties to the smaller class). Documents without known terms score their
    prior only."""
    seen = weights.join(theta, "term").groupBy(id_col, label_col).agg(
        F.sum(F.col("weight") * F.col("log_theta")).alias("_ll"), F.sum("weight").alias("_seen"))
    whole = weights.groupBy(id_col).agg(F.sum("weight").alias("_whole"))
    # One entry per class, like the score columns made of it.
    classes = [r[0] for r in priors.select(label_col).orderBy(label_col).collect()]
    per_class = priors.agg(F.collect_list(F.struct(label_col, "log_prior", "log_default"))).scalar()
    grid = docs.select(id_col, F.explode(per_class).alias("_p")).select(
        id_col, F.col(f"_p.{label_col}").alias(label_col), "_p.log_prior", "_p.log_default")
    unseen = F.coalesce("_whole", F.lit(0.0)) - F.coalesce("_seen", F.lit(0.0))
    sc = (grid.join(seen, [id_col, label_col], "left").join(whole, id_col, "left")
          .withColumn("score", F.col("log_prior") + F.coalesce("_ll", F.lit(0.0)) + unseen * F.col("log_default")))
    w = Window.partitionBy(id_col).orderBy(F.col("score").desc(), F.col(label_col))
    best = sc.withColumn("_r", F.row_number().over(w))
    return best.groupBy(id_col).agg(
        F.max(F.when(F.col("_r") == 1, F.col(label_col))).alias("prediction"),
        *[F.max(F.when(F.col(label_col) == c, F.col("score"))).alias(f"score_{c}") for c in classes])
