"""L-09: choosing a model on a validation slice that is neither the training
nor the test slice.

``three_way_split`` cuts train, val and test in the seeded order.
``fit_grid`` fits every candidate of a grid on one stored feature table, a few
fits at a time (each is a distributed job of its own), and scores them on the
validation slice; only the chosen one ever sees the test slice. ``nb_grid`` is
the same for the relational naive Bayes: the counts don't depend on the
smoothing, so all its values are scored in one pass, a column each.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .metrics import binary_scores
from .ordering import hashed_index
from .split import seeded_hash


def three_way_split(df: DataFrame, test_fraction: float = 0.2, val_fraction: float = 0.1, key: str = "row_id",
                    seed: int = 42) -> DataFrame:
    """``split``: the first ``ceil(test_fraction * n)`` rows of the seeded
    order are the test slice (as in ``random_split``), the next
    ``ceil(val_fraction * n)`` the validation slice."""
    idx = hashed_index(df.withColumn("_h", seeded_hash(key, seed)), "_h", [key], [], "_idx", "_n")
    n_test = F.ceil(F.lit(test_fraction) * F.col("_n"))
    n_val = F.ceil(F.lit(val_fraction) * F.col("_n"))
    split = (F.when(F.col("_idx") < n_test, "test").when(F.col("_idx") < n_test + n_val, "val").otherwise("train"))
    return idx.withColumn("split", split).drop("_h", "_idx", "_n")


def fit_grid(features: DataFrame, candidates: list[tuple[str, Estimator, dict]], label_col: str = "label",
             parallelism: int = 4) -> DataFrame:
    """One row per candidate ``(name, estimator, params)``, in their order:
    ``(candidate, model, val_accuracy, chosen, test_accuracy)``.

    ``features`` holds feature vectors, the label and ``split``, written once.
    The best validation accuracy is chosen, the first of equals;
    ``test_accuracy`` is null for all others."""
    spark = features.sparkSession
    train, val = features.filter("split = 'train'"), features.filter("split = 'val'")

    def accuracy(model, rows: DataFrame) -> float:
        scored = model.transform(rows).withColumn("prediction", F.col("prediction").cast("int"))
        return binary_scores(scored, label_col).first()["accuracy"]

    def fit(candidate):
        name, estimator, params = candidate
        model = estimator.fit(train, {estimator.getParam(k): v for k, v in params.items()})
        return model, accuracy(model, val)

    pool = ThreadPool(min(parallelism, len(candidates)))
    try:
        fitted = pool.map(inheritable_thread_target(spark)(fit), candidates, chunksize=1)
    finally:
        pool.close()
    best = max(range(len(fitted)), key=lambda i: (fitted[i][1], -i))
    test = accuracy(fitted[best][0], features.filter("split = 'test'"))
    rows = [(i, name + "".join(f" {k}={v}" for k, v in sorted(params.items())), val_accuracy, i == best, test if i == best else None)
            for i, ((name, _, params), (_, val_accuracy)) in enumerate(zip(candidates, fitted))]
    return spark.createDataFrame(rows, "candidate int, model string, val_accuracy double, chosen boolean, test_accuracy double")


def _best_label(scores: list[tuple[object, Column]]) -> Column:
    """The label of the greatest score, the smallest label of equals."""
    best, score = F.lit(scores[0][0]), scores[0][1]
    for label, s in scores[1:]:
        best, score = F.when(s > score, F.lit(label)).otherwise(best), F.greatest(score, s)
    return best


def nb_grid(weights: DataFrame, docs: DataFrame, alphas: list[float], id_col: str = "row_id",
            label_col: str = "label") -> DataFrame:
    """``(alpha, val_accuracy, chosen, test_accuracy)`` of the relational
    multinomial NB for every smoothing value.

    ``weights`` is ``(id, term, weight)`` over the vocabulary fitted on the
    training slice, ``docs`` ``(id, label, split)``. A document's score under a
    class is the prior plus the sum of weight * ln((N_cj + alpha) / (N_c +
    alpha * V)); terms that the class never saw have N_cj = 0. The classes are
    bounded as in ``classification_report``; the counts travel as one row a
    term, so every weight row meets its counts in one join, whatever the grid.
    """
    train = docs.filter("split = 'train'")
    labels = [r[0] for r in train.groupBy(label_col).count().orderBy(label_col).limit(1001).collect()]
    if not 1 <= len(labels) <= 1000:
        raise ValueError("between 1 and 1000 classes are needed")
    tw = weights.join(train.select(id_col, label_col), id_col)
    per_term = tw.groupBy("term").agg(*[F.coalesce(F.sum(F.when(F.col(label_col) == c, F.col("weight"))), F.lit(0.0)).alias(f"_n{i}")
                                        for i, c in enumerate(labels)])
    totals = per_term.agg(F.count(F.lit(1)).alias("v"), *[F.coalesce(F.sum(f"_n{i}"), F.lit(0.0)).alias(f"n{i}") for i in range(len(labels))]).first()
    n = train.groupBy(label_col).count()
    count_of = {r[0]: r[1] for r in n.collect()}
    n_train = sum(count_of.values())
    rest = docs.filter("split <> 'train'")
    # A weight meets its term's counts once and adds to every column.
    def part(i: int, alpha: float) -> Column:
        theta = F.log((F.col(f"_n{i}") + F.lit(alpha)) / (F.lit(totals[f"n{i}"]) + F.lit(alpha) * F.lit(totals["v"])))
        return F.sum(F.col("weight") * theta)
    scored = (weights.join(rest.select(id_col), id_col, "left_semi").join(per_term, "term").groupBy(id_col)
              .agg(*[part(i, a).alias(f"_s{i}_{k}") for i in range(len(labels)) for k, a in enumerate(alphas)]))
    rows = rest.select(id_col, label_col, "split").join(scored, id_col, "left")
    prior = [F.log(F.lit(count_of[c] / n_train)) for c in labels]
    hits = [F.avg((_best_label([(c, prior[i] + F.coalesce(F.col(f"_s{i}_{k}"), F.lit(0.0))) for i, c in enumerate(labels)])
                   == F.col(label_col)).cast("double")).alias(f"_a{k}") for k in range(len(alphas))]
    per_split = rows.groupBy("split").agg(*hits)
    long = per_split.select("split", F.posexplode(F.array(*[F.col(f"_a{k}") for k in range(len(alphas))])).alias("_k", "_a"))
    table = long.groupBy("_k").agg(F.max(F.when(F.col("split") == "val", F.col("_a"))).alias("val_accuracy"),
                                   F.max(F.when(F.col("split") == "test", F.col("_a"))).alias("_test"))
    # As many rows as the grid has values.
    first = F.row_number().over(Window.orderBy(F.col("val_accuracy").desc(), "_k")) == 1
    alpha = F.element_at(F.array(*[F.lit(float(a)) for a in alphas]), F.col("_k") + 1)
    return table.withColumn("chosen", first).select(
        alpha.alias("alpha"), "val_accuracy", "chosen", F.when(F.col("chosen"), F.col("_test")).alias("test_accuracy"))
