"""Trees over sparse features: all rows, plain Python's splits, any partitions."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.linalg import Vectors

from wryspark.operators import models as ML
from wryspark.operators import trees as TR
from wryspark.plans import models_q as Q


def planted(n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        label = int(rng.random() < 0.4)
        own = {j: rng.choice([0.25, 0.5, 1.0, 2.0]) for j in rng.sample(range(6), 3)}
        own[6] = 3.0 + rng.random() if label and rng.random() < 0.95 else rng.random()
        if rng.random() < 0.3:
            own[7] = -rng.random()
        rows.append((label, Vectors.sparse(9, sorted(own.items()))))
    return rows + rows[:5] + [(0, Vectors.dense([0.0] * 9)), (1, Vectors.dense([0.0] * 6 + [4.0, -1.0, 0.0]))]


class Rows:
    """Binned rows as a task holds them."""

    def __init__(self, table, labels):
        at = [np.flatnonzero(r) for r in table]
        self.size = np.array([len(i) for i in at], np.int32)
        self.feature = np.concatenate(at).astype(np.uint16)
        self.bin = np.concatenate([r[i] for r, i in zip(table, at)]).astype(np.uint8)
        self.label, self.key = np.array(labels, np.int32), np.arange(len(labels), dtype=np.uint64)


def best_plain(table, labels, weight, at, k):
    def spread(some):
        n = np.bincount(labels[some], weight[some], k)
        return (n ** 2).sum() / n.sum()
    found = []
    for j in range(table.shape[1]):
        for b in range(int(table[at, j].max())):
            left, right = at[table[at, j] <= b], at[table[at, j] > b]
            if weight[left].sum() and weight[right].sum():
                found.append((round(spread(left) + spread(right) - spread(at), 9), -j, -b))
    return max(found, default=(0, 0, 0))


@pytest.mark.parametrize("seed", range(4))
def test_splits_are_plain_pythons(seed):
    rng = np.random.default_rng(seed)
    table = rng.integers(0, 5, (60, 7)) * (rng.random((60, 7)) < 0.6)
    labels, weight = rng.integers(0, 3, 60), rng.integers(0, 3, 60).astype(float)
    f, b, left, counts = TR.grow_tree(Rows(table, labels), weight, 3, 7, 7, 4, 8, np.zeros(7, int), np.random.default_rng(1))

    def same(node, at, depth):
        assert counts[node].tolist() == np.bincount(labels[at], weight[at], 3).tolist()
        gain, j, cut = best_plain(table, labels, weight, at, 3)
        if f[node] < 0:
            # A leaf: pure, at the bottom, without a gain, or of leaves that predict alike.
            return
        assert depth < 4 and (f[node], b[node]) == (-j, -cut) and gain > 0
        same(left[node], at[table[at, f[node]] <= b[node]], depth + 1)
        same(left[node] + 1, at[table[at, f[node]] > b[node]], depth + 1)

    assert f[0] >= 0
    same(0, np.flatnonzero(weight > 0), 0)


def test_small_tables_take_more_passes(monkeypatch):
    rng = np.random.default_rng(9)
    table = rng.integers(0, 4, (300, 12)) * (rng.random((300, 12)) < 0.5)
    labels, weight = rng.integers(0, 2, 300), np.ones(300)

    def grown():
        return TR.grow_tree(Rows(table, labels), weight, 2, 12, 4, 9, 8, np.zeros(12, int), np.random.default_rng(5))
    one = grown()
    monkeypatch.setattr(TR, "_CHUNK", 100)
    monkeypatch.setattr(TR, "_TABLE", 40)
    monkeypatch.setattr(TR, "_COPIED", 0)
    assert all(np.array_equal(x, y) for x, y in zip(one, grown()))


def test_forest_learns_whatever_the_partitions(spark, tmp_path):
    df = spark.createDataFrame(planted(), ["label", "features"])
    forests = [TR.SparseRandomForest(numTrees=7, maxDepth=8, seed=5).fit(df.repartition(k)) for k in (1, 5)]
    assert forests[0].trees == forests[1].trees and len(forests[0].trees) == 7
    assert TR.SparseRandomForest(numTrees=7, maxDepth=8, seed=6).fit(df).trees != forests[0].trees
    model = Pipeline(stages=[TR.SparseRandomForest(numTrees=7, maxDepth=8, seed=5)]).fit(df)
    scored = model.transform(df).collect()
    assert np.mean([r.label == r.prediction for r in scored]) > 0.93
    assert all(abs(sum(r.probability) - 1) < 1e-6 and r.prediction == np.argmax(r.probability) for r in scored)
    model.write().overwrite().save(f"{tmp_path}/forest")
    assert PipelineModel.load(f"{tmp_path}/forest").transform(df).collect() == scored


def test_groups_may_meet_in_a_task(spark, monkeypatch):
    df = spark.createDataFrame(planted(), ["label", "features"])
    one = TR.SparseRandomForest(numTrees=6, maxDepth=5).fit(df)
    real = type(df).repartition
    monkeypatch.setattr(type(df), "repartition", lambda self, n, *cols: real(self, 1 if "group" in cols else n, *cols))
    assert TR.SparseRandomForest(numTrees=6, maxDepth=5).fit(df).trees == one.trees


def test_edges_come_from_all_rows(spark):
    df = spark.createDataFrame([(0, Vectors.sparse(3, {0: v / 100, 2: 1.0})) for v in range(1, 101)] + [(1, Vectors.sparse(3, {1: -2.0}))],
                               ["label", "features"])
    start, edges = TR.bin_edges(TR.stored_rows(df, "features", "label"), 3)
    assert (np.diff(start) <= 31).all()
    mine = edges[start[0]:start[1]]
    bins = np.searchsorted(mine, TR.ordered(np.arange(0, 101) / 100))
    assert bins[0] == 0 and bins[1] > 0 and np.bincount(bins)[1:].max() <= 8
    # One value beside zero needs one edge; a negative one lies below zero's bin.
    assert [np.searchsorted(edges[start[j]:start[j + 1]], TR.ordered(v)).tolist() for j, v in ((1, [-2, 0]), (2, [0, 1]))] == [[0, 1], [0, 1]]


def test_forest_query_fits_all_rows(spark, tmp_path, monkeypatch):
    """No cut of the training rows: as many as the split has go in."""
    rows = [(i, f"word{i % 7} other{i % 3} {'good' if i % 3 else 'bad'} day{i}") for i in range(90)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(ML, "bounded_fit_rows", lambda *a, **k: (_ for _ in ()).throw(AssertionError("a cut")))
    seen, real = [], TR.stored_rows
    monkeypatch.setattr(TR, "stored_rows", lambda *a: seen.append(real(*a)) or seen[-1])
    got = {r.split: r.accuracy for r in Q.model_random_forest(spark, str(tmp_path)).collect()}
    assert seen[0].count() == 72 and got["train"] > 0.9 and set(got) == {"train", "test"}


def test_boosting_is_mllibs(spark, tmp_path):
    """The same trees as MLlib's where its bins are single values."""
    from pyspark.ml.classification import GBTClassifier
    rng = random.Random(8)
    rows = []
    for _ in range(300):
        own = {j: float(rng.choice([1, 2, 3, 5])) for j in rng.sample(range(8), 4)}
        if rng.random() < 0.2:
            own[8] = -1.0
        rows.append((int(own.get(1, 0) + own.get(4, 0) * rng.random() + rng.random() > 4), Vectors.sparse(10, sorted(own.items()))))
    df = spark.createDataFrame(rows, ["label", "features"]).repartition(3).checkpoint()
    want = GBTClassifier(maxIter=12, stepSize=0.1, maxDepth=3, seed=1).fit(df).transform(df).select("label", "prediction", "probability").collect()
    model = Pipeline(stages=[TR.SparseBoosting(maxIter=12, checkpointInterval=5)]).fit(df)
    got = model.transform(df).select("label", "prediction", "probability").collect()
    assert [r.prediction for r in got] == [r.prediction for r in want]
    assert np.allclose([r.probability[1] for r in got], [r.probability[1] for r in want], atol=1e-9)
    model.write().overwrite().save(f"{tmp_path}/boosting")
    assert PipelineModel.load(f"{tmp_path}/boosting").transform(df).select("label", "prediction", "probability").collect() == got


def test_boosting_holds_entries_only(spark):
    """A row of few entries costs a few bytes, however many features there are."""
    df = spark.createDataFrame([(i % 2, Vectors.sparse(5000, [i % 7, 10 + i % 2], [1.0, 2.0])) for i in range(500)], ["label", "features"])
    rows = TR.stored_rows(df, "features", "label")
    bins = spark.sparkContext.broadcast(TR.bin_edges(rows, 5000))
    blocks = rows.mapInArrow(TR._packer(bins, 5000), TR._BLOCK_SCHEMA).collect()
    assert sum(len(x) for r in blocks for x in r) == 500 * (1 + 8 + 4 + 2 * 3)
    assert {r.prediction == r.label for r in TR.SparseBoosting(maxIter=2).fit(df).transform(df).collect()} == {True}
