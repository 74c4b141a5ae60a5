"""Property checks on seeded random data (hand-rolled generator)."""

import math
import random

from pyspark.sql import functions as F

from wryspark.operators import encode as EN
from wryspark.operators import metrics as M
from wryspark.operators import reconcile as R
from wryspark.operators import rouge as RG
from wryspark.operators import split as SP
from wryspark.operators.ordering import exact_quantiles

RNG = random.Random(7)
WORDS = ["a", "b", "c", "dd", "ee", "Foo", "bar", "qux"]


def _texts(n):
    return [" ".join(RNG.choice(WORDS) for _ in range(RNG.randint(0, 6))) for _ in range(n)]


def test_merge_size_is_v1_plus_anti(spark):
    t = _texts(120)
    v1 = spark.createDataFrame([(i, t[i], i % 2) for i in range(60)], "row_id long, headline string, is_sarcastic int")
    v2 = spark.createDataFrame([(i, t[i], i % 2) for i in range(60, 120)],
                               "row_id long, headline string, is_sarcastic int")
    merged = R.merge_versions(v1, v2).count()
    anti = R.anti_join(v2, v1, "headline").count()
    assert merged == 60 + anti
    s1 = set(t[:60])
    assert anti == sum(1 for x in t[60:] if x not in s1)


def test_splits_partition_input_with_exact_sizes(spark):
    rows = [(i, RNG.randint(0, 2)) for i in range(257)]
    df = spark.createDataFrame(rows, "row_id long, label int")
    s = SP.random_split(df, 0.2).collect()
    assert sorted(r.row_id for r in s) == list(range(257))
    assert sum(r.split == "test" for r in s) == math.ceil(0.2 * 257)
    st = SP.random_split(df, 0.2, group_cols=["label"]).collect()
    for g in range(3):
        n = sum(1 for _, lab in rows if lab == g)
        assert sum(1 for r in st if r.label == g and r.split == "test") == math.ceil(0.2 * n)
    sl = SP.ordered_slices(df, {"train": 0.8, "val": 0.1, "test": 0.1}).collect()
    assert len({r.row_id for r in sl}) == len(sl)
    assert sum(r.split == "train" for r in sl) == int(0.8 * 257)


def test_hash_split_keeps_identical_texts_together(spark):
    t = _texts(200)
    df = spark.createDataFrame(list(enumerate(t)), "row_id long, text string")
    per = SP.hash_split(df, "text").groupBy("text").agg(F.countDistinct("split").alias("k"))
    assert per.filter("k > 1").count() == 0
    assert SP.leakage(SP.hash_split(df, "text"), "text").first().leaked_texts == 0


def test_rouge_bounds_and_identity(spark):
    t = _texts(80)
    pairs = spark.createDataFrame([(i, t[i], t[(i * 7) % 80]) for i in range(80)], "id long, p string, r string")
    for df in (RG.rouge_n(pairs, "id", "p", "r", 1), RG.rouge_n(pairs, "id", "p", "r", 2),
               RG.rouge_l(pairs, "id", "p", "r")):
        for r in df.collect():
            assert 0.0 <= r.fmeasure <= 1.0 and 0.0 <= r.precision <= 1.0 and 0.0 <= r.recall <= 1.0
    same = spark.createDataFrame([(i, x, x) for i, x in enumerate(t) if x], "id long, p string, r string")
    assert all(r.fmeasure == 1.0 for r in RG.rouge_l(same, "id", "p", "r").collect())


def test_padded_length_constant(spark):
    df = spark.createDataFrame([([RNG.randint(1, 9) for _ in range(RNG.randint(0, 12))],) for _ in range(50)],
                               "ids array<int>")
    assert {r.n for r in df.select(F.size(EN.pad("ids", 7)).alias("n")).collect()} == {7}


def test_report_support_totals_row_count(spark):
    rows = [(RNG.randint(0, 1), RNG.randint(0, 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    rep = {r.row_name: r for r in M.classification_report(df).collect()}
    assert rep["0"].support + rep["1"].support == 300 == rep["accuracy"].support


def test_quantiles_with_ties(spark):
    import numpy as np
    vals = [float(RNG.randint(0, 5)) for _ in range(101)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    q = {r.p: r.q for r in exact_quantiles(df, "v", [0.1, 0.5, 0.995]).collect()}
    for p in (0.1, 0.5, 0.995):
        assert abs(q[p] - np.percentile(vals, p * 100)) < 1e-12
