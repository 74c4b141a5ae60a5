"""Skewed inputs: one label holds most rows and one word is in most of
them. Results must equal a brute-force computation."""

import random
from collections import Counter

from pyspark.sql import functions as F

from wryspark.operators import profile as P


def _data():
    rng = random.Random(11)
    rows = []
    for i in range(400):
        label = 1 if rng.random() < 0.9 else 0
        toks = ["hot"] * rng.randint(0, 3) + [rng.choice("abcdefg") for _ in range(rng.randint(0, 4))]
        rng.shuffle(toks)
        rows.append((1 + (i >= 200), i, label, toks))
    return rows


def test_top_words_under_skew(spark):
    rows = _data()
    df = spark.createDataFrame(rows, "version int, row_id long, label int, toks array<string>").repartition(5)
    got = {(r.label, r.word): r["count"] for r in P.token_counts(df, "toks", ["label"]).collect()}
    exp = Counter()
    for _, _, lab, toks in rows:
        for t in toks:
            exp[(lab, t)] += 1
    assert got == dict(exp)
    top = P.top_k(P.token_counts(df, "toks", ["label"]), ["label"], 1).collect()
    assert {r.label: r.word for r in top} == {0: "hot", 1: "hot"}


def test_cross_row_bigrams_under_skew(spark):
    rows = _data()
    df = spark.createDataFrame(rows, "version int, row_id long, label int, toks array<string>").repartition(7)
    got = {(r.label, r.ngram): r["count"]
           for r in P.ngram_counts(df, "toks", ["label"], 2, block_rows=16).collect()}
    exp = Counter()
    for lab in (0, 1):
        stream = [t for v, i, lb, toks in sorted(rows) if lb == lab for t in toks]
        for a, b in zip(stream, stream[1:]):
            exp[(lab, f"{a} {b}")] += 1
    assert got == dict(exp)


def test_samples_of_one_explained_row_fill_all_tasks(spark):
    from wryspark.operators.explain import perturb
    rows = spark.createDataFrame([(1, "a few words to explain and a few more")], "row_id long, headline string").coalesce(1)
    got = perturb(rows, "headline", 400).withColumn("task", F.spark_partition_id())
    sizes = [r["count"] for r in got.groupBy("task").count().collect()]
    assert sum(sizes) == 400 and len(sizes) == 4 and max(sizes) < 160
    whole = got.filter("sample = 0").first()
    assert whole.headline == "a few words to explain and a few more" and list(whole._vocab) == ["a", "few", "words", "to", "explain", "and", "more"]
