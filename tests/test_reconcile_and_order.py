"""Merge, top-k ties, cross-row n-grams, dense numbering, quantiles."""

import numpy as np
from pyspark.sql import functions as F

from wryspark.operators import profile as P
from wryspark.operators import reconcile as R
from wryspark.operators.ordering import dense_index, exact_quantiles


def test_merge_fixture(spark):
    v1 = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", 0), (4, None, 1)],
                               "row_id long, headline string, is_sarcastic int")
    v2 = spark.createDataFrame([(5, "a", 0), (6, "c", 1), (7, "c", 1), (8, "d", 0)],
                               "row_id long, headline string, is_sarcastic int")
    m = R.merge_versions(v1, v2)
    got = sorted((r.headline, r.is_sarcastic) for r in m.collect())
    assert got == [("a", 1), ("a", 1), ("b", 0), ("c", 1), ("c", 1), ("d", 0)]
    bal = {r.is_sarcastic: r.share for r in P.class_balance(m).collect()}
    assert abs(bal[1] - 4 / 6) < 1e-12 and abs(bal[0] - 2 / 6) < 1e-12
    assert R.common_distinct(v1.na.drop(), v2).count() == 1


def test_top_k_ties_by_first_appearance(spark):
    df = spark.createDataFrame([(1, 1, ["b", "a", "b", "a", "c"])], "version int, row_id long, toks array<string>")
    df = df.withColumn("g", F.lit(0))
    top = P.top_k(P.token_counts(df, "toks", ["g"]), ["g"], 2).orderBy("rank").collect()
    assert [(r.word, r["count"]) for r in top] == [("b", 2), ("a", 2)]


def _bigrams(spark, block_rows, parts):
    rows = [(1, 1, ["x", "y"]), (1, 2, []), (1, 3, ["z"]), (1, 4, ["x", "y"])]
    df = spark.createDataFrame(rows, "version int, row_id long, toks array<string>") \
        .withColumn("g", F.lit(0)).repartition(parts)
    c = P.ngram_counts(df, "toks", ["g"], 2, block_rows=block_rows)
    return {r.ngram: r["count"] for r in c.collect()}


def test_cross_row_bigrams_fixture(spark):
    expected = {"x y": 2, "y z": 1, "z x": 1}
    assert _bigrams(spark, 1 << 16, 1) == expected
    # One row per block: every boundary pair goes through the block carry.
    assert _bigrams(spark, 1, 3) == expected


def test_row_bigrams_fixture(spark):
    rows = [(1, 1, ["x", "y"]), (1, 2, []), (1, 3, ["z"]), (1, 4, ["x", "y"])]
    df = spark.createDataFrame(rows, "version int, row_id long, toks array<string>").withColumn("g", F.lit(0))
    c = P.ngram_counts(df, "toks", ["g"], 2, boundary="row")
    assert {r.ngram: r["count"] for r in c.collect()} == {"x y": 2}


def test_trigrams_cross_short_rows(spark):
    rows = [(1, i, t) for i, t in enumerate([["a"], ["b"], [], ["c", "d"], ["e"]])]
    df = spark.createDataFrame(rows, "version int, row_id long, toks array<string>").withColumn("g", F.lit(0))
    for block in (1, 2, 100):
        c = P.ngram_counts(df, "toks", ["g"], 3, block_rows=block)
        assert sorted(r.ngram for r in c.collect()) == ["a b c", "b c d", "c d e"]


def test_dense_index_matches_brute_force(spark):
    import random
    rng = random.Random(3)
    data = [(i, rng.randint(0, 3), rng.random()) for i in range(500)]
    df = spark.createDataFrame(data, "id long, g int, v double").repartition(7)
    got = {r.id: r.idx for r in dense_index(df, ["v", "id"], ["g"], "idx", num_partitions=5).collect()}
    for g in range(4):
        ordered = sorted((v, i) for i, gg, v in data if gg == g)
        for k, (_, i) in enumerate(ordered):
            assert got[i] == k


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    vals = rng.normal(size=301)
    df = spark.createDataFrame([(int(i % 2), float(v)) for i, v in enumerate(vals)], "g int, v double")
    q = {(r.g, r.p): r.q for r in exact_quantiles(df, "v", [0.25, 0.5, 0.75], ["g"]).collect()}
    for g in (0, 1):
        sub = vals[g::2]
        for p in (0.25, 0.5, 0.75):
            assert abs(q[(g, p)] - np.percentile(sub, p * 100)) < 1e-12


def test_result_independent_of_partitioning(spark):
    data = [(1, i, [f"w{i % 5}", f"w{(i * 7) % 5}"]) for i in range(60)]
    df = spark.createDataFrame(data, "version int, row_id long, toks array<string>").withColumn("g", F.lit(0))
    a = {(r.ngram, r["count"]) for r in P.ngram_counts(df.repartition(1), "toks", ["g"], 2, block_rows=8).collect()}
    b = {(r.ngram, r["count"]) for r in P.ngram_counts(df.repartition(7), "toks", ["g"], 2, block_rows=8).collect()}
    assert a == b
