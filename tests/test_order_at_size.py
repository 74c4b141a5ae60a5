"""Numbering and splits of rows that carry a payload, at sizes where a
sampled range boundary would differ between two readers; and fixes of small
semantics: classes of the data, whole text nodes, one body per url."""

import pytest
from pyspark.sql import functions as F

from tests import plain_lcs as plain
from tests.plain_html import extract_body
from wryspark.operators import articles as AR
from wryspark.operators import lexicon as LX
from wryspark.operators import metrics as M
from wryspark.operators import models as ML
from wryspark.operators import profile as P
from wryspark.operators import split as SP
from wryspark.operators.explain import _ridge
from wryspark.operators.ordering import dense_index

ROWS = 200_000


@pytest.fixture(scope="module")
def wide(spark):
    return spark.range(ROWS).select(F.col("id").alias("row_id"), (F.col("id") % 3).alias("g"),
                                    F.concat(F.lit("text of row "), F.col("id").cast("string")).alias("text"))


@pytest.mark.parametrize("parts", [2, 8, 64])
def test_dense_index_with_payload(wide, parts):
    idx = dense_index(wide.repartition(parts), ["text"], [], "idx", num_partitions=parts)
    r = idx.agg(F.countDistinct("idx"), F.min("idx"), F.max("idx"), F.countDistinct("text")).first()
    assert tuple(r) == (ROWS, 0, ROWS - 1, ROWS)


@pytest.mark.parametrize("parts", [2, 8, 64])
def test_split_sizes_with_payload(spark, wide, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        plain = SP.random_split(wide.repartition(parts), 0.2)
        assert plain.groupBy("split").count().orderBy("split").collect() == [("test", 40_000), ("train", 160_000)]
        by = SP.random_split(wide, 0.2, group_cols=["g"]).filter("split = 'test'")
        assert sorted(r["count"] for r in by.groupBy("g").count().collect()) == [13_334, 13_334, 13_334]
        cut = SP.ordered_slices(wide, {"train": 0.8, "val": 0.1, "test": 0.1})
        assert {r["split"]: r["count"] for r in cut.groupBy("split").count().collect()} == {
            "train": 160_000, "val": 20_000, "test": 20_000}
        n = SP.shuffled(wide).agg(F.countDistinct("idx"), F.max("idx")).first()
        assert tuple(n) == (ROWS, ROWS - 1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_ngrams_of_sparse_ids(spark):
    rows = [(1, 10 ** 12 * i, [f"w{i}", "x"]) for i in range(50)]
    df = spark.createDataFrame(rows, "version int, row_id long, toks array<string>").withColumn("g", F.lit(0))
    got = {r.ngram for r in P.ngram_counts(df, "toks", ["g"], 3, block_rows=8).collect()}
    stream = [t for _, _, ts in rows for t in ts]
    assert got == {" ".join(stream[i:i + 3]) for i in range(len(stream) - 2)}


def test_classes_come_from_the_data(spark):
    df = spark.createDataFrame([(0, 0), (1, 2), (2, 2), (2, 1), (0, 0)], "label int, prediction int")
    rows = {r.row_name: r for r in M.classification_report(df).collect()}
    assert {"0", "1", "2"} <= set(rows) and rows["weighted avg"].support == 5
    assert abs(rows["weighted avg"].recall - 0.6) < 1e-12
    m = {r.label: (r.pred_0, r.pred_1, r.pred_2) for r in M.confusion_matrix(df).collect()}
    assert m == {0: (2, 0, 0), 1: (0, 0, 1), 2: (0, 1, 1)}


def test_naive_bayes_of_three_classes(spark):
    import math
    w = spark.createDataFrame([(1, "a", 1.0), (2, "b", 1.0), (3, "c", 1.0)], "row_id long, term string, weight double")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "row_id long, label int")
    priors, theta = ML.nb_fit_long(w, labels, w.select("term"))
    assert theta.count() == 3
    out = {r.row_id: r for r in ML.nb_predict_long(w, labels, priors, theta).collect()}
    assert [out[i].prediction for i in (1, 2, 3)] == [0, 1, 2]
    assert abs(out[1].score_0 - (math.log(1 / 3) + math.log(2 / 4))) < 1e-12
    assert abs(out[1].score_2 - (math.log(1 / 3) + math.log(1 / 4))) < 1e-12


def test_text_node_with_a_bare_bracket_is_one_node():
    assert extract_body("<p>a < b Sign Up</p><p>kept < too</p>")[1] == "kept < too"
    assert extract_body("<p>one <!-- Sign Up --> two</p>")[1].split() == ["one", "two"]


def test_link_to_a_url_stored_twice(spark):
    a = spark.createDataFrame([(2, "u", "later"), (1, "u", "first"), (3, None, "none")],
                              "page_id long, url string, body string")
    links = spark.createDataFrame([("u",), ("x" * 30 + "u",), ("?",), (None,)], "link string")
    got = [r.body for r in AR.lookup_bodies(links, "link", a, order_col="page_id").orderBy("link").collect()]
    assert sorted(got) == ["", "", "first", "first"]


def test_lemma_tags_from_a_table(spark):
    df = spark.createDataFrame([(1, ["boxes", "running", "box", "run"])], "id long, toks array<string>")
    tags = spark.createDataFrame([("running", "n")], "word string, tag string")
    plain = LX.lemmatize(df, "id", "toks").first().lemmatized
    tagged = LX.lemmatize(df, "id", "toks", tags=tags).first().lemmatized
    assert plain.split()[0] == tagged.split()[0] == "box" and tagged.split()[1] == "running"


def test_union_lcs_tie_passes_over_the_reference():
    # Both "a" and "b" are longest; the way back keeps the later candidate word's match.
    assert plain.lcs_positions(["a", "b"], ["b", "a"]) == {0}
    assert plain.lcs_table(list("abcde"), list("xaxcxe"))[-1, -1] == 3


def test_ridge_is_the_same_in_either_space():
    import numpy as np
    rng = np.random.default_rng(1)
    x, y, w = rng.normal(size=(12, 30)), rng.normal(size=12), rng.random(12)
    a, _ = _ridge(x, y, w, 0.5)
    wide_x = np.r_[x, x]
    b, _ = _ridge(np.r_[wide_x, wide_x], np.r_[y, y, y, y], np.r_[w, w, w, w] / 4, 0.5)
    assert np.allclose(a, b)


def test_quantiles_of_a_value_that_most_rows_hold(spark):
    import numpy as np
    from wryspark.operators.ordering import exact_quantiles
    df = spark.range(ROWS).select((F.col("id") % 2).alias("g"), F.when(F.col("id") % 10 > 0, F.lit(7.0)).otherwise(F.col("id") / 3).alias("v"))
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.97, 1.0]
    got = {(r.g, r.p): r.q for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    ids = np.arange(ROWS)
    values = np.where(ids % 10 > 0, 7.0, ids / 3)
    for g in (0, 1):
        for p in probs:
            assert abs(got[g, p] - np.quantile(values[ids % 2 == g], p)) < 1e-9
    whole = {r.p: r.q for r in exact_quantiles(df, "v", probs).collect()}
    assert all(abs(whole[p] - np.quantile(values, p)) < 1e-9 for p in probs)
    # Two values in all: what is ranked is one row for each.
    flags = spark.range(ROWS).select(F.when(F.col("id") % 10 > 0, F.lit(1)).otherwise(F.lit(0)).alias("v"))
    assert [r.q for r in exact_quantiles(flags, "v", [0.05, 0.5]).orderBy("p").collect()] == [0.0, 1.0]
    assert exact_quantiles(df.limit(0), "v", probs, ["g"]).count() == 0


def test_numbering_has_small_windows(spark, wide):
    from wryspark.operators.ordering import hashed_index
    rows = wide.withColumn("h", F.md5(F.col("text")))
    for digits in (2, 3, 5):
        idx = hashed_index(rows, "h", ["row_id"], ["g"], "i", "n", digits=digits)
        r = idx.groupBy("g").agg(F.min("i"), F.max("i"), F.countDistinct("i"), F.first("n"), F.count(F.lit(1))).collect()
        assert all((a, b + 1, c, n) == (0, k, k, k) for _, a, b, c, n, k in r)
    got = [x.row_id for x in hashed_index(rows, "h", ["row_id"], [], "i").orderBy("i").select("row_id").collect()]
    assert got == [x.row_id for x in rows.orderBy("h", "row_id").select("row_id").collect()]


def test_bounded_fit_rows(spark, wide):
    few = ML.bounded_fit_rows(wide, limit=1000)
    assert few.columns == wide.columns and few.count() == few.distinct().count() == 1000
    assert {r.row_id for r in few.collect()} == {r.row_id for r in ML.bounded_fit_rows(wide.repartition(7), limit=1000).collect()}
    assert ML.bounded_fit_rows(wide.limit(50).checkpoint(), limit=1000).count() == 50
