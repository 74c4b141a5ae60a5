"""Metric queries (M-01..M-05) on the stand-in predictions, and the
model queries (L-*, X-E*) whose results depend on a fitted model."""

from __future__ import annotations

from ..operators import metrics as M
from ..sources.tables import predictions
from .catalog import register

_COUNTS = """c AS (SELECT CAST(quality AS INTEGER) AS label, CAST(toxic AS INTEGER) AS prediction, count(*) AS n
  FROM labels GROUP BY ALL)"""


@register("binary_scores", "M-01 M-02 M-03",
          f"""WITH {_COUNTS}, a AS (SELECT sum(n) AS n, sum(n) FILTER (WHERE label = prediction) AS correct,
  coalesce(sum(n) FILTER (WHERE label = 1 AND prediction = 1), 0) AS tp,
  coalesce(sum(n) FILTER (WHERE label <> 1 AND prediction = 1), 0) AS fp,
  coalesce(sum(n) FILTER (WHERE label = 1 AND prediction <> 1), 0) AS fn FROM c)
SELECT round(correct / n, 6) AS accuracy,
  round(CASE WHEN tp + fp <> 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
  round(CASE WHEN tp + fn <> 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn <> 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1 FROM a""")
def binary_scores(spark, sf):
    from pyspark.sql import functions as F
    s = M.binary_scores(predictions(spark, sf))
    return s.select(*[F.round(c, 6).alias(c) for c in ["accuracy", "precision", "recall", "f1"]])


@register("binary_scores_by_split", "M-01 M-02 M-03",
          """WITH o AS (SELECT CAST(quality AS INTEGER) AS label, CAST(toxic AS INTEGER) AS prediction,
  row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || '-42'), doc_id) - 1 AS i, count(*) OVER () AS n FROM labels),
a AS (SELECT CASE WHEN i < ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split, count(*) AS n,
  count(*) FILTER (WHERE label = prediction) AS correct, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
  count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp, count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn
  FROM o GROUP BY 1)
SELECT split, round(correct / n, 6) AS accuracy, round(CASE WHEN tp + fp <> 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
  round(CASE WHEN tp + fn <> 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn <> 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1 FROM a""")
def binary_scores_by_split(spark, sf):
    from pyspark.sql import functions as F
    from ..operators import split as SP
    s = M.binary_scores(SP.random_split(predictions(spark, sf), 0.2), group_cols=["split"])
    return s.select("split", *[F.round(c, 6).alias(c) for c in ["accuracy", "precision", "recall", "f1"]])


_THREE = """c AS (SELECT CAST(quality + toxic AS INTEGER) AS label, CAST(doc_id % 3 AS INTEGER) AS prediction, count(*) AS n
  FROM labels GROUP BY ALL)"""


def _three_classes(spark, sf):
    from pyspark.sql import functions as F
    return predictions(spark, sf).select((F.col("label") + F.col("prediction")).alias("label"),
                                         (F.col("row_id") % 3).cast("int").alias("prediction"))


@register("three_class_report", "M-04",
          f"""WITH {_THREE}, k AS (SELECT label AS k FROM c UNION SELECT prediction FROM c),
pc AS (SELECT k, coalesce((SELECT sum(n) FROM c WHERE label = k AND prediction = k), 0) AS tp,
  coalesce((SELECT sum(n) FROM c WHERE prediction = k), 0) AS pp,
  coalesce((SELECT sum(n) FROM c WHERE label = k), 0) AS sup FROM k),
r AS (SELECT k, CASE WHEN pp <> 0 THEN tp / pp ELSE 0 END AS p, CASE WHEN sup <> 0 THEN tp / sup ELSE 0 END AS r, sup FROM pc),
f AS (SELECT *, CASE WHEN p + r <> 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM r),
t AS (SELECT sum(n) AS n, sum(n) FILTER (WHERE label = prediction) AS correct FROM c)
SELECT CAST(k AS VARCHAR) AS row_name, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(sup AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(correct / n, 6), CAST(n AS BIGINT) FROM t
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(any_value(n) AS BIGINT) FROM f, t
UNION ALL SELECT 'weighted avg', round(sum(p * sup) / any_value(n), 6), round(sum(r * sup) / any_value(n), 6),
  round(sum(f * sup) / any_value(n), 6), CAST(any_value(n) AS BIGINT) FROM f, t""")
def three_class_report(spark, sf):
    from pyspark.sql import functions as F
    r = M.classification_report(_three_classes(spark, sf))
    return r.select("row_name", *[F.round(c, 6).alias(c) for c in ["precision", "recall", "f1"]], "support")


@register("three_class_confusion", "M-05",
          f"""WITH {_THREE} SELECT label, CAST(coalesce(sum(n) FILTER (WHERE prediction = 0), 0) AS BIGINT) AS pred_0,
  CAST(coalesce(sum(n) FILTER (WHERE prediction = 1), 0) AS BIGINT) AS pred_1,
  CAST(coalesce(sum(n) FILTER (WHERE prediction = 2), 0) AS BIGINT) AS pred_2 FROM c GROUP BY label""")
def three_class_confusion(spark, sf):
    return M.confusion_matrix(_three_classes(spark, sf))


@register("classification_report", "M-04",
          f"""WITH {_COUNTS}, k AS (SELECT * FROM (VALUES (0), (1)) v(k)),
pc AS (SELECT k, coalesce((SELECT sum(n) FROM c WHERE label = k AND prediction = k), 0) AS tp,
  coalesce((SELECT sum(n) FROM c WHERE prediction = k), 0) AS pp,
  coalesce((SELECT sum(n) FROM c WHERE label = k), 0) AS sup FROM k),
r AS (SELECT k, CASE WHEN pp <> 0 THEN tp / pp ELSE 0 END AS p, CASE WHEN sup <> 0 THEN tp / sup ELSE 0 END AS r, sup FROM pc),
f AS (SELECT *, CASE WHEN p + r <> 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM r),
tot AS (SELECT sum(n) AS total, sum(n) FILTER (WHERE label = prediction) AS correct FROM c)
SELECT CAST(k AS VARCHAR) AS row_name, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1,
  CAST(sup AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(correct / total, 6), CAST(total AS BIGINT) FROM tot
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), (SELECT CAST(total AS BIGINT) FROM tot) FROM f
UNION ALL SELECT 'weighted avg', round(sum(p * sup) / sum(sup), 6), round(sum(r * sup) / sum(sup), 6),
  round(sum(f1 * sup) / sum(sup), 6), (SELECT CAST(total AS BIGINT) FROM tot) FROM f""")
def classification_report(spark, sf):
    from pyspark.sql import functions as F
    r = M.classification_report(predictions(spark, sf))
    return r.select("row_name", *[F.round(c, 6).alias(c) for c in ["precision", "recall", "f1"]], "support")


@register("confusion_matrix", "M-05",
          f"""WITH {_COUNTS} SELECT label, CAST(coalesce(sum(n) FILTER (WHERE prediction = 0), 0) AS BIGINT) AS pred_0,
  CAST(coalesce(sum(n) FILTER (WHERE prediction = 1), 0) AS BIGINT) AS pred_1 FROM c GROUP BY label""")
def confusion_matrix(spark, sf):
    return M.confusion_matrix(predictions(spark, sf))


# ---- models over the merged headline table, exact 80/20 split (seed 42) ----

from pyspark.ml import Pipeline  # noqa: E402
from pyspark.ml.functions import vector_to_array  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ..functions.wordlists import CLASS_NAMES  # noqa: E402
from ..operators import cbow as CB  # noqa: E402
from ..operators import encode as EN  # noqa: E402
from ..functions import text as T  # noqa: E402
from ..operators import explain as X  # noqa: E402
from ..operators import lexicon as LX  # noqa: E402
from ..operators import models as ML  # noqa: E402
from ..operators import selection as SL  # noqa: E402
from ..operators import split as SP  # noqa: E402
from ..operators.reconcile import merge_versions  # noqa: E402
from ..session import cut_lineage, ensure_checkpoint_dir  # noqa: E402
from ..sources import files as FS  # noqa: E402
from ..sources.tables import read_table, versions  # noqa: E402
from . import sqltext as S  # noqa: E402


def labelled_texts(spark, sf, lemmatised=True):
    """(row_id, headline, label) of the merged versions, the text cleaned and
    lemmatised. The merge and the tokens are each read several times and
    written once."""
    v1, v2 = versions(spark, sf)
    m = merge_versions(v1, v2).select("row_id", "headline", F.col("is_sarcastic").alias("label"))
    if lemmatised:
        m = cut_lineage(m.select("row_id", "label", T.ws_tokens(T.clean("headline")).alias("toks")))
        m = m.drop("toks").join(LX.lemmatize(m, "row_id", "toks", "headline"), "row_id") \
            .select("row_id", "headline", "label")
    return m


def labelled_split(spark, sf, lemmatised=True, stratified=False, texts=None):
    """(row_id, headline, label, split): merged versions, exact 80/20, by
    label if ``stratified``. The models take the cleaned, lemmatised text;
    queries that split it more than once pass the same stored ``texts``.

    Every fit, count and score reads this table several times; it is
    checkpointed once into the shared checkpoint folder instead of
    re-running the merge and the split for each reader."""
    m = labelled_texts(spark, sf, lemmatised) if texts is None else texts
    return cut_lineage(SP.random_split(m, 0.2, group_cols=["label"] if stratified else []))


def fit_pipeline(train, classifier, max_features=None):
    """Fit on a persisted training frame (each stage re-reads it), then
    release it; the returned model scores lazily."""
    train = train.persist()
    try:
        return ML.text_pipeline("headline", classifier, max_features).fit(train)
    finally:
        train.unpersist()


def _fit_score(spark, sf, classifier, max_features=None, with_n=False, stratified=False, texts=None, data=None):
    data = labelled_split(spark, sf, stratified=stratified, texts=texts) if data is None else data
    train = data.filter(F.col("split") == "train")
    clf = classifier(train.count()) if with_n else classifier
    model = fit_pipeline(train, clf, max_features)
    return model, model.transform(data)


def _split_scores(scored, name):
    s = M.binary_scores(scored.withColumn("prediction", F.col("prediction").cast("int")),
                        "label", "prediction", ["split"])
    return s.select(F.lit(name).alias("model"), "split", "accuracy", "f1")


@register("model_logistic", "L-01 L-07 M-01 M-02 P-01 E-01")
def model_logistic(spark, sf):
    """C = 1 (max 1000 iterations) on the 5,000-term TF-IDF, and C = 1e5
    uncapped after a split by label."""
    texts = cut_lineage(labelled_texts(spark, sf))
    _, a = _fit_score(spark, sf, lambda n: ML.logistic_regression(1.0, n, 1000), 5000, with_n=True, texts=texts)
    _, b = _fit_score(spark, sf, lambda n: ML.logistic_regression(1e5, n, 100), None, with_n=True, stratified=True, texts=texts)
    return _split_scores(a, "lr_c1_capped").unionByName(_split_scores(b, "lr_c1e5"))


@register("model_naive_bayes", "L-02 M-01 M-02")
def model_naive_bayes(spark, sf):
    """The 5,000-term TF-IDF, and uncapped after a split by label."""
    texts = cut_lineage(labelled_texts(spark, sf))
    _, a = _fit_score(spark, sf, ML.naive_bayes(), 5000, texts=texts)
    _, b = _fit_score(spark, sf, ML.naive_bayes(), None, stratified=True, texts=texts)
    return _split_scores(a, "naive_bayes").unionByName(_split_scores(b, "naive_bayes_uncapped"))


@register("model_kernel_svm", "L-03")
def model_kernel_svm(spark, sf):
    _, a = _fit_score(spark, sf, ML.kernel_svm(), 5000)
    return _split_scores(a, "svm_rff")


@register("model_landmark_svm", "L-03 S-07")
def model_landmark_svm(spark, sf):
    """The kernel SVM on landmark features, saved and loaded before it scores."""
    data = labelled_split(spark, sf)
    model, _ = _fit_score(spark, sf, ML.kernel_svm(landmarks=True), 5000, data=data)
    loaded = ML.save_and_load(model, FS.scratch_path(spark, "landmark-svm"))
    return _split_scores(loaded.transform(data), "svm_landmarks")


@register("model_random_forest", "L-04")
def model_random_forest(spark, sf):
    _, a = _fit_score(spark, sf, ML.random_forest(), 5000)
    return _split_scores(a, "random_forest")


@register("model_gradient_boosting", "L-05")
def model_gradient_boosting(spark, sf):
    ensure_checkpoint_dir(spark)
    _, a = _fit_score(spark, sf, ML.gradient_boosting(), 5000)
    return _split_scores(a, "gbt")


@register("model_dense_head", "L-06")
def model_dense_head(spark, sf):
    """MLP over the stored dense vectors, exact 80/20 split by vec_id."""
    from pyspark.ml.functions import array_to_vector
    e = read_table(spark, sf, "embeddings", ["vec_id", "embedding", "label"]) \
        .select(F.col("vec_id").alias("row_id"), array_to_vector("embedding").alias("features"),
                F.col("label").cast("double").alias("label"))
    shape = e.agg(F.max(F.size(vector_to_array("features"))).alias("d"),
                  F.max("label").cast("int").alias("k")).first()
    data = SP.random_split(e, 0.2)
    model = ML.dense_head(shape["d"], shape["k"] + 1).fit(data.filter(F.col("split") == "train"))
    s = M.binary_scores(model.transform(data).withColumn("prediction", F.col("prediction").cast("int"))
                        .withColumn("label", F.col("label").cast("int")), group_cols=["split"])
    return s.select(F.lit("mlp_50").alias("model"), "split", "accuracy")


@register("model_selection", "L-09 L-01 L-02")
def model_selection(spark, sf):
    """A grid of LR and NB on one TF-IDF table fitted on the training slice,
    chosen on the validation slice; the test slice scores the chosen one."""
    v1, v2 = versions(spark, sf)
    m = merge_versions(v1, v2).select("row_id", "headline", F.col("is_sarcastic").alias("label"))
    data = cut_lineage(SL.three_way_split(m))
    train = data.filter(F.col("split") == "train")
    tfidf = Pipeline(stages=EN.tfidf_stages("headline", "features", 5000)).fit(train)
    features = cut_lineage(tfidf.transform(data).select("row_id", "label", "split", "features"))
    n = train.count()
    lr, nb = ML.logistic_regression(1.0, n, 1000), ML.naive_bayes()
    candidates = [("lr", lr, {"regParam": 1.0 / (c * n)}) for c in (0.1, 1.0, 10.0)]
    candidates += [("nb", nb, {"smoothing": a}) for a in (0.1, 1.0)]
    return SL.fit_grid(features, candidates)


@register("word2vec_vectors", "E-05 T-05")
def word2vec_vectors(spark, sf):
    v1, v2 = versions(spark, sf)
    m = merge_versions(v1, v2).select("row_id", T.ws_tokens(T.clean("headline")).alias("toks"))
    lem = LX.lemmatize(m, "row_id", "toks", "lemmatized_headline")
    vec = ML.word_vectors(lem.select("row_id", T.word_tokens("lemmatized_headline").alias("tokens")), "tokens")
    return vec.select("word", F.size(vector_to_array("vector")).alias("dim"))


@register("cbow_vectors", "E-05 T-05")
def cbow_vectors(spark, sf):
    """Continuous-bag-of-words vectors, 100 numbers a word, of the lemmatised
    headlines (rows-only: they are trained)."""
    v1, v2 = versions(spark, sf)
    m = merge_versions(v1, v2).select("row_id", T.ws_tokens(T.clean("headline")).alias("toks"))
    lem = LX.lemmatize(m, "row_id", "toks", "lemmatized_headline")
    return CB.cbow_vectors(lem.select("row_id", T.word_tokens("lemmatized_headline").alias("tokens")), "row_id", "tokens")


@register("model_roundtrip", "S-07 L-07")
def model_roundtrip(spark, sf):
    """Save the fitted pipeline under the checkpoint folder, load it back,
    and count test rows whose predictions agree."""
    import os
    import uuid
    root = ensure_checkpoint_dir(spark)
    data = labelled_split(spark, sf)
    model, _ = _fit_score(spark, sf, ML.naive_bayes(), 5000, data=data)
    path = os.path.join(root, "models", f"nb-{uuid.uuid4().hex}")
    loaded = ML.save_and_load(model, path)
    a = model.transform(data).select("row_id", F.col("prediction").alias("p1"))
    b = loaded.transform(data).select("row_id", F.col("prediction").alias("p2"))
    return a.join(b, "row_id").agg(F.count(F.lit(1)).alias("n"),
                                   F.sum((F.col("p1") == F.col("p2")).cast("int")).alias("n_equal"))


@register("batch_inference", "L-08 K-04 M-07 V-03")
def batch_inference(spark, sf):
    """A fitted LR exported as plain coefficients and served per worker
    through ``predict_batch_udf``; compared with the pipeline's own output."""
    data = labelled_split(spark, sf)
    train = data.filter(F.col("split") == "train")
    model = fit_pipeline(train, ML.logistic_regression(1.0, train.count(), 1000), 5000)
    lr = model.stages[-1]
    scored = model.transform(data)
    predict = ML.linear_batch_predictor(lr.coefficients.toArray(), lr.intercept)
    out = scored.withColumn("p_batch", predict(vector_to_array("features")))
    probs = vector_to_array("probability")
    return out.select("row_id", F.round("p_batch", 6).alias("p_batch"),
                      F.round(probs[1], 6).alias("p_model"), M.threshold("p_batch").alias("pred_batch"),
                      M.argmax(probs).alias("pred_model"))


@register("log_loss", "M-06 M-07")
def log_loss(spark, sf):
    _, a = _fit_score(spark, sf, ML.naive_bayes(), 5000)
    a = a.withColumn("p", vector_to_array("probability"))
    return M.cross_entropy(a, "label", "p", group_cols=["split"]).withColumn(
        "log_loss", F.bround("log_loss", 4))


@register("lime_explanations", "X-E1 V-04 P-07")
def lime_explanations(spark, sf):
    """Local word weights for three seeded test rows, for LR and NB."""
    data = labelled_split(spark, sf)
    train = data.filter(F.col("split") == "train")
    picks = SP.sample_rows(data.filter(F.col("split") == "test"), 3, "row_id", seed=7)
    out = None
    for name, clf in [("lr", ML.logistic_regression(1e5, train.count(), 100)), ("nb", ML.naive_bayes())]:
        model = fit_pipeline(train, clf)
        e = X.explain_rows(model, picks, "headline").withColumn("model", F.lit(name))
        out = e if out is None else out.unionByName(e)
    return out


@register("probability_report", "X-E3 Q-11 P-07")
def probability_report(spark, sf):
    data = labelled_split(spark, sf)
    train = data.filter(F.col("split") == "train")
    model = fit_pipeline(train, ML.naive_bayes())
    picks = SP.sample_rows(data.filter(F.col("split") == "test"), 3, "row_id", seed=7)
    return X.probability_report(model, picks, "label", CLASS_NAMES)


@register("linear_attributions", "X-E2 E-01")
def linear_attributions(spark, sf):
    """Per test row, the ten terms with the largest ``w_j (x_j - mean_j)``
    under a linear model fitted on the long TF-IDF table."""
    data = labelled_split(spark, sf)
    train = data.filter(F.col("split") == "train")
    idf = EN.tfidf_fit(train, "headline")
    tw = EN.tfidf_apply(train, idf, "headline")
    pipe = fit_pipeline(train, ML.logistic_regression(1.0, train.count(), 1000))
    vocab = pipe.stages[1].vocabulary
    coefs = pipe.stages[-1].coefficients.toArray().tolist()
    coef_df = spark.createDataFrame(list(zip(vocab, coefs)), "term string, coef double")
    test_w = EN.tfidf_apply(data.filter(F.col("split") == "test"), idf, "headline")
    n_train = train.agg(F.count(F.lit(1))).scalar()
    return X.linear_attribution(test_w, coef_df, tw, n_train)


# ---- naive Bayes in relational form (checked against SQL) ----

def _nb_ctes(split: str = "CASE WHEN i < ceil(0.2 * n) THEN 'test' ELSE 'train' END") -> str:
    h = "md5(CAST(row_id AS VARCHAR) || '-42')"
    return f"""WITH {S.HEADLINES},
o AS (SELECT row_id, headline, is_sarcastic AS label, row_number() OVER (ORDER BY {h}, row_id) - 1 AS i,
  count(*) OVER () AS n FROM merged),
d AS (SELECT *, {split} AS split FROM o),
tt AS (SELECT row_id, split, term, count(*) AS tf FROM (SELECT row_id, split,
  unnest(regexp_extract_all(lower(headline), {S.q(EN.TERM_PATTERN)})) AS term FROM d) GROUP BY ALL),
nt AS (SELECT count(*) AS n FROM d WHERE split = 'train'),
idf AS (SELECT term, ln((1 + n) / (1 + count(*))) + 1 AS idf FROM tt, nt WHERE split = 'train' GROUP BY term, n),
w0 AS (SELECT row_id, split, term, tf * idf AS w FROM tt JOIN idf USING (term)),
w AS (SELECT row_id, split, term, w / sqrt(sum(w * w) OVER (PARTITION BY row_id)) AS weight FROM w0),
pri AS (SELECT label, ln(count(*) / (SELECT n FROM nt)) AS log_prior FROM d WHERE split = 'train' GROUP BY label),
v AS (SELECT count(*) AS v FROM idf),
g AS (SELECT label, term FROM pri, idf),
ncj AS (SELECT g.label, g.term, coalesce(sum(w.weight), 0) AS ncj FROM g
  LEFT JOIN (SELECT w.*, d.label FROM w JOIN d USING (row_id) WHERE w.split = 'train') w
  ON w.label = g.label AND w.term = g.term GROUP BY g.label, g.term),
nc AS (SELECT label, sum(ncj) AS nc FROM ncj GROUP BY label),
th AS (SELECT ncj.label, term, ln((ncj + 1.0) / (nc + 1.0 * v)) AS log_theta FROM ncj JOIN nc USING (label), v),
ll AS (SELECT w.row_id, th.label, sum(w.weight * th.log_theta) AS ll FROM w JOIN th USING (term)
  WHERE w.split = 'test' GROUP BY ALL),
sc AS (SELECT t.row_id, p.label, p.log_prior + coalesce(ll.ll, 0) AS score FROM (SELECT row_id FROM d WHERE split = 'test') t
  CROSS JOIN pri p LEFT JOIN ll ON ll.row_id = t.row_id AND ll.label = p.label)"""


def _nb_sql() -> str:
    return f"""{_nb_ctes()}
SELECT row_id, CAST(arg_max(label, score * 1e0 - label * 1e-300) AS INTEGER) AS prediction,
  round(max(score) FILTER (WHERE label = 0), 6) AS score_0, round(max(score) FILTER (WHERE label = 1), 6) AS score_1
FROM sc GROUP BY row_id"""


def _nb_scores(spark, sf):
    """Scored test rows of the relational NB on the text as it is, with what
    they were made from: test rows, priors, theta, train and test weights."""
    data = labelled_split(spark, sf, lemmatised=False)
    train = data.filter(F.col("split") == "train")
    test = data.filter(F.col("split") == "test")
    # Term counts of both splits feed the fit and the scores.
    terms = cut_lineage(EN.term_table(data, "headline"))
    own = train.select("row_id")
    idf = cut_lineage(EN.idf_of(terms.join(own, "row_id", "left_semi"), train.agg(F.count(F.lit(1))).scalar()))
    # The fit, the means and the test rows read the weights.
    weights = cut_lineage(EN.weights_of(terms, idf))
    train_w = weights.join(own, "row_id", "left_semi")
    test_w = weights.join(test.select("row_id"), "row_id", "left_semi")
    priors, theta = ML.nb_fit_long(train_w, train.select("row_id", "label"), idf.select("term"))
    return ML.nb_predict_long(test_w, test, priors, theta), test, priors, theta, train_w, test_w, train


@register("nb_probabilities", "K-04 M-07", f"""{_nb_ctes()},
p AS (SELECT row_id, max(score) FILTER (WHERE label = 0) AS s0, max(score) FILTER (WHERE label = 1) AS s1 FROM sc GROUP BY row_id)
SELECT row_id, round(1 / (1 + exp(s0 - s1)), 6) AS p_1, CASE WHEN 1 / (1 + exp(s0 - s1)) > 0.5 THEN 1 ELSE 0 END AS pred_threshold,
  CASE WHEN s1 > s0 THEN 1 ELSE 0 END AS pred_argmax FROM p""")
def nb_probabilities(spark, sf):
    s = _nb_scores(spark, sf)[0]
    p1 = 1 / (1 + F.exp(F.col("score_0") - F.col("score_1")))
    return s.select("row_id", F.round(p1, 6).alias("p_1"), M.threshold(p1).alias("pred_threshold"),
                    M.argmax(F.array("score_0", "score_1")).alias("pred_argmax"))


@register("nb_log_loss", "M-06", f"""{_nb_ctes()},
p AS (SELECT row_id, max(score) FILTER (WHERE label = 0) AS s0, max(score) FILTER (WHERE label = 1) AS s1 FROM sc GROUP BY row_id),
q AS (SELECT d.label, CASE WHEN d.label = 1 THEN 1 / (1 + exp(s0 - s1)) ELSE 1 / (1 + exp(s1 - s0)) END AS pl FROM p JOIN d USING (row_id))
SELECT round(avg(-ln(least(greatest(pl, 1e-15), 1 - 1e-15))), 6) AS log_loss FROM q""")
def nb_log_loss(spark, sf):
    s, test, *_ = _nb_scores(spark, sf)
    gap = F.col("score_0") - F.col("score_1")
    p = s.withColumn("p", F.array(1 / (1 + F.exp(-gap)), 1 / (1 + F.exp(gap)))).join(test.select("row_id", "label"), "row_id")
    return M.cross_entropy(p, "label", "p").withColumn("log_loss", F.round("log_loss", 6))


SMOOTHING = [0.0001, 0.001, 0.01, 0.1, 1.0, 10.0]

_GRID = f"""{_nb_ctes("CASE WHEN i < ceil(0.2 * n) THEN 'test' WHEN i < ceil(0.2 * n) + ceil(0.1 * n) THEN 'val' ELSE 'train' END")},
al AS (SELECT unnest(CAST({SMOOTHING} AS DOUBLE[])) AS alpha),
ga AS (SELECT alpha, w.row_id, g.label, sum(weight * ln((ncj + alpha) / (nc + alpha * v))) AS s FROM w
  JOIN ncj g ON g.term = w.term JOIN nc ON nc.label = g.label, v, al WHERE w.split <> 'train' GROUP BY ALL),
gs AS (SELECT al.alpha AS alpha, d.row_id, d.split, d.label, p.label AS c, p.log_prior + coalesce(s, 0) AS score FROM d CROSS JOIN al CROSS JOIN pri p
  LEFT JOIN ga ON ga.row_id = d.row_id AND ga.label = p.label AND ga.alpha = al.alpha WHERE d.split <> 'train'),
gp AS (SELECT alpha, row_id, split, any_value(label) AS label, first(c ORDER BY score DESC, c) AS guess FROM gs GROUP BY ALL),
gt AS (SELECT alpha, avg(CASE WHEN label = guess THEN 1.0 ELSE 0.0 END) FILTER (WHERE split = 'val') AS val_accuracy,
  avg(CASE WHEN label = guess THEN 1.0 ELSE 0.0 END) FILTER (WHERE split = 'test') AS t FROM gp GROUP BY alpha),
gc AS (SELECT *, row_number() OVER (ORDER BY val_accuracy DESC, alpha) = 1 AS chosen FROM gt)"""


@register("nb_smoothing_selection", "L-09 L-02", f"""{_GRID} SELECT alpha, round(val_accuracy, 6) AS val_accuracy, chosen,
  CASE WHEN chosen THEN round(t, 6) END AS test_accuracy FROM gc""")
def nb_smoothing_selection(spark, sf):
    """The relational NB's smoothing chosen on the validation slice."""
    v1, v2 = versions(spark, sf)
    m = merge_versions(v1, v2).select("row_id", "headline", F.col("is_sarcastic").alias("label"))
    data = cut_lineage(SL.three_way_split(m))
    train = data.filter(F.col("split") == "train").select("row_id")
    terms = cut_lineage(EN.term_table(data, "headline"))
    idf = EN.idf_of(terms.join(train, "row_id", "left_semi"), train.agg(F.count(F.lit(1))).scalar())
    weights = cut_lineage(EN.weights_of(terms, idf))
    g = SL.nb_grid(weights, data.select("row_id", "label", "split"), SMOOTHING)
    return g.select("alpha", F.round("val_accuracy", 6).alias("val_accuracy"), "chosen",
                    F.round("test_accuracy", 6).alias("test_accuracy"))


@register("nb_attributions", "X-E2 L-02", f"""{_nb_ctes()},
co AS (SELECT term, max(log_theta) FILTER (WHERE label = 1) - max(log_theta) FILTER (WHERE label = 0) AS coef FROM th GROUP BY term),
me AS (SELECT term, sum(weight) / (SELECT n FROM nt) AS mean FROM w WHERE split = 'train' GROUP BY term),
att AS (SELECT w.row_id, w.term, coef * (weight - coalesce(mean, 0)) AS attribution FROM w JOIN co USING (term)
  LEFT JOIN me USING (term) WHERE w.split = 'test'),
rk AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY round(abs(attribution), 9) DESC, term) AS rank FROM att)
SELECT row_id, CAST(rank AS BIGINT) AS rank, term, round(attribution, 6) AS attribution FROM rk WHERE rank <= 10""")
def nb_attributions(spark, sf):
    """Per test row, the ten terms with the largest attribution under the log
    odds of the relational NB."""
    _, _, priors, theta, train_w, test_w, train = _nb_scores(spark, sf)
    d = priors.agg(F.max(F.when(F.col("label") == 0, F.col("log_default"))).alias("d0"),
                   F.max(F.when(F.col("label") == 1, F.col("log_default"))).alias("d1"))
    per = theta.groupBy("term").agg(F.max(F.when(F.col("label") == 0, F.col("log_theta"))).alias("t0"),
                                    F.max(F.when(F.col("label") == 1, F.col("log_theta"))).alias("t1"))
    coef = per.select("term", (F.coalesce("t1", d.select("d1").scalar())
                               - F.coalesce("t0", d.select("d0").scalar())).alias("coef"))
    a = X.linear_attribution(test_w, coef, train_w, train.agg(F.count(F.lit(1))).scalar())
    return a.select("row_id", F.col("rank").cast("bigint").alias("rank"), "term",
                    F.round("attribution", 6).alias("attribution"))


@register("naive_bayes_sql", "L-02 J-05", _nb_sql())
def naive_bayes_sql(spark, sf):
    pred = _nb_scores(spark, sf)[0]
    return pred.select("row_id", F.col("prediction").cast("int").alias("prediction"),
                       F.round("score_0", 6).alias("score_0"), F.round("score_1", 6).alias("score_1"))
