"""Classification metrics (M-01..M-07) from one ``(label, prediction)``
count table: a single grouped aggregate feeds every metric, so the scored
rows are reduced to one row per pair of classes before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion_counts(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                     group_cols: list[str] = ()) -> DataFrame:
    return df.groupBy(*group_cols, F.col(label_col).alias("label"), F.col(pred_col).alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))


def class_list(counts: DataFrame, limit: int = 1000) -> list:
    """All classes that occur as a label or a prediction, ascending. More
    than ``limit`` raise an error: they would all become columns."""
    seen = (counts.select(F.col("label").alias("c")).unionByName(counts.select(F.col("prediction").alias("c")))
            .filter("c is not null").distinct().orderBy("c").limit(limit + 1).collect())
    if len(seen) > limit:
        raise ValueError(f"more than {limit} classes")
    return [r["c"] for r in seen]


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def binary_scores(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                  group_cols: list[str] = (), positive: int = 1) -> DataFrame:
    """M-01..M-03: accuracy and positive-class precision, recall, F1
    (0 when undefined), per group (e.g. per split)."""
    c = confusion_counts(df, label_col, pred_col, group_cols)
    s = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    agg = c.groupBy(*group_cols).agg(
        s(F.lit(True)).alias("n"),
        s(F.col("label") == F.col("prediction")).alias("correct"),
        s((F.col("label") == positive) & (F.col("prediction") == positive)).alias("tp"),
        s((F.col("label") != positive) & (F.col("prediction") == positive)).alias("fp"),
        s((F.col("label") == positive) & (F.col("prediction") != positive)).alias("fn"))
    p = _safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    r = _safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    return agg.select(*group_cols, (F.col("correct") / F.col("n")).alias("accuracy"),
                      p.alias("precision"), r.alias("recall"),
                      _safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def classification_report(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                          classes=None) -> DataFrame:
    """M-04: per-class precision/recall/F1/support, then accuracy, macro
    and weighted averages, as rows ``(row_name, precision, recall, f1, support)``.
    ``classes`` are those of the data unless given."""
    c = confusion_counts(df, label_col, pred_col)
    classes = class_list(c) if classes is None else classes
    s = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    cols = [s(F.lit(True)).alias("total"), s(F.col("label") == F.col("prediction")).alias("correct")]
    for k in classes:
        cols += [s((F.col("label") == k) & (F.col("prediction") == k)).alias(f"tp{k}"),
                 s(F.col("prediction") == k).alias(f"pp{k}"),
                 s(F.col("label") == k).alias(f"sup{k}")]
    t = c.agg(*cols)
    rows = []
    for k in classes:
        p = _safe_div(F.col(f"tp{k}"), F.col(f"pp{k}"))
        r = _safe_div(F.col(f"tp{k}"), F.col(f"sup{k}"))
        f = _safe_div(2 * p * r, p + r)
        rows.append(F.struct(F.lit(str(k)).alias("row_name"), p.alias("precision"), r.alias("recall"),
                             f.alias("f1"), F.col(f"sup{k}").cast("bigint").alias("support")))
    t = t.withColumn("_cls", F.array(*rows))
    avg = lambda field, weighted: (
        F.aggregate(F.col("_cls"), F.lit(0.0), lambda a, x: a + x[field] * (x["support"] if weighted else 1))
        / (F.col("total") if weighted else F.lit(len(classes))))
    summary = [
        F.struct(F.lit("accuracy").alias("row_name"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), (F.col("correct") / F.col("total")).alias("f1"),
                 F.col("total").cast("bigint").alias("support")),
        F.struct(F.lit("macro avg").alias("row_name"), avg("precision", False).alias("precision"),
                 avg("recall", False).alias("recall"), avg("f1", False).alias("f1"),
                 F.col("total").cast("bigint").alias("support")),
        F.struct(F.lit("weighted avg").alias("row_name"), avg("precision", True).alias("precision"),
                 avg("recall", True).alias("recall"), avg("f1", True).alias("f1"),
                 F.col("total").cast("bigint").alias("support")),
    ]
    return t.select(F.inline(F.concat(F.col("_cls"), F.array(*summary))))


def confusion_matrix(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                     classes=None) -> DataFrame:
    """M-05: rows = true label, one column per predicted class; ``classes``
    are those of the data unless given."""
    c = confusion_counts(df, label_col, pred_col)
    classes = class_list(c) if classes is None else classes
    return c.groupBy("label").pivot("prediction", list(classes)).agg(F.sum("n")) \
        .select("label", *[F.coalesce(F.col(str(k)), F.lit(0)).cast("bigint").alias(f"pred_{k}") for k in classes])


def cross_entropy(df: DataFrame, label_col: str, prob_col: str, eps: float = 1e-15,
                  group_cols: list[str] = ()) -> DataFrame:
    """M-06: mean ``-ln p[label]`` with probabilities clipped to [eps, 1-eps].
    ``prob_col`` is an array of class probabilities."""
    p = F.element_at(F.col(prob_col), F.col(label_col).cast("int") + 1)
    p = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    return df.groupBy(*group_cols).agg(F.avg(-F.log(p)).alias("log_loss"))


def threshold(c, cut: float = 0.5) -> Column:
    """M-07: 1 when the probability exceeds ``cut``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col > cut, 1).otherwise(0)


def argmax(c) -> Column:
    """K-04: 0-based index of the largest entry of an array."""
    col = F.col(c) if isinstance(c, str) else c
    return (F.array_position(col, F.array_max(col)) - 1).cast("int")
