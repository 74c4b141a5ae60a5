"""Reconciling dataset versions: Q-01..Q-11, J-01, J-02, U-01..U-04.

Every function is ``DataFrame -> DataFrame`` and takes column names.
Row order is never taken from partition order: a merged table carries
``version`` and ``row_id`` so "v1 rows first, then v2" stays explicit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.wordlists import CLASS_NAMES


def drop_nulls(df: DataFrame) -> DataFrame:
    """Q-03: drop rows with a null in any column."""
    return df.na.drop("any")


def _digest_join(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    digest = F.unhex(F.md5(F.col(key).cast("string")))
    return left.join(right.select(digest.alias("_digest")).distinct(),
                     F.unhex(F.md5(left[key].cast("string"))) == F.col("_digest"), how)


def anti_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """J-01: rows of ``left`` whose ``key`` is absent from ``right``.

    Multiplicity inside ``left`` is kept. Keys are compared by their MD5
    (16 bytes), as they may be long texts; ``right`` is reduced to its
    distinct digests first (a partial aggregate before the shuffle), and no
    broadcast is forced: AQE converts to a broadcast join only when the
    distinct side turns out small at runtime.
    """
    return _digest_join(left, right, key, "left_anti")


def semi_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """J-02: rows of ``left`` whose ``key`` occurs in ``right``."""
    return _digest_join(left, right, key, "left_semi")


def bag_union(*dfs: DataFrame) -> DataFrame:
    """U-01: UNION ALL by column name (Q-01's reorder is implicit)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def merge_versions(v1: DataFrame, v2: DataFrame, key: str = "headline") -> DataFrame:
    """U-03: drop nulls in both, keep v2 rows whose key is not in v1, append.

    Adds ``version`` (1 or 2) so the merged order (v1 first) survives.
    """
    a = drop_nulls(v1).withColumn("version", F.lit(1))
    b = anti_join(drop_nulls(v2), drop_nulls(v1), key).withColumn("version", F.lit(2))
    return bag_union(a, b.select(*a.columns))


def common_distinct(v1: DataFrame, v2: DataFrame, key: str = "headline") -> DataFrame:
    """U-02: distinct keys present in both."""
    return v1.select(key).intersect(v2.select(key))


def except_distinct(v1: DataFrame, v2: DataFrame, key: str = "headline") -> DataFrame:
    """U-04: distinct keys of ``v1`` missing from ``v2``."""
    return v1.select(key).subtract(v2.select(key))


def label_filter(df: DataFrame, label_col: str = "is_sarcastic", value: int = 1) -> DataFrame:
    """Q-02."""
    return df.filter(F.col(label_col) == value)


def word_count_filter(df: DataFrame, text_col: str, limit: int = 30, keep_long: bool = True):
    """Q-05: rows with more than ``limit`` whitespace words, or the complement.

    A null text has no words, so it lands in the complement.
    """
    from ..functions.features import word_count
    wc = F.coalesce(word_count(text_col), F.lit(0))
    return df.filter(wc > limit) if keep_long else df.filter(wc <= limit)


def head(df: DataFrame, order_col: str = "row_id", n: int = 5) -> DataFrame:
    """Q-06: first ``n`` rows by an explicit order (TakeOrderedAndProject)."""
    return df.orderBy(order_col).limit(n)


def shape(df: DataFrame) -> DataFrame:
    """Q-07: one row ``(n_rows, n_columns)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint"))


def lookup(df: DataFrame, keys: DataFrame, key: str = "row_id") -> DataFrame:
    """Q-09: keyed row lookup as a semi-join to a key table."""
    return df.join(keys.select(key).distinct(), key, "left_semi")


def constant_column(df: DataFrame, name: str, value) -> DataFrame:
    """Q-10."""
    return df.withColumn(name, F.lit(value))


def class_name(c, names=None):
    """Q-11: label 0/1 to its display name."""
    names = names or CLASS_NAMES
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col == 1, names[1]).when(col == 0, names[0])
