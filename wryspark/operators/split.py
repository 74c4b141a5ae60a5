"""Seeded shuffles, splits and samples (P-01..P-08, K-05, W-03, Q-08).

The pseudo-random order is the hex MD5 of ``"<row_id>-<seed>"``; the
same order is reproducible in any engine with MD5. Exact-size splits use
``hashed_index`` (hash buckets + prefix sums), never a single-task
``row_number``; the hash-threshold split needs no ordering at all.
Samples of k rows are ``orderBy(...).limit(k)``: a partial top-k per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import hashed_index


def seeded_hash(key, seed: int = 42) -> Column:
    """K-05: hex MD5 of ``"<key>-<seed>"``."""
    c = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(c.cast("string"), F.lit(f"-{seed}")))


def shuffled(df: DataFrame, key: str = "row_id", seed: int = 42, name: str = "idx") -> DataFrame:
    """K-05/P-03/Q-08: dense 0-based position in the seeded order."""
    return hashed_index(df.withColumn("_h", seeded_hash(key, seed)), "_h", [key], [], name).drop("_h")


def random_split(df: DataFrame, test_fraction: float = 0.2, key: str = "row_id",
                 seed: int = 42, group_cols: list[str] = ()) -> DataFrame:
    """P-01 (no groups) / P-02 (``group_cols`` = label): the first
    ``ceil(test_fraction * n)`` rows of the seeded order form the test split,
    counted per group when stratified."""
    h = df.withColumn("_h", seeded_hash(key, seed))
    idx = hashed_index(h, "_h", [key], list(group_cols), "_idx", "_n")
    n_test = F.ceil(F.lit(test_fraction) * F.col("_n"))
    return idx.withColumn("split", F.when(F.col("_idx") < n_test, "test").otherwise("train")) \
        .drop("_h", "_idx", "_n")


def ordered_slices(df: DataFrame, fractions: dict[str, float], key: str = "row_id",
                   seed: int = 42) -> DataFrame:
    """P-04/W-03: seeded shuffle, then consecutive slices cut at
    ``int(cumulative_share * n)`` (running float sum, as the reference)."""
    idx = hashed_index(df.withColumn("_h", seeded_hash(key, seed)), "_h", [key], [], "_idx", "_n")
    split = None
    lo = F.lit(0.0)
    cum = 0.0
    for name, frac in fractions.items():
        cum = cum + frac
        hi = F.floor(F.lit(cum) * F.col("_n"))
        cond = (F.col("_idx") >= F.floor(lo * F.col("_n"))) & (F.col("_idx") < hi)
        split = F.when(cond, name) if split is None else split.when(cond, name)
        lo = F.lit(cum)
    return idx.withColumn("split", split).filter(F.col("split").isNotNull()).drop("_idx", "_n", "_h")


def hash_split(df: DataFrame, text_col: str, train_fraction: float = 0.8) -> DataFrame:
    """P-05: split by the MD5 of the text itself, so identical texts always
    land on the same side. No shuffle, no ordering."""
    threshold = format(int(train_fraction * 16 ** 8), "08x")
    return df.withColumn("split", F.when(F.md5(F.col(text_col)) < F.lit(threshold), "train")
                         .otherwise("test"))


def sample_rows(df: DataFrame, k: int, key: str = "row_id", seed: int = 42) -> DataFrame:
    """P-06/P-07/P-08: ``k`` distinct rows of the seeded order."""
    return df.withColumn("_h", seeded_hash(key, seed)).orderBy("_h", key).limit(k).drop("_h")


def leakage(split_df: DataFrame, text_col: str) -> DataFrame:
    """M-08: distinct texts present in both the train and the test split."""
    per = split_df.groupBy(text_col).agg(
        F.max((F.col("split") == "train").cast("int")).alias("_tr"),
        F.max((F.col("split") == "test").cast("int")).alias("_te"))
    return per.agg(F.coalesce(F.sum(F.col("_tr") * F.col("_te")), F.lit(0)).cast("bigint").alias("leaked_texts"))
