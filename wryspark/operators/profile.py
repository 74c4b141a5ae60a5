"""Exploratory aggregates (A-01..A-16), top-k (K-01..K-02) and the
order-dependent n-gram stream (W-01, W-02).

Per-label reports are one ``groupBy(label, ...)`` instead of one pass per
label. Top-k uses ``row_number() <= k`` which Spark plans with a partial
``WindowGroupLimit`` before the shuffle, so only k rows per label and
map task move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import block_of, dense_index, stream_key


def explode_tokens(df: DataFrame, tokens_col: str, keep: list[str],
                   token_name: str = "word") -> DataFrame:
    """One row per token with its 0-based position.

    ``posexplode_outer`` + a null filter instead of ``posexplode``: the
    latter makes the optimizer infer ``size(tokens) > 0`` and push it
    below joins, which evaluates the whole tokenizer twice per row.
    """
    return (df.select(*keep, F.posexplode_outer(tokens_col).alias("pos", token_name))
            .filter(F.col(token_name).isNotNull()))


def token_counts(df: DataFrame, tokens_col: str, group_cols: list[str],
                 version_col: str = "version", row_col: str = "row_id",
                 token_name: str = "word") -> DataFrame:
    """A-10/A-11/A-16: count tokens per group; ``first_seen`` is the stream
    position of the first occurrence (W-02) in (version, row, position) order."""
    ex = explode_tokens(df, tokens_col, [*group_cols, version_col, row_col], token_name)
    return ex.groupBy(*group_cols, token_name).agg(
        F.count(F.lit(1)).alias("count"),
        F.min(stream_key(version_col, row_col, "pos")).alias("first_seen"))


def top_k(counts: DataFrame, group_cols: list[str], k: int = 20,
          order=("count", "first_seen")) -> DataFrame:
    """K-01: best ``k`` per group: count desc, then first appearance."""
    w = Window.partitionBy(*group_cols).orderBy(F.col(order[0]).desc(), *[F.col(c) for c in order[1:]])
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def stream_ngrams(df: DataFrame, tokens_col: str, group_cols: list[str], n: int = 2,
                  version_col: str = "version", row_col: str = "row_id",
                  boundary: str = "cross", block_rows: int = 1 << 16,
                  sep: str = " ") -> DataFrame:
    """W-01: n-grams of each group's token stream, rows concatenated in
    (version, row_id) order (``boundary='cross'``) or per row (``'row'``).

    Output: group columns, ``version``, ``row_id``, ``pos`` (start position
    inside the row) and ``ngram``. An n-gram belongs to the row it starts in;
    its tail may come from the next non-empty rows. Rows are numbered densely
    in stream order (``dense_index``; empty rows apart) and cut into blocks of
    ``block_rows`` of them, whatever their ids. The "next n-1 tokens after a
    row" come from the first n-1 tokens of the next rows in its block; blocks
    pass a carry of n-1 tokens through a per-block table, so no window spans
    a whole label and none holds more than the heads of rows.
    """
    rows = df.select(*group_cols, version_col, row_col, F.col(tokens_col).alias("_t"))
    if boundary == "row" or n == 1:
        ext = rows.withColumn("_ext", F.col("_t"))
    else:
        need = n - 1
        groups = [*group_cols, "_ne"]
        rows = dense_index(rows.withColumn("_ne", F.size("_t") > 0), [version_col, row_col], groups, "_i")
        rows = rows.withColumn("_blk", block_of("_i", block_rows)).withColumn("_head", F.slice("_t", 1, need))
        by_row = Window.partitionBy(*groups, "_blk").orderBy("_i")
        rows = rows.withColumn("_in_blk", F.flatten(F.collect_list("_head").over(by_row.rowsBetween(1, need))))
        # The first n-1 tokens of a block are in the heads of its first n-1 rows.
        heads = (rows.filter(F.col("_i") % block_rows < need).groupBy(*groups, "_blk")
                 .agg(F.sort_array(F.collect_list(F.struct("_i", "_head"))).alias("_hs"))
                 .withColumn("_h", F.slice(F.flatten(F.transform("_hs", lambda x: x["_head"])), 1, need)))
        by_blk = Window.partitionBy(*groups).orderBy("_blk").rowsBetween(1, need)
        keys = [*groups, "_blk"]
        carry = heads.withColumn("_carry", F.slice(F.flatten(F.collect_list("_h").over(by_blk)), 1, need)) \
            .select(*[F.col(k).alias(f"_c{i}") for i, k in enumerate(keys)], "_carry")
        cond = [F.col(k).eqNullSafe(F.col(f"_c{i}")) for i, k in enumerate(keys)]
        rows = rows.join(carry, cond, "left").drop(*[f"_c{i}" for i in range(len(keys))])
        ext = rows.withColumn("_ext", F.concat(
            "_t", F.slice(F.concat("_in_blk", F.coalesce("_carry", F.array().cast("array<string>"))),
                          1, need)))
    starts = F.when(F.size("_t") > 0, F.sequence(F.lit(1), F.size("_t"))) \
        .otherwise(F.array().cast("array<int>"))
    grams = F.filter(
        F.transform(starts, lambda i: F.struct(
            (i - 1).alias("pos"),
            F.when(i + (n - 1) <= F.size("_ext"),
                   F.array_join(F.slice("_ext", i, n), sep)).alias("ngram"))),
        lambda s: s["ngram"].isNotNull())
    return ext.select(*group_cols, version_col, row_col, F.inline_outer(grams)) \
        .filter(F.col("ngram").isNotNull())


def ngram_counts(df: DataFrame, tokens_col: str, group_cols: list[str], n: int = 2,
                 boundary: str = "cross", version_col: str = "version",
                 row_col: str = "row_id", block_rows: int = 1 << 16) -> DataFrame:
    """A-12: n-gram counts per group with first appearance."""
    g = stream_ngrams(df, tokens_col, group_cols, n, version_col, row_col, boundary, block_rows)
    return g.groupBy(*group_cols, "ngram").agg(
        F.count(F.lit(1)).alias("count"),
        F.min(stream_key(version_col, row_col, "pos")).alias("first_seen"))


def class_balance(df: DataFrame, label_col: str = "is_sarcastic") -> DataFrame:
    """A-01: relative frequency per label (``value_counts(normalize=True)``)."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("count"))
    total = Window.partitionBy()
    return counts.withColumn("share", F.col("count") / F.sum("count").over(total))


def class_counts(df: DataFrame, label_col: str = "is_sarcastic") -> DataFrame:
    """A-02."""
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("count"))


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    """A-03: exact distinct count (nulls not counted)."""
    return df.agg(F.countDistinct(col).alias(f"n_unique"))


def feature_label_counts(df: DataFrame, features: list[str], label_col: str) -> DataFrame:
    """A-05: counts per (feature, value, label) for several features in one
    pass: the features are unpivoted to long form, then grouped once."""
    long = df.select(label_col, *[F.col(f).cast("bigint").alias(f) for f in features]).unpivot(
        label_col, features, "feature", "value")
    return long.groupBy("feature", "value", label_col).agg(F.count(F.lit(1)).alias("count"))


def percentile_cap(df: DataFrame, value_cols: list[str], p: float = 0.995) -> DataFrame:
    """A-15: ``int(percentile(x, p))`` with linear interpolation.

    Spark's exact ``percentile`` keeps a map of distinct value -> count;
    for word counts the distinct values are bounded by the longest text,
    so the state stays small however many rows there are.
    """
    return df.agg(*[F.floor(F.percentile(F.col(c), F.lit(p))).cast("bigint").alias(f"{c}_cap")
                    for c in value_cols])


def describe(df: DataFrame, numeric_cols: list[str], string_cols: list[str],
             order_col: str) -> DataFrame:
    """A-04: ``describe(include='all')`` as one row per column.

    Numeric: count, mean, std, min, quartiles (exact, interpolated), max.
    String: count, unique, top (most frequent, ties to the earliest
    ``order_col``), freq. Cells that do not apply are null.
    """
    from .ordering import exact_quantiles
    r6 = lambda c: F.round(c, 6)
    parts = []
    if numeric_cols:
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v"))
            for c in numeric_cols])).alias("_s")).select("_s.*")
        stats = long.groupBy("column_name").agg(
            F.count("v").alias("count"), r6(F.avg("v")).alias("mean"),
            r6(F.stddev_samp("v")).alias("std"), r6(F.min("v")).alias("min"),
            r6(F.max("v")).alias("max"))
        qs = exact_quantiles(long, "v", [0.25, 0.5, 0.75], ["column_name"]).groupBy("column_name").agg(
            *[r6(F.max(F.when(F.col("p") == p, F.col("q")))).alias(n)
              for p, n in [(0.25, "q25"), (0.5, "q50"), (0.75, "q75")]])
        parts.append(stats.join(qs, "column_name").select(
            "column_name", "count", F.lit(None).cast("bigint").alias("unique_count"),
            F.lit(None).cast("string").alias("top"), F.lit(None).cast("bigint").alias("freq"),
            "mean", "std", "min", "q25", "q50", "q75", "max"))
    for c in string_cols:
        vc = df.filter(F.col(c).isNotNull()).groupBy(c).agg(
            F.count(F.lit(1)).alias("_c"), F.min(order_col).alias("_fr"))
        parts.append(vc.agg(
            F.sum("_c").cast("bigint").alias("count"), F.count(F.lit(1)).alias("unique_count"),
            F.min_by(F.col(c), F.struct((-F.col("_c")).alias("a"), F.col("_fr").alias("b"))).alias("top"),
            F.max("_c").alias("freq")).select(
            F.lit(c).alias("column_name"), "count", "unique_count", "top", "freq",
            *[F.lit(None).cast("double").alias(n) for n in ["mean", "std", "min", "q25", "q50", "q75", "max"]]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
