"""Order-dependent building blocks without a single-task window.

* ``stream_key``: one sortable DECIMAL(38,0) for (version, row, position),
  so "first appearance" is a plain ``min`` that keeps hash aggregation
  (a struct-valued ``min`` would force a sort-based aggregate).
* ``hashed_index``: exact 0-based row numbers in the order of a hex hash,
  from buckets that are the hash's first digits.
* ``dense_index``: the same for any order, from a range shuffle whose result
  is written once. Both end in a prefix sum over a small count table - never
  ``row_number()`` over one task.
* ``block_of``: the block of an ordered row, used to split a long ordered
  group into bounded windows plus a carry between blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_DEC = "decimal(38,0)"
# Digits of the encoding: 9 for the version, 19 for the row id (any bigint),
# 10 for the position (any array's). A larger value raises an error.
_ROW_SCALE = 10 ** 10
_VERSION_SCALE = 10 ** 29


def stream_key(version, row_id, pos=None) -> Column:
    """(version, row_id, pos) as one DECIMAL(38,0) with the same order."""
    def col(c):
        return F.col(c) if isinstance(c, str) else c
    key = (col(version).cast(_DEC) * F.lit(str(_VERSION_SCALE)).cast(_DEC)
           + col(row_id).cast(_DEC) * F.lit(str(_ROW_SCALE)).cast(_DEC))
    if pos is not None:
        key = key + col(pos).cast(_DEC)
    return key.cast(_DEC)


def block_of(row_id, block_rows: int) -> Column:
    c = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.floor(c / F.lit(block_rows)).cast("bigint")


def hashed_index(df: DataFrame, hash_col: str, tie_cols: list[str], group_cols: list[str] = (),
                 name: str = "idx", total: str | None = None, digits: int = 5) -> DataFrame:
    """Append ``name``: 0-based position of each row in the order of
    ``hash_col`` (a hex digest) and ``tie_cols``, restarting per
    ``group_cols``; with ``total`` also the group's number of rows.

    A row's bucket is the first ``digits`` digits of its hash, so it is a pure
    function of the row: whatever other columns the frame has and however
    often it is computed, the bucket counts and the places inside the buckets
    fit together. A window holds one bucket, 1/16**digits of a group: some
    10,000 rows of 10 billion. The prefix sum over the buckets is taken in two
    steps, so that none of its windows has more than 16**3 rows either.
    """
    group_cols = list(group_cols)
    groups = [f"_g{i}" for i in range(len(group_cols))]
    rows = df.withColumn("_bucket", F.substring(hash_col, 1, digits))
    inside = Window.partitionBy(*group_cols, "_bucket").orderBy(hash_col, *tie_cols)
    counts = rows.groupBy(*[F.col(c).alias(g) for c, g in zip(group_cols, groups)], F.col("_bucket").alias("_b")) \
        .agg(F.count(F.lit(1)).alias("_n")).withColumn("_top", F.substring("_b", 1, max(digits - 3, 0)))
    tops = counts.groupBy(*groups, "_top").agg(F.sum("_n").alias("_sum"))
    earlier = Window.partitionBy(*groups).orderBy("_top").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(*[F.col(g).alias(f"{g}t") for g in groups], F.col("_top").alias("_t"),
                       F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"),
                       F.sum("_sum").over(Window.partitionBy(*groups)).alias("_total"))
    before = Window.partitionBy(*groups, "_top").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    of_top, of_bucket = F.col("_top") == F.col("_t"), F.col("_bucket") == F.col("_b")
    for c, g in zip(group_cols, groups):
        of_top = of_top & F.col(g).eqNullSafe(F.col(f"{g}t"))
        of_bucket = of_bucket & F.col(c).eqNullSafe(F.col(g))
    counts = counts.join(tops, of_top).select(*groups, "_b", "_total", (F.col("_base") + F.col("_before")).alias("_off"))
    out = rows.withColumn("_place", F.row_number().over(inside) - 1).join(counts, of_bucket)
    return out.select(*df.columns, (F.col("_off") + F.col("_place")).cast("bigint").alias(name),
                      *([F.col("_total").cast("bigint").alias(total)] if total else []))


def dense_index(df: DataFrame, order_cols: list[str], group_cols: list[str] = (),
                name: str = "idx", num_partitions: int | None = None) -> DataFrame:
    """Append ``name``: 0-based position of each row in ``order_cols`` order,
    restarting per ``group_cols``. ``order_cols`` must make rows unique.

    1. range-partition on (group, order) and sort inside partitions: every
       task holds one contiguous slice;
    2. ``monotonically_increasing_id`` then encodes (partition, position in
       partition) without another shuffle;
    3. the numbered slices are written once (checkpoint): a range shuffle
       samples its own boundaries each time it is planned, so two readers
       that prune different columns would see different slices;
    4. per (partition, group) counts form a table of at most
       partitions + groups rows; a prefix sum over it gives each slice's
       offset, joined back (AQE broadcasts it when it is small).
    """
    group_cols = list(group_cols)
    keys = group_cols + list(order_cols)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                         .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_lpos", F.col("_mid") - F.shiftleft(F.col("_pid"), 33))
    stats = ranged.groupBy("_pid", *group_cols).agg(
        F.min("_lpos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    stats = stats.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)],
                         F.col("_pid").alias("_p"), "_first", "_off")
    same = F.col("_pid") == F.col("_p")
    for i, c in enumerate(group_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    out = ranged.join(stats, same)
    return out.select(*df.columns, (F.col("_off") + F.col("_lpos") - F.col("_first")).cast("bigint").alias(name))


def exact_quantiles(df: DataFrame, value_col: str, probs: list[float],
                    group_cols: list[str] = (), num_partitions: int | None = None) -> DataFrame:
    """Linear-interpolation quantiles per group (numpy default, DuckDB
    ``quantile_cont``), exact for any value type and any number of
    distinct values.

    Rows are first summed to ``(value, count)``, partially before the shuffle,
    so a value that most rows hold is one row. The distinct values are range
    partitioned and written once; a prefix sum over the slices' totals says
    which slice holds an order statistic, and only those slices are numbered.
    Output: group columns, ``p``, ``q``.
    """
    keys = [f"_k{i}" for i in range(max(1, len(group_cols)))]
    named = [F.col(c).alias(k) for c, k in zip(group_cols, keys)] or [F.lit(0).alias(keys[0])]
    values = (df.select(*named, F.col(value_col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
              .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")))
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(values.repartitionByRange(n, *keys, "_v").withColumn("_pid", F.spark_partition_id()))
    # As many rows as slices and groups.
    slices = ranged.groupBy(*keys, "_pid").agg(F.sum("_c").alias("_s"))
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(*keys, "_pid", "_s", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_off"),
                           F.sum("_s").over(Window.partitionBy(*keys)).alias("_n"))
    place = slices.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs]))) \
        .withColumn("_h", (F.col("_n") - 1) * F.col("p")).withColumn("_lo", F.floor("_h").cast("bigint")) \
        .withColumn("_frac", F.col("_h") - F.col("_lo")) \
        .withColumn("_idx", F.explode(F.array_distinct(F.array("_lo", F.ceil("_h").cast("bigint"))))) \
        .filter((F.col("_idx") >= F.col("_off")) & (F.col("_idx") < F.col("_off") + F.col("_s")))
    wanted = place.groupBy(*keys, "_pid", "_off").agg(F.collect_list(F.struct("p", "_idx", "_lo", "_frac")).alias("_w"))
    running = Window.partitionBy(*keys, "_pid").orderBy("_v")
    near = ranged.join(wanted, [*keys, "_pid"]).withColumn("_end", F.col("_off") + F.sum("_c").over(running))
    hit = near.withColumn("_w", F.explode(F.filter(
        "_w", lambda w: (w["_idx"] < F.col("_end")) & (w["_idx"] >= F.col("_end") - F.col("_c")))))
    both = hit.groupBy(*keys, F.col("_w.p").alias("p")).agg(
        F.max(F.when(F.col("_w._idx") == F.col("_w._lo"), F.col("_v"))).alias("_vlo"), F.max("_v").alias("_vhi"),
        F.first("_w._frac").alias("_frac"))
    return both.select(*[F.col(k).alias(c) for c, k in zip(group_cols, keys)], "p",
                       (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")).alias("q"))
