"""Distribution summaries behind the reference's plots (A-06..A-09).

Every summary is per (feature, label) group. Quantiles are exact
(``exact_quantiles``: range shuffle, no single-task window); the per-group
threshold tables are groups-sized, counted, and broadcast when small. Histogram
bins (<= 50) and the KDE grid (200 points) are bounded per group, so the
density curve is computed from binned counts, never from all pairs of
points.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import small_side
from .ordering import exact_quantiles


def long_values(df: DataFrame, features: list[str], label_col: str, id_col: str = "row_id") -> DataFrame:
    """``(id, label, feature, value)`` for several numeric columns."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"))
                      for f in features])
    return df.select(id_col, label_col, F.explode(pairs).alias("_p")).select(
        id_col, label_col, "_p.feature", "_p.value").filter(F.col("value").isNotNull())


def quartiles(long: DataFrame, group_cols: list[str], bounded_values: bool = False) -> DataFrame:
    """Exact interpolated quartiles per group.

    ``bounded_values=True`` (counts bounded by text length) uses Spark's
    exact ``percentile``: one partially aggregated ``groupBy`` whose state
    is the map of distinct values. Otherwise values are ranked with a range
    shuffle (``exact_quantiles``), exact for any number of distinct values.
    """
    names = [(0.25, "q1"), (0.5, "median"), (0.75, "q3")]
    if bounded_values:
        q = long.groupBy(*group_cols).agg(F.percentile("value", F.array(*[F.lit(p) for p, _ in names])).alias("_q"))
        return q.select(*group_cols, *[F.col("_q")[i].alias(n) for i, (_, n) in enumerate(names)])
    q = exact_quantiles(long, "value", [p for p, _ in names], group_cols)
    return q.groupBy(*group_cols).agg(
        *[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n) for p, n in names])


def box_stats(long: DataFrame, group_cols: list[str], whis: float = 1.5,
              bounded_values: bool = False) -> DataFrame:
    """A-06: quartiles, whiskers (furthest points within ``whis`` IQR of
    the box) and the outlier count per group."""
    q = quartiles(long, group_cols, bounded_values).withColumn("iqr", F.col("q3") - F.col("q1"))
    j = long.join(small_side(q), group_cols)
    lo = F.col("q1") - whis * F.col("iqr")
    hi = F.col("q3") + whis * F.col("iqr")
    return j.groupBy(*group_cols, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(F.col("value") >= lo, F.col("value"))).alias("whisker_low"),
        F.max(F.when(F.col("value") <= hi, F.col("value"))).alias("whisker_high"),
        F.sum(((F.col("value") < lo) | (F.col("value") > hi)).cast("long")).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))


def outliers(long: DataFrame, group_cols: list[str], whis: float = 1.5,
             bounded_values: bool = False) -> DataFrame:
    """A-07: the rows beyond the whiskers."""
    q = quartiles(long, group_cols, bounded_values).withColumn("iqr", F.col("q3") - F.col("q1"))
    j = long.join(small_side(q), group_cols)
    return j.filter((F.col("value") < F.col("q1") - whis * F.col("iqr"))
                    | (F.col("value") > F.col("q3") + whis * F.col("iqr"))).drop("q1", "median", "q3", "iqr")


def histogram(long: DataFrame, group_cols: list[str], max_bins: int = 50) -> DataFrame:
    """A-08: density histogram per group with the Freedman-Diaconis bin
    count (at most ``max_bins``); empty bins are reported with 0."""
    q = quartiles(long, group_cols)
    st = long.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("vmin"),
                                      F.max("value").alias("vmax")).join(q, group_cols)
    h = 2 * (F.col("q3") - F.col("q1")) / F.pow(F.col("n").cast("double"), F.lit(1.0 / 3.0))
    bins = (F.when(F.col("n") < 2, F.lit(1))
            .when(h == 0, F.floor(F.sqrt(F.col("n").cast("double"))))
            .otherwise(F.ceil((F.col("vmax") - F.col("vmin")) / h)))
    st = st.withColumn("bins", F.greatest(F.least(bins, F.lit(max_bins)), F.lit(1)).cast("int"))
    st = st.withColumn("lo", F.when(F.col("vmax") > F.col("vmin"), F.col("vmin")).otherwise(F.col("vmin") - 0.5)) \
        .withColumn("hi", F.when(F.col("vmax") > F.col("vmin"), F.col("vmax")).otherwise(F.col("vmax") + 0.5)) \
        .withColumn("width", (F.col("hi") - F.col("lo")) / F.col("bins"))
    j = long.join(small_side(st.select(*group_cols, "bins", "lo", "width")), group_cols)
    idx = F.least(F.floor((F.col("value") - F.col("lo")) / F.col("width")).cast("int"), F.col("bins") - 1)
    counts = j.groupBy(*group_cols, idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = st.select(*group_cols, "n", "lo", "width", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin"))
    out = grid.join(counts, [*group_cols, "bin"], "left").fillna(0, ["count"])
    return out.select(*group_cols, "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
                      (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
                      F.col("count").cast("bigint").alias("count"),
                      (F.col("count") / (F.col("n") * F.col("width"))).alias("density"))


def kde(long: DataFrame, group_cols: list[str], grid_size: int = 200, cut: float = 3.0) -> DataFrame:
    """A-09: Gaussian kernel density (Scott bandwidth ``std * n^(-1/5)``)
    on ``grid_size`` points spanning ``[min - cut*bw, max + cut*bw]``.

    Values are linearly binned onto the grid first (a bounded aggregate);
    the density at each grid point then sums the kernel over the at most
    ``grid_size`` bins of its group.
    """
    st = long.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("value").alias("sd"),
                                      F.min("value").alias("vmin"), F.max("value").alias("vmax"))
    st = st.withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))) \
        .filter(F.col("bw") > 0) \
        .withColumn("lo", F.col("vmin") - cut * F.col("bw")) \
        .withColumn("delta", (F.col("vmax") + cut * F.col("bw") - F.col("lo")) / (grid_size - 1))
    j = long.join(small_side(st.select(*group_cols, "lo", "delta")), group_cols)
    pos = (F.col("value") - F.col("lo")) / F.col("delta")
    j = j.withColumn("_j", F.floor(pos).cast("int")).withColumn("_t", pos - F.col("_j"))
    parts = j.select(*group_cols, F.explode(F.array(
        F.struct(F.col("_j").alias("j"), (1 - F.col("_t")).alias("c")),
        F.struct((F.col("_j") + 1).alias("j"), F.col("_t").alias("c")))).alias("_b")).select(*group_cols, "_b.*")
    bins = parts.groupBy(*group_cols, "j").agg(F.sum("c").alias("c")) \
        .groupBy(*group_cols).agg(F.sort_array(F.collect_list(F.struct("j", "c"))).alias("bins"))
    g = st.join(bins, group_cols).select(*group_cols, "n", "bw", "lo", "delta", "bins",
                                         F.explode(F.sequence(F.lit(0), F.lit(grid_size - 1))).alias("k"))
    norm = F.col("n") * F.col("bw") * math.sqrt(2 * math.pi)
    dens = F.aggregate("bins", F.lit(0.0), lambda acc, b: acc + b["c"] * F.exp(
        -0.5 * F.pow((F.col("k") - b["j"]) * F.col("delta") / F.col("bw"), 2))) / norm
    return g.select(*group_cols, "k", (F.col("lo") + F.col("k") * F.col("delta")).alias("x"), dens.alias("density"))
