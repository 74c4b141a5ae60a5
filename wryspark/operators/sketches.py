"""A-03 / U-02 by mergeable sketches.

A theta sketch of a version's texts is a few kilobytes whatever the rows. It is
stored once; distinct counts of the version, of any union and of any
intersection then come from the stored sketches, and a later version is merged
without reading the earlier texts again. Up to ``2**lg_size`` different texts
the counts are exact; beyond that the relative error of a count is about
``1 / sqrt(2**lg_size)`` (one standard deviation), that of an intersection the
same share of the union.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def store_sketches(rows: DataFrame, version_col: str, text_col: str, path: str, lg_size: int = 16) -> str:
    """One sketch per version of ``rows``, appended to the table at ``path``;
    null texts are not counted. A version may be stored in several pieces."""
    sketches = rows.filter(F.col(text_col).isNotNull()).groupBy(F.col(version_col).cast("string").alias("version")) \
        .agg(F.theta_sketch_agg(text_col, lg_size).alias("sketch"))
    sketches.write.mode("append").parquet(path)
    return path


def stored_distinct(spark: SparkSession, path: str, versions: list[str], lg_size: int = 16) -> DataFrame:
    """``(kind, versions, n)`` from stored sketches: the distinct texts of each
    version, of all together, and of what each two have in common."""
    held = spark.read.parquet(path).filter(F.col("version").isin(versions)).groupBy("version") \
        .agg(F.theta_union_agg("sketch", lg_size).alias("sketch"))
    # One column a version, one row in all.
    wide = held.agg(*[F.max(F.when(F.col("version") == v, F.col("sketch"))).alias(f"_s{i}") for i, v in enumerate(versions)],
                    F.theta_union_agg("sketch", lg_size).alias("_all"))

    def row(kind: str, names: str, sketch) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(names).alias("versions"),
                        F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0)).cast("bigint").alias("n"))

    rows = [row("distinct", v, F.col(f"_s{i}")) for i, v in enumerate(versions)] + [row("union", "+".join(versions), F.col("_all"))]
    rows += [row("common", f"{versions[a]}&{versions[b]}", F.theta_intersection(F.col(f"_s{a}"), F.col(f"_s{b}")))
             for a, b in combinations(range(len(versions)), 2)]
    return wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
