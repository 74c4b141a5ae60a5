"""Exact duplicates by a content sort, with DataFrame functions only.

Texts are compared without their ASCII white space. The rows are range
partitioned by splitters that Spark samples from the first characters of the
normalised text and its hash, so a splitter has a bounded size however long
the texts are. Inside a partition the external sort puts equal texts next to
each other; a window compares neighbours in full and keeps, of equal ones, the
row with the most code points in the original text, then the smallest id.

A text may belong to a third of all rows. A count by hash, summed before its
shuffle, finds the texts whose copies exceed a bound in rows or bytes; their
rows get a salt as one more sort key and so become several bounded groups,
whose first rows are then compared in full again. The bounds grow with the
data, so at most ``2 * max_hot`` hashes are ever hot, and that is the number
of rows that are broadcast.

Defined results: a null text is an empty one, and texts of white space alone
are equal to it. A null id comes after all others; rows that repeat an id and
a text are copies like any others, and exactly one row of a group is kept.
Very long texts are compared whole. Ids are whole numbers. Extra columns are
left out, or come back in ``carried`` if named in ``carry``, whatever their
names are. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WHITE_SPACE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null as empty."""
    out = F.coalesce(text, F.lit(""))
    for character in WHITE_SPACE:
        out = F.replace(out, F.lit(character), F.lit(""))
    return out


def hot_hashes(keyed: DataFrame, hot_rows: int, hot_bytes: int, max_hot: int) -> DataFrame:
    """``(_hash, _salts)`` of the hashes whose rows must be split."""
    repeated = (keyed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"), F.sum("_bytes").alias("_sum"))
                .filter("_n > 1").checkpoint())
    total = repeated.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), F.coalesce(F.sum("_sum"), F.lit(0)).alias("b")).first()
    rows, size = max(hot_rows, total.n // max_hot), max(hot_bytes, total.b // max_hot)
    salts = F.least("_n", F.greatest(F.ceil(F.col("_n") / rows), F.ceil(F.col("_sum") / size)))
    return repeated.select("_hash", salts.cast("bigint").alias("_salts")).filter("_salts > 1")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
                     hot_rows: int = 1000, hot_bytes: int = 32 << 20, max_hot: int = 100_000,
                     prefix: int = 64) -> DataFrame:
    """``(id, keep_id, group_size, kept, text_sha256)`` for every row.

    ``hot_rows`` and ``hot_bytes`` are what one group may hold before it is
    split, or the ``max_hot``-th part of all repeated rows if that is more."""
    carried = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("boolean")
    keyed = (docs.select(F.col(id_col).cast("bigint").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
                         carried.alias("_carried"))
             .select("_id", "_carried", F.length("_text").alias("_chars"), normalised(F.col("_text")).alias("_norm"))
             .select("*", F.xxhash64("_norm").alias("_hash"), F.octet_length("_norm").cast("bigint").alias("_bytes")))
    hot = hot_hashes(keyed, hot_rows, hot_bytes, max_hot)
    # Any row number will do as long as each row gets one.
    salted = (keyed.join(F.broadcast(hot), "_hash", "left")
              .withColumn("_salt", F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("_salts")), F.lit(0)))
              .withColumn("_prefix", F.substring("_norm", 1, prefix)))
    equal = Window.partitionBy("_prefix", "_hash", "_norm", "_salt")
    best_first = equal.orderBy(F.desc("_chars"), F.asc_nulls_last("_id"))
    ranked = (salted.repartitionByRange("_prefix", "_hash", "_salt")
              .withColumn("_rank", F.row_number().over(best_first))
              .withColumn("_keep", F.first("_id").over(best_first))
              .withColumn("_size", F.count(F.lit(1)).over(equal)))
    split = F.col("_salts").isNotNull()
    # Texts go on only where groups have to be compared once more.
    ranked = ranked.select("_id", "_carried", "_chars", "_rank", "_keep", "_size", "_salt", split.alias("_split"),
                           F.sha2("_norm", 256).alias("_sha"), F.when(split & (F.col("_rank") == 1), F.col("_norm")).alias("_norm")
                           ).checkpoint()
    # The greatest of these is the row with the most code points, then the smallest id.
    order = F.struct("_chars", F.col("_id").isNotNull().alias("_has"), F.bitwise_not("_id").alias("_back"),
                     F.bitwise_not("_salt").alias("_salt"))
    whole = (ranked.filter(F.col("_split") & (F.col("_rank") == 1)).groupBy("_norm")
             .agg(F.max(order).alias("_best"), F.sum("_size").alias("_all"))
             .select(F.sha2("_norm", 256).alias("_sha"), "_all", F.bitwise_not("_best._back").alias("_whole_keep"),
                     F.bitwise_not("_best._salt").alias("_whole_salt")))
    joined = ranked.drop("_norm").join(F.broadcast(whole), "_sha", "left")
    first_of_salt = F.col("_rank") == 1
    return joined.select(
        F.col("_id").alias(id_col), F.when(F.col("_split"), F.col("_whole_keep")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_all", "_size").alias("group_size"),
        F.when(F.col("_split"), first_of_salt & (F.col("_salt") == F.col("_whole_salt"))).otherwise(first_of_salt).alias("kept"),
        F.col("_sha").alias("text_sha256"), *([F.col("_carried").alias("carried")] if carry else []))
