"""Driver tables and their binding to the reference's data model.

The reference works on a labelled headline table in two overlapping
versions. On the driver tables:

* headline table = ``documents JOIN labels USING (doc_id)`` with
  ``row_id = doc_id``, ``headline = text``, ``is_sarcastic = toxic``;
* version 1 / version 2 = the even / odd ``doc_id`` halves of it. Both
  halves are always read whole; together they are the whole table;
* articles = ``pages (url, html)``;
* predictions for the metrics = ``labels`` with ``label = quality``,
  ``prediction = toxic``.

Every reader selects only the columns it needs, so the Parquet scan
prunes the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """S-06: Parquet scan of one driver table, optionally pruned. Scan tasks
    follow the files' row groups and ``spark.sql.files.maxPartitionBytes``."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-04: ``(row_id, headline, is_sarcastic)``; a plain equi-join, the
    planner (AQE) picks broadcast or shuffle from the runtime sizes."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "toxic"])
    return (docs.join(labels, "doc_id")
            .select(F.col("doc_id").alias("row_id"),
                    F.col("text").alias("headline"),
                    F.col("toxic").cast("int").alias("is_sarcastic")))


def versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two dataset versions: even and odd ``row_id`` halves."""
    h = headlines(spark, sf_dir)
    return (h.filter(F.col("row_id") % 2 == 0), h.filter(F.col("row_id") % 2 == 1))


def documents(spark: SparkSession, sf_dir: str, columns=("doc_id", "text")) -> DataFrame:
    return read_table(spark, sf_dir, "documents", list(columns))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_id, label, prediction)`` stand-in for a scored test set."""
    return (read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
            .select(F.col("doc_id").alias("row_id"),
                    F.col("quality").cast("int").alias("label"),
                    F.col("toxic").cast("int").alias("prediction")))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
