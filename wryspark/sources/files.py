"""File sources and sinks (S-01..S-05).

Explicit schemas everywhere (no inference pass over the data); malformed
JSON lines land in ``_corrupt_record`` instead of failing the job. Sinks
write one file per task, so nothing funnels through the driver.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from ..session import ensure_checkpoint_dir

HEADLINE_SCHEMA = Ty.StructType([
    Ty.StructField("article_link", Ty.StringType()),
    Ty.StructField("headline", Ty.StringType()),
    Ty.StructField("is_sarcastic", Ty.IntegerType()),
    Ty.StructField("_corrupt_record", Ty.StringType()),
])


def read_json_lines(spark: SparkSession, path: str, schema: Ty.StructType = HEADLINE_SCHEMA) -> DataFrame:
    """S-01: JSON lines with a fixed schema, PERMISSIVE mode."""
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """S-02: only ``(text, label)`` - the scan reads two fields."""
    return read_json_lines(spark, path).select(F.col("headline").alias("text"),
                                               F.col("is_sarcastic").alias("label"))


def read_column_keyed(spark: SparkSession, path: str, columns: dict[str, Ty.DataType],
                      key_column: str) -> DataFrame:
    """S-03: one JSON object per file of the form ``{col: {row_key: value}}``.

    Each file is one document and cannot be split, so this is a one-time
    importer: the file is read whole (``wholetext``), parsed with a map
    per column, the ``key_column`` map is exploded and the other columns
    are looked up by row key. Rows come out ordered by numeric key.
    """
    schema = Ty.StructType([Ty.StructField(c, Ty.MapType(Ty.StringType(), t)) for c, t in columns.items()])
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("d"))
    rows = doc.select("d", F.explode(F.col(f"d.{key_column}")).alias("_k", "_v"))
    out = rows.select(F.col("_k").cast("long").alias("row_key"),
                      *[(F.col("_v") if c == key_column else F.element_at(F.col(f"d.{c}"), F.col("_k"))).alias(c)
                        for c in columns])
    return out


def write_json_lines(df: DataFrame, path: str) -> str:
    """S-04: JSON lines, one file per partition."""
    df.write.mode("overwrite").json(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """S-05: CSV with a header and no index; array and struct columns are
    written as JSON text (CSV has no nested types)."""
    nested = (Ty.ArrayType, Ty.StructType, Ty.MapType)
    cols = [F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields]
    df.select(*cols).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: Ty.StructType) -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("multiLine", True).csv(path))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's checkpoint folder (shared storage
    on a cluster)."""
    root = ensure_checkpoint_dir(spark)
    if root is None:
        raise RuntimeError("spark.checkpoint.dir is not set")
    return os.path.join(root, "scratch", f"{name}-{uuid.uuid4().hex}")
