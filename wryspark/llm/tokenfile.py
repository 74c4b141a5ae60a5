"""Token-ID tables: Parquet files with a list column of ids.

The layout is Spark's Parquet writer's, steered by its options: dictionary or
delta encoding of the ids, row groups of a given size, and pages of a given
number of rows, for which the writer stores column and offset indexes. A
reader that needs a few documents, or only their lengths, then touches only
those pages and columns. Rows stand in ascending id order within and across
the files; each file's rows know their place in it, and the places before a
file are summed from the lengths column alone.

Defined results: a null text counts as empty and holds the end id only; null
ids come first; rows that repeat an id stand in text order (null first) and
are all kept; an empty table gives an empty token table; extra columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices
from .tokenise import encoder

_SCHEMA = "_id {}, part int, start_in_part bigint, n_tokens bigint, ids array<int>"


def write_tokens(documents: DataFrame, tokenizer_path: str, path: str, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text", encoding: str = "dictionary",
                 row_group_bytes: int = 32 << 20, page_rows: int = 2000) -> None:
    """Write the token table of ``documents`` to ``path``. ``encoding`` is
    "dictionary" or "delta"."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding!r}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, start = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            for at, to in slices(list(map(len, texts)), 4 << 20):
                ids = [x + end for x in encode(texts[at:to])]
                sizes = np.array([len(x) // 4 for x in ids], np.int64)
                ends = np.cumsum(sizes)
                flat = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(at, to - at), pa.array(np.full(len(ids), part, np.int32)),
                     pa.array(start + ends - sizes), pa.array(sizes),
                     pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), flat)],
                    ["_id", "part", "start_in_part", "n_tokens", "ids"])
                start += int(ends[-1])

    rows = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    spark = rows.sparkSession
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(files, "_id").sortWithinPartitions("_id", "_text")
    schema = _SCHEMA.format(rows.schema["_id"].dataType.simpleString())
    delta = encoding == "delta"
    (ordered.mapInArrow(run, schema).withColumnRenamed("_id", id_col).write
     .option("compression", "zstd")
     .option("parquet.writer.version", "PARQUET_2_0" if delta else "PARQUET_1_0")
     .option("parquet.enable.dictionary", str(not delta).lower())
     .option("parquet.block.size", row_group_bytes)
     .option("parquet.page.row.count.limit", page_rows)
     .parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a token table with ``start``, the number of ids before the
    row in the whole table. That takes one row of three numbers per file,
    which is broadcast: the driver lists these files to plan the scan anyway."""
    rows = spark.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = (rows.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
             .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))))
    return (rows.join(F.broadcast(files), "part").withColumn("start", F.col("start_in_part") + F.col("_before"))
            .drop("_n", "_before"))


def with_crc32(rows: DataFrame, id_col: str = "doc_id", keep: tuple[str, ...] = ("start", "n_tokens")) -> DataFrame:
    """``id_col``, ``keep`` and ``ids_crc32``: the unsigned crc32 of the ids
    as little-endian unsigned 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            at = ids.offsets.to_numpy()
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (id_col, *keep)), pa.array(crc, pa.int64())],
                                             [id_col, *keep, "ids_crc32"])

    rows = rows.select(id_col, *keep, "ids")
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in (id_col, *keep)) + ", ids_crc32 bigint")
