"""Shared pieces: table access, scratch space in the shared folder, keys."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table of the folder through Spark's reader, so any store that Spark
    opens will do; only the named columns are read."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder of ``spark.checkpoint.dir``, which the
    driver and all executors see."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo ``n``; -1 for null."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % n, F.lit(-1))


#: What a worker process keeps between tasks of one operator: functions that let go of it.
CACHES: list[Callable[[], None]] = []


def drop_caches() -> None:
    """For tasks that need none of the caches: a worker that ran another
    operator before gives its memory back."""
    for clear in CACHES:
        clear()
    pa.default_memory_pool().release_unused()


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty, without going through
    Python strings."""
    values = batch.column(column)
    if not pa.types.is_binary(values.type):
        values = values.cast(pa.binary())
    return [v or b"" for v in values.to_pylist()]


def slices(sizes: list[int], limit: int):
    """Index ranges of consecutive items whose sizes add up to at most
    ``limit``; an item larger than that is alone in its range."""
    at, total = 0, 0
    for i, size in enumerate(sizes):
        if i > at and total + size > limit:
            yield at, i
            at, total = i, 0
        total += size
    if at < len(sizes):
        yield at, len(sizes)
