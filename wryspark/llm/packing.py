"""Best-fit packing of token sequences with a bounded number of open bins.

Online: pieces come in their partition's order, and each goes to the open bin
with the least free space that still holds it. Open bins are kept by free
space, with one bit per value of free space that some bin has, so the best bin
is the lowest bit at or above the piece's length. When no bin holds the piece
and the fixed number of bins is open, the fullest closes first.

Every partition packs by itself. Bins that a partition leaves far from full
are then packed once more, whole, by the same rule across partitions, which
moves only their numbers.

Defined results: a null text counts as empty and is one piece with the end id;
rows are packed one by one, so repeated rows and null ids come out as often as
they went in; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices
from .tokenise import encoder

#: Above every bin number of a partition.
_STRIDE = 1 << 33


class OpenBins:
    """Bounded-space best fit: ``place(length)`` gives (bin, offset)."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.bits, self.by_free = 0, [[] for _ in range(capacity + 1)]
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        number = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.capacity - free


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be short."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


_PACKED = "_id {}, piece int, start bigint, length bigint, ids binary, _bin bigint, offset bigint"


def pack(documents: DataFrame, tokenizer_path: str, path: str, capacity: int = 2048, end_id: int = 0,
         open_bins: int = 512, id_col: str = "doc_id", text_col: str = "text", refill_below: float = 0.95,
         bins_per_task: int = 50_000, carry: tuple[Column | str, ...] = ("ids",)) -> DataFrame:
    """One row per piece: id, piece, start, length, sequence_id, offset and
    ``carry``, columns over the piece's ``ids`` (little-endian unsigned
    32-bit), made before the pieces are joined with their bins' new places.
    The pieces with their ids are written once, as Parquet, to ``path`` in the
    shared folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bins = encoder(tokenizer_path), OpenBins(capacity, open_bins)
        base, end = TaskContext.get().partitionId() * _STRIDE, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            for at, to in slices(list(map(len, texts)), 4 << 20):
                rows: list[tuple] = []
                for i, ids in enumerate(encode(texts[at:to]), at):
                    ids += end
                    for k, (s, n) in enumerate(pieces_of(len(ids) // 4, capacity)):
                        number, offset = bins.place(n)
                        rows.append((i, k, s, n, ids[4 * s:4 * (s + n)], base + number, offset))
                i, k, s, n, ids, number, offset = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").take(pa.array(i)), pa.array(k, pa.int32()), pa.array(s, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(number, pa.int64()),
                     pa.array(offset, pa.int64())], ["_id", "piece", "start", "length", "ids", "_bin", "offset"])

    rows = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    spark, schema = rows.sparkSession, _PACKED.format(rows.schema["_id"].dataType.simpleString())
    rows.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    pieces = spark.read.schema(schema).parquet(path)
    moved = _refill(pieces, capacity, open_bins, refill_below, bins_per_task)
    carried = [F.col(c) if isinstance(c, str) else c for c in carry]
    rows = pieces.select("_id", "piece", "start", "length", "_bin", "offset", F.struct(*carried).alias("_carried"))
    return (rows.join(moved, "_bin", "left")
            .select(F.col("_id").alias(id_col), "piece", "start", "length", "_carried.*",
                    F.coalesce("_to", "_bin").alias("sequence_id"),
                    (F.col("offset") + F.coalesce("_shift", F.lit(0))).alias("offset")))


def _refill(pieces: DataFrame, capacity: int, open_bins: int, below: float, bins_per_task: int) -> DataFrame:
    """(_bin, _to, _shift): where bins that were left far from full go."""
    left = pieces.groupBy("_bin").agg(F.sum("length").alias("_fill")).filter(F.col("_fill") < below * capacity)
    left = left.checkpoint()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = OpenBins(capacity, open_bins), TaskContext.get().partitionId() * _STRIDE
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("_fill").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_bin"), pa.array([-1 - base - b for b, _ in placed], pa.int64()),
                 pa.array([o for _, o in placed], pa.int64())], ["_bin", "_to", "_shift"])

    # The fullest first within a task: best fit decreasing.
    tasks = left.count() // bins_per_task + 1
    dealt = left.repartition(tasks, F.xxhash64("_bin")).sortWithinPartitions(F.desc("_fill"), "_bin")
    return dealt.mapInArrow(run, "_bin bigint, _to bigint, _shift bigint")
