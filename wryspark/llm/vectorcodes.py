"""Vector codes: product quantisation with memoised grid cells.

A vector's components become integers, floor(1024 * x), and the vector is cut
into equal parts. Each part position has a codebook of 256 entries, trained by
rounds of exact integer k-means; a code is the nearest entry's number for each
part.

The nearest entry is found by the part's coarse cell: the grid of boxes
``cell`` wide that a hash of its coordinates names. For a new cell, every
entry's least and greatest distance to any point of the box is summed from
small tables, one per dimension; entries whose least distance exceeds the
smallest greatest one are dominated and can be nearest to nothing in the box.
The others are memoised under the cell's hash, and only they are evaluated
exactly for the parts in it. The coordinates are kept with the hash, so a
clash is seen and the cell worked out anew. The memo is bounded in bytes and
lives as long as a task's codebook.

A round is one pass over the table. Every task sums its parts per entry, so
what is shuffled is at most one row per task and entry, and what reaches the
driver is the codebook itself (parts x 256 entries), which every task gets.

Defined results: a vector that is null, empty, or holds a null or non-finite
component is dropped. The length is that of the vector with the smallest id;
vectors of other lengths have no part to compare with and are dropped too. A
length that the number of parts doesn't divide is filled with zeros at the end.
The first entries are the vectors of the smallest ids, those that repeat an id
by their components, null ids last; with fewer rows than entries there are
fewer entries. Components too large for exact 64-bit distances are reckoned
with as Python integers, those beyond 2**130 as 2**130; an error or a label's
sum too large for a long is given as the largest long. Extra columns are
ignored. Without any usable vector there are no rows and no entries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LONG = (1 << 63) - 1
#: Components up to here have exact squared distances in 64-bit floats (parts of up to 1,024).
_SMALL = 1 << 20
_PIECE = (1 << 60) - 1
#: The largest single-precision number is below this.
_LARGEST = 2.0 ** 130


def quantised(vectors: np.ndarray, parts: int) -> np.ndarray:
    """floor(1024 * x) as whole numbers in floats, (rows, parts, width)."""
    x = np.floor(np.clip(vectors.astype(np.float64), -_LARGEST, _LARGEST) * 1024.0)
    width = -(-x.shape[1] // parts)
    if width * parts != x.shape[1]:
        x = np.pad(x, ((0, 0), (0, width * parts - x.shape[1])))
    return x.reshape(len(x), parts, width)


def integers(x: np.ndarray) -> np.ndarray:
    """The same numbers as Python integers, for those that floats can't square."""
    return np.array([int(v) for v in x.ravel()], dtype=object).reshape(x.shape)


def exhaustive(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) by evaluating all entries, in any integer type."""
    best, entry = None, None
    for e in range(len(book)):
        d = ((x - book[e]) ** 2).sum(1)
        if best is None:
            best, entry = d, np.zeros(len(x), np.int64)
        else:
            closer = (d < best).astype(bool)
            best, entry = np.where(closer, d, best), np.where(closer, e, entry)
    return entry, best


class CellMemo:
    """Nearest entries of one part position's codebook."""

    def __init__(self, book: np.ndarray, cell: int = 32, limit: int = 16 << 20):
        self.book, self.cell, self.limit = book, cell, limit
        self.small = np.abs(book).max(initial=0) <= _SMALL
        # Odd multipliers, the same in every task.
        self.factors = np.random.default_rng(7).integers(1, 1 << 62, book.shape[1], dtype=np.int64) | 1
        self.cells_made = self.parts_seen = self.evaluated = 0
        self._clear()

    def _clear(self) -> None:
        self.row: dict[int, int] = {}
        self.cells = np.zeros((64, self.book.shape[1]), np.int64)
        self.first = np.zeros(65, np.int64)
        self.kept = np.zeros(4096, np.int16)
        self.n = 0

    def _survivors(self, cells: np.ndarray) -> np.ndarray:
        """(cells, entries): which entries no other one dominates in the box."""
        low = np.zeros((len(cells), len(self.book)))
        high = np.zeros_like(low)
        for i in range(cells.shape[1]):
            used, at = np.unique(cells[:, i], return_inverse=True)
            left = used[:, None] * float(self.cell) - self.book[None, :, i]
            right = left + (self.cell - 1)
            # Of the box's points: none nearer than the side beyond which the entry lies, none farther than the farther side.
            low += (np.maximum(np.maximum(left, -right), 0.0) ** 2)[at]
            high += (np.maximum(np.abs(left), np.abs(right)) ** 2)[at]
        return low <= high.min(1, keepdims=True)

    def _learn(self, hashes: np.ndarray, cells: np.ndarray) -> None:
        for lo in range(0, len(cells), 256):
            rows, entries = np.nonzero(self._survivors(cells[lo:lo + 256]))
            m = min(256, len(cells) - lo)
            if self.n + m > len(self.cells):
                size = max(2 * len(self.cells), self.n + m)
                self.cells = np.concatenate([self.cells, np.zeros((size - len(self.cells), self.cells.shape[1]), np.int64)])
                self.first = np.concatenate([self.first, np.zeros(size + 1 - len(self.first), np.int64)])
            end = int(self.first[self.n])
            if end + len(entries) > len(self.kept):
                self.kept = np.concatenate([self.kept, np.zeros(max(len(self.kept), len(entries)), np.int16)])
            self.kept[end:end + len(entries)] = entries
            self.cells[self.n:self.n + m] = cells[lo:lo + m]
            self.first[self.n + 1:self.n + m + 1] = end + np.cumsum(np.bincount(rows, minlength=m))
            self.row.update(zip(hashes[lo:lo + m].tolist(), range(self.n, self.n + m)))
            self.n += m
        self.cells_made += len(cells)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) for parts ``x`` of small whole numbers."""
        out = [np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)]
        for lo in range(0, len(x), 2048):
            entry, d = self._nearest(x[lo:lo + 2048])
            out[0][lo:lo + 2048], out[1][lo:lo + 2048] = entry, d
        return out[0], out[1]

    def _nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.cells.nbytes + self.kept.nbytes + 128 * self.n > self.limit:
            self._clear()
        cells = np.floor_divide(x, self.cell).astype(np.int64)
        hashes = (cells * self.factors).sum(1)
        hashes ^= hashes >> 29
        names, where = np.unique(hashes, return_index=True)
        known = np.fromiter((h in self.row for h in names.tolist()), bool, len(names))
        new = where[~known]
        self._learn(hashes[new], cells[new])
        at = np.fromiter(map(self.row.__getitem__, hashes.tolist()), np.int64, len(x))
        clash = np.flatnonzero((self.cells[at] != cells).any(1))
        count = self.first[at + 1] - self.first[at]
        edge = np.concatenate([[0], np.cumsum(count)])
        part = np.repeat(np.arange(len(x)), count)
        place = np.arange(edge[-1]) - edge[part] + self.first[at[part]]
        entry = self.kept[place].astype(np.int64)
        self.parts_seen += len(x)
        self.evaluated += len(entry)
        d = np.zeros(len(entry))
        for lo in range(0, len(entry), 1 << 16):
            difference = x[part[lo:lo + (1 << 16)]] - self.book[entry[lo:lo + (1 << 16)]]
            d[lo:lo + (1 << 16)] = np.einsum("ij,ij->i", difference, difference)
        best = np.minimum.reduceat(d, edge[:-1])
        # Entries stand in ascending order, so the first at the minimum is the lowest.
        hit = np.flatnonzero(d == best[part])
        first = hit[np.searchsorted(part[hit], np.arange(len(x)))]
        nearest = entry[first]
        if len(clash):
            nearest[clash], best[clash] = exhaustive(x[clash], self.book)
        return nearest, best.astype(np.int64)


class Codebooks:
    """The entries of all part positions: an integer array (parts, entries,
    width), of Python integers where 64 bits don't do."""

    def __init__(self, entries: np.ndarray, cell: int = 32):
        self.entries, self.cell = entries, cell
        small = np.abs(entries).max(initial=0) <= _SMALL
        self.memos = [CellMemo(book.astype(np.float64), cell) for book in entries] if small and entries.size else None

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entries, squared distances), both (rows, parts); distances are
        Python integers if they may not fit 64 bits."""
        rows, parts, _ = x.shape
        large = np.abs(x).max(axis=(1, 2), initial=0) > _SMALL
        if self.memos is None:
            large[:] = True
        entry, d = np.zeros((rows, parts), np.int64), np.zeros((rows, parts), object if large.any() else np.int64)
        for p in range(parts):
            if not large.all():
                entry[~large, p], d[~large, p] = self.memos[p].nearest(x[~large, p])
            if large.any():
                entry[large, p], d[large, p] = exhaustive(integers(x[large, p]), self.entries[p].astype(object))
        return entry, d

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for v in self.entries.ravel()).encode()).hexdigest()


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           label_col: str = "label") -> DataFrame:
    """``(_id, _v, _label)`` of the vectors that get a code."""
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_v"), F.col(label_col).alias("_label"))
    odd = F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.coalesce((F.size("_v") > 0) & ~odd, F.lit(False)))
    first = rows.orderBy(F.asc_nulls_last("_id"), "_v").select(F.size("_v").alias("n")).first()
    return rows.filter(F.size("_v") == (first.n if first else 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column("_v")
    return pc.list_flatten(lists).to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def train(vectors: DataFrame, entries: int = 256, parts: int = 4, rounds: int = 4, cell: int = 32) -> Codebooks:
    """Codebooks of ``usable`` vectors after ``rounds`` of assigning all parts
    and replacing each entry by its parts' rounded-down mean; unused entries
    stay."""
    first = vectors.select("_id", "_v").orderBy(F.asc_nulls_last("_id"), "_v").limit(entries).collect()
    if not first:
        return Codebooks(np.zeros((parts, 0, 0), np.int64), cell)
    start = quantised(np.array([r._v for r in first], np.float64), parts)
    books = Codebooks(_tight(integers(start).transpose(1, 0, 2)), cell)
    for _ in range(rounds):
        books = Codebooks(_moved(vectors, books), cell)
    return books


def _tight(book: np.ndarray) -> np.ndarray:
    """64-bit integers if they do."""
    return book.astype(np.int64) if max(abs(v) for v in book.ravel()) <= _SMALL else book


def _moved(vectors: DataFrame, books: Codebooks) -> np.ndarray:
    parts, n_entries, width = books.entries.shape
    made, cell = books.entries, books.cell

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = Codebooks(made, cell)
        total, count, exact = np.zeros(made.shape, np.int64), np.zeros((parts, n_entries), np.int64), {}
        for batch in batches:
            x = quantised(_matrix(batch), parts)
            entry, _ = here.assign(x)
            large = np.abs(x).max(axis=(1, 2), initial=0) > _SMALL
            for p in range(parts):
                count[p] += np.bincount(entry[:, p], minlength=n_entries)
                for i in range(width):
                    total[p, :, i] += np.bincount(entry[~large, p], x[~large, p, i], n_entries).astype(np.int64)
                for e, v in zip(entry[large, p], integers(x[large, p])):
                    exact[p, int(e)] = exact.get((p, int(e)), 0) + v
        p, e = np.nonzero(count)
        whole = [(total[i, j].astype(object) + exact.get((i, j), 0)).tolist() for i, j in zip(p.tolist(), e.tolist())]
        # Sums travel in pieces of 60 bits, each of which adds up in a decimal.
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]),
             pa.array([[piece for v in row for piece in (v & _PIECE, v >> 60 & _PIECE, v >> 120)] for row in whole],
                      pa.list_(pa.int64()))], ["_p", "_e", "_n", "_s"])

    partial = vectors.select("_v").mapInArrow(sums, "_p int, _e int, _n bigint, _s array<bigint>")
    added = [F.sum(F.col("_s")[i].cast("decimal(38,0)")).alias(f"_s{i}") for i in range(3 * width)]
    new = made.astype(object)
    for r in partial.groupBy("_p", "_e").agg(F.sum("_n").alias("_n"), *added).collect():
        s = [int(r[f"_s{i}"]) for i in range(3 * width)]
        new[r._p, r._e] = [(a + (b << 60) + (c << 120)) // r._n for a, b, c in zip(s[::3], s[1::3], s[2::3])]
    return _tight(new)


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``(_id, _label, _codes, _error)``: entry numbers and the sum of squared
    distances of every one of the ``usable`` vectors."""
    parts, made, cell = len(books.entries), books.entries, books.cell

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = Codebooks(made, cell)
        for batch in batches:
            entry, d = here.assign(quantised(_matrix(batch), parts))
            error = [min(int(v), _LONG) for v in d.sum(1)]
            edge = pa.array(np.arange(0, entry.size + 1, parts, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_label"), pa.ListArray.from_arrays(edge, pa.array(entry.ravel(), pa.int32())),
                 pa.array(error, pa.int64())], ["_id", "_label", "_codes", "_error"])

    kinds = {c: vectors.schema[c].dataType.simpleString() for c in ("_id", "_label")}
    return vectors.mapInArrow(codes, f"_id {kinds['_id']}, _label {kinds['_label']}, _codes array<int>, _error bigint")


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 entries: int = 256, parts: int = 4, rounds: int = 4, cell: int = 32, spread: int = 16,
                 broadcast_rows: int = 100_000) -> tuple[DataFrame, Codebooks]:
    """``(id, codes, error, label_error)`` of every usable vector, and the
    codebooks. ``label_error`` sums the errors of equal labels, nulls together.

    Up to ``broadcast_rows`` labels are broadcast; more are joined by a
    shuffle, each label's rows dealt over ``spread`` groups."""
    rows = usable(vectors, id_col, vector_col, label_col)
    books = train(rows, entries, parts, rounds, cell)
    coded = encode(rows, books).checkpoint()
    whole = (coded.groupBy("_label").agg(F.sum(F.col("_error").cast("decimal(38,0)")).alias("_sum"))
             .select(F.col("_label").alias("_of"), F.least("_sum", F.lit(_LONG).cast("decimal(38,0)")).cast("bigint").alias("_sum")))
    if whole.count() <= broadcast_rows:
        joined = coded.join(F.broadcast(whole), F.col("_label").eqNullSafe(F.col("_of")))
    else:
        dealt = coded.withColumn("_salt", F.pmod(F.xxhash64("_id", "_codes"), F.lit(spread)).cast("int"))
        copies = whole.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
        joined = dealt.join(copies, F.col("_label").eqNullSafe(F.col("_of")) & (F.col("_salt") == F.col("_copy")))
    return joined.select(F.col("_id").alias(id_col), F.col("_codes").alias("codes"), F.col("_error").alias("error"),
                         F.col("_sum").alias("label_error")), books
