"""Runs of repeated words by online dyadic square catching.

Words are appended and never looked at again but through their numbers. For
every power of two B, the last B words form a window; when a block of B/2 words
is complete, a catcher starts there that holds the window of B words from the
block's first word on. Each appended word completes one window per B, and that
suffix is compared with the two catchers in reach: if a catcher's window comes
again p <= B words later, the words between are a square of period p, and a
catcher that has caught one is done. Squares with the same period that overlap
merge into a run, which grows to the left over the words already there and to
the right with every appended word that continues it.

A run of period q and at least 4*q words holds, for the smallest B >= q, a
block start with B + q words of the run behind it, so it is caught. The first
return of a window of B >= p words is at its smallest period, so the periods
caught are smallest ones. Windows are compared by 64-bit hashes, made from the
two halves' hashes; every caught square is then compared word by word, so a
clash of hashes can't make a run, and could hide one with a probability of
about the square of the number of words over 2**64.

The work per word is a few numpy steps for each B up to a fourth of the text,
and the memory a few numbers per word. The operator is local to a row; no
rows meet.

Defined results: a null or empty text has no words and no runs, and collapses
to an empty text. Equal runs can't be, so ties are only between lengths. Very
long texts are read whole. Repeated rows and null ids are rows like others.
Extra columns come through if named in ``carry``; other ones are left out. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts_of
from .wordhash import mix

#: Words appended at a time; bounds the memory of a very long text's windows.
_CHUNK = 1 << 16


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix of two arrays of one length."""
    at, step = 0, 64
    while at < len(a):
        differ = np.flatnonzero(a[at:at + step] != b[at:at + step])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, 2 * step
    return len(a)


class SquareCatchers:
    """Online state of one text: ``append`` words' numbers, then ``runs``."""

    def __init__(self, capacity: int = 64):
        self.words = np.zeros(capacity, np.int64)
        self.n = 0
        # Per level: first window held, hashes of the windows from there on.
        self.windows: list[tuple[int, np.ndarray]] = []
        # Per level: catchers that have caught, among those still in reach.
        self.caught: list[np.ndarray] = []
        self.ended: dict[tuple[int, int], int] = {}
        self.open: dict[tuple[int, int], int] = {}

    def append(self, numbers: np.ndarray) -> None:
        old, self.n = self.n, self.n + len(numbers)
        if self.n > len(self.words):
            grown = np.zeros(max(self.n, 2 * len(self.words)), np.int64)
            grown[:old] = self.words[:old]
            self.words = grown
        self.words[old:self.n] = numbers
        self._advance_open_runs()
        level, size = 0, 1
        while size <= self.n:
            squares = self._advance_level(level, size)
            if squares is not None:
                self._merge(size, *squares)
            level, size = level + 1, 2 * size
        # What later windows, one level up too, can still reach.
        for level, (base, held) in enumerate(self.windows):
            keep = max(base, base + len(held) - (2 << level) - 1)
            self.windows[level] = keep, held[keep - base:].copy()

    def _advance_open_runs(self) -> None:
        """Runs that reached the last word go on as far as the new ones do."""
        words = self.words[:self.n]
        for (period, start), end in list(self.open.items()):
            end += _agreeing(words[end:], words[end - period:self.n - period])
            self._note(period, start, end)

    def _note(self, period: int, start: int, end: int) -> None:
        key = period, start
        if end == self.n:
            self.open[key] = end
        else:
            self.open.pop(key, None)
            self.ended[key] = end

    def _advance_level(self, level: int, size: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Hashes of the windows of ``size`` words that the new words complete,
        compared with the catchers: (start, period) of each new square."""
        if level == len(self.windows):
            self.windows.append((0, np.zeros(0, np.uint64)))
            self.caught.append(np.zeros(0, np.int64))
        base, held = self.windows[level]
        first, last = base + len(held), self.n - size + 1
        if level == 0:
            new = mix(self.words[first:last].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        else:
            below, half = self.windows[level - 1]
            left = half[first - below:last - below]
            right = half[first + size // 2 - below:last + size // 2 - below]
            new = mix(left * np.uint64(0xD6E8FEB86659FD93) + right)
        held = np.concatenate([held, new])
        squares = None
        if level and len(new):
            block, found = size // 2, []
            for back in (0, block):
                # The window at i meets the catchers at the last block start before i and the one before that.
                low = max(first, base + 1, block if back else 1)
                near = ((np.arange(low, last) - 1) & -block) - back
                hit = np.flatnonzero(held[low - base:] == held[near - base])
                if len(hit):
                    near = near[hit]
                    found.append((near, hit + low - near))
            if found:
                start, period = (np.concatenate(c) for c in zip(*found))
                # The first return of each catcher that has not caught yet.
                order = np.lexsort((period, start))
                start, period = start[order], period[order]
                fresh = np.r_[True, start[1:] != start[:-1]] & ~np.isin(start, self.caught[level])
                start, period = start[fresh], period[fresh]
                self.caught[level] = np.concatenate([self.caught[level], start])
                squares = start, period
            self.caught[level] = self.caught[level][self.caught[level] > last - 1 - 2 * size]
        self.windows[level] = base, held
        return squares

    def _merge(self, size: int, start: np.ndarray, period: np.ndarray) -> None:
        """Squares of one level, by start, into runs."""
        head = np.r_[True, (period[1:] != period[:-1]) | (start[1:] - start[:-1] > size // 2)] if len(start) else []
        words = self.words[:self.n]
        for i in np.flatnonzero(head):
            a, p = int(start[i]), int(period[i])
            if any(q == p and s <= a and a + p + size <= e for (q, s), e in self.open.items()):
                continue
            if not np.array_equal(words[a:a + size], words[a + p:a + p + size]):
                continue
            s = a - _agreeing(words[:a][::-1], words[p:p + a][::-1])
            if (p, s) not in self.open and (p, s) not in self.ended:
                e = a + p + size
                e += _agreeing(words[e:], words[e - p:self.n - p])
                self._note(p, s, e)

    def runs(self, least: int = 6, exponent: int = 4) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs so far, by start and period."""
        both = [(s, e - s, p) for held in (self.ended, self.open) for (p, s), e in held.items()]
        return sorted((s, n, p) for s, n, p in both if n >= max(least, exponent * p))


def runs_of(words: list[bytes], least: int = 6, exponent: int = 4) -> list[tuple[int, int, int]]:
    if len(words) < least:
        return []
    numbers = dict(zip(dict.fromkeys(words), range(len(words))))
    catchers = SquareCatchers(len(words))
    for at in range(0, len(words), _CHUNK):
        part = words[at:at + _CHUNK]
        catchers.append(np.fromiter(map(numbers.__getitem__, part), np.int64, len(part)))
    return catchers.runs(least, exponent)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, each run cut to its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    keep = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    return b" ".join([words[i] for i in keep.tolist()])


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
                  least: int = 6, exponent: int = 4) -> DataFrame:
    """``(id, n_words, runs, collapsed)`` for every row: the runs of at least
    ``least`` words and ``exponent`` periods, by start and period, and the text
    without their repetitions. ``exponent`` is 4 at least, else runs would be
    missed."""
    if exponent < 4 or least < 1:
        raise ValueError("runs need an exponent of at least 4 and a length of at least 1")
    carried = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("boolean")
    rows = docs.select(F.col(id_col).alias("_id"), carried.alias("_carried"), F.col(text_col).cast("string").alias("_text"))
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("_id", "_carried")}
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # Batches hold many rows, so their texts are taken in bounded parts.
            sizes = pc.fill_null(pc.binary_length(whole.column("_text")), 0).to_pylist()
            for lo, hi in slices(sizes, 16 << 20):
                batch = whole.slice(lo, hi - lo)
                n_words, found, kept = [], [], []
                for text in texts_of(batch, "_text"):
                    words = text.split()
                    runs = runs_of(words, least, exponent)
                    n_words.append(len(words))
                    found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                    kept.append(collapsed(words, runs).decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), batch.column("_carried"), pa.array(n_words, pa.int64()),
                     pa.array(found, pa.list_(run)), pa.array(kept, pa.string())],
                    ["_id", "_carried", "_n_words", "_runs", "_collapsed"])

    out = rows.mapInArrow(find, f"_id {kinds['_id']}, _carried {kinds['_carried']}, _n_words bigint, "
                                "_runs array<struct<start:bigint,length:bigint,period:bigint>>, _collapsed string")
    return out.select(F.col("_id").alias(id_col), F.col("_n_words").alias("n_words"), F.col("_runs").alias("runs"),
                      F.col("_collapsed").alias("collapsed"), *([F.col("_carried").alias("carried")] if carry else []))

