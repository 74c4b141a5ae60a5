"""Near-duplicate documents by DartMinHash.

A text is the multiset of its runs of five words (a shorter text is one run),
a vector that has for every run its number of occurrences as weight. Each unit
of a run's weight is a region on which hashing throws darts: a Poisson process
in time, the same in every text that has the region. A text looks only at the
darts up to a time at which its weight leads to enough of them, whatever the
number of its regions, and deals them to the signature's coordinates by hash;
the earliest dart of a coordinate is its value. If a coordinate is still
empty, the text looks further on. Two texts agree in a coordinate with a
probability of exactly their weighted Jaccard similarity.

Texts that agree in all values of some band become candidates, as one star
per bucket; stars that touch form a candidate group. In a group the exact
similarity of all texts is computed, block by block, so a group of any size is
many bounded tasks, and each block pair returns only a spanning forest of its
links. Classes are the components of these links. Texts with the same words
are one text from the start.

Defined results: words are lower-cased (A-Z) and cut at ASCII white space. A
null text or one without words is alone in its class. Ids are whole numbers.
Rows that repeat id and text get the same result; rows that share an id with
different texts are classed by their own text. Rows with a null id are in no
class (null) and kept. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_caches, slices, texts_of
from .components import components
from .wordhash import Words, mix, run_hash, run_sums

_SLICE = 1 << 20
_U = np.uint64


def elements(texts: list[bytes], run_words: int = 5) -> tuple[np.ndarray, np.ndarray, Words, np.ndarray]:
    """Sorted unit regions of all texts, as hashes, and where each text's
    begin; a run's second, third, ... occurrence is a region of its own."""
    words = Words(texts)
    h = words.hashes()
    n = np.diff(words.first)
    count = np.where(n >= run_words, n - run_words + 1, np.minimum(n, 1))
    first = np.r_[0, np.cumsum(count)]
    owner = np.repeat(np.arange(len(texts)), count)
    start = words.first[owner] + np.arange(first[-1]) - first[owner]
    sums = run_sums(h)
    run = run_hash(sums, start, start + np.minimum(run_words, n[owner]))
    order = np.lexsort((run, owner))
    run = run[order]
    again = np.zeros(len(run), bool)
    again[1:] = (run[1:] == run[:-1]) & (owner[1:] == owner[:-1])
    place = np.arange(len(run))
    rank = place - np.maximum.accumulate(np.where(again, 0, place))
    unit = np.where(rank > 0, mix(run + rank.astype(_U) * _U(0x9E3779B97F4A7C15)), run)
    return unit, first, words, sums


def _text_keys(words: Words, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for all the words of each text."""
    other = run_sums(mix(words.hashes() + _U(0x5851F42D4C957F2D)))
    a, b = (run_hash(s, words.first[:-1], words.first[1:]).view(np.int64) for s in (sums, other))
    return a, b


def _waits(state: np.ndarray) -> np.ndarray:
    """Exponential waiting times from hashes."""
    return -np.log(((state >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53)


def signatures(unit: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """(texts, k) dart numbers; texts without regions get zeros."""
    texts = len(first) - 1
    weight = np.diff(first)
    out = np.zeros((texts, k), np.uint64)
    todo = np.flatnonzero(weight)
    darts = k * (np.log(k) + 3)
    until = np.zeros(texts)
    until[todo] = darts / weight[todo]
    while len(todo):
        counts = weight[todo]
        row = np.repeat(np.arange(len(todo)), counts)
        at = np.repeat(first[todo] - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
        state = mix(unit[at] ^ _U(0xA5A5A5A5DEADBEEF))
        time = _waits(state)
        best = np.full(len(todo) * k, np.inf)
        found = np.zeros(len(todo) * k, np.uint64)
        limit = until[todo]
        while True:
            live = time <= limit[row]
            row, state, time = row[live], state[live], time[live]
            if not len(row):
                break
            dart = mix(state ^ _U(0x5DEECE66D1234567))
            slot = row * k + (dart % _U(k)).astype(np.int64)
            np.minimum.at(best, slot, time)
            won = best[slot] == time
            found[slot[won]] = dart[won]
            state = mix(state + _U(0x9E3779B97F4A7C15))
            time = time + _waits(state)
        full = np.isfinite(best).reshape(len(todo), k).all(1)
        out[todo[full]] = found.reshape(len(todo), k)[full]
        todo = todo[~full]
        until[todo] *= 2
    return out


def _bands(sig: np.ndarray, bands: int) -> np.ndarray:
    rows = sig.reshape(len(sig), bands, -1)
    h = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), rows.shape[:2]).copy()
    for r in range(rows.shape[2]):
        h = mix(h * _U(0xD6E8FEB86659FD93) + rows[:, :, r])
    return h


def _links(sets: list[np.ndarray], split: int, threshold: float) -> np.ndarray:
    """Local class (smallest index) of each set: links are pairs of exact
    similarity; with ``split`` only pairs across it count."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.where(seen > 1, np.cumsum(seen > 1) - 1, -1)[column]
    use = number >= 0
    owner, number = owner[use], number[use]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    common = np.zeros((len(sets), len(sets)))
    width = 4096
    for lo in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        a, b = np.searchsorted(number, (lo, lo + width))
        part = np.zeros((len(sets), width), np.float32)
        part[owner[a:b], number[a:b] - lo] = 1
        common += part @ part.T
    linked = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-9
    if split:
        linked[:split, :split] = linked[split:, split:] = False
    np.fill_diagonal(linked, True)
    label = np.arange(len(sets))
    while True:
        new = np.where(linked, label[None, :], len(sets)).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _classes(docs: DataFrame, threshold: float, run_words: int, bands: int, rows: int, block_texts: int,
             block_words: int) -> DataFrame:
    """(_id, _hash, _class) of rows (_id, _text), one each."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            texts = texts_of(batch, "_text")
            for at, to in slices(list(map(len, texts)), _SLICE):
                unit, first, words, sums = elements(texts[at:to], run_words)
                h = _bands(signatures(unit, first, bands * rows), bands).view(np.int64)
                a, b = _text_keys(words, sums)
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_hash"), pa.array(a), pa.array(b), pa.array(np.diff(first)),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, h.size + 1, bands, dtype=np.int32)), pa.array(h.ravel()))],
                    ["_id", "_hash", "_a", "_b", "_n", "_bands"])

    # Read by four branches.
    signed = docs.withColumn("_hash", F.xxhash64("_text")).mapInArrow(
        sign, "_id bigint, _hash bigint, _a bigint, _b bigint, _n bigint, _bands array<bigint>").checkpoint()
    texts = signed.filter("_id is not null and _n > 0").groupBy("_a", "_b").agg(
        F.min("_id").alias("_rep"), F.first("_n").alias("_n"), F.first("_bands").alias("_bands"))
    buckets = texts.select("_rep", F.explode("_bands").alias("_band"))
    stars = buckets.groupBy("_band").agg(F.min("_rep").alias("_centre"), F.count(F.lit(1)).alias("_m")).filter("_m > 1")
    touching = buckets.join(stars.select("_band", "_centre"), "_band").select("_centre", "_rep")
    groups = components(touching, "_centre", "_rep")
    members = texts.drop("_bands").join(groups, F.col("_rep") == F.col("node")).select(
        "_rep", "_a", "_b", "_n", F.col("component").alias("_group")).checkpoint()
    verified = _verify(docs, members, run_words, threshold, block_texts, block_words)
    classes = components(verified, "_x", "_y")
    named = (texts.select("_a", "_b", "_rep").join(classes, F.col("_rep") == F.col("node"), "left")
             .select("_a", "_b", F.coalesce("component", "_rep").alias("_class")))
    own = F.when(F.col("_n") > 0, F.when(F.col("_id").isNotNull(), F.col("_class"))).otherwise(F.col("_id"))
    return signed.drop("_bands").join(named, ["_a", "_b"], "left").select("_id", "_hash", own.alias("_class"))


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
                    run_words: int = 5, bands: int = 28, rows: int = 5, block_texts: int = 256,
                    block_words: int = 1 << 19) -> DataFrame:
    """``(id, class_id, kept)`` for every row: the smallest id of the row's
    class, and whether it is the row's own. With 28 bands of 5 values a pair
    at a similarity of exactly 0.8 is missed with a probability of 1.5e-5."""
    docs = documents.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
    found = _classes(docs, threshold, run_words, bands, rows, block_texts, block_words)
    return found.select(F.col("_id").alias(id_col), F.col("_class").alias("class_id"),
                        (F.col("_id").isNull() | (F.col("_id") == F.col("_class"))).alias("kept"))


def without_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
                       run_words: int = 5, bands: int = 28, rows: int = 5, block_texts: int = 256,
                       block_words: int = 1 << 19) -> DataFrame:
    """The rows, with all their columns, that stand for their class; of rows
    that repeat id and text, one."""
    docs = documents.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
    gone = (_classes(docs, threshold, run_words, bands, rows, block_texts, block_words)
            .filter("_id <> _class").select("_id", "_hash").distinct())
    whole = documents.select(F.col(id_col).cast("bigint").alias("_id"), F.xxhash64(text_col).alias("_hash"),
                             F.struct(*documents.columns).alias("_doc"))
    one = (whole.filter("_id is not null").join(gone, ["_id", "_hash"], "left_anti")
           .dropDuplicates(["_id", "_hash"]).select("_doc.*"))
    return one.unionByName(documents.filter(F.col(id_col).isNull()))


def _verify(docs: DataFrame, members: DataFrame, run_words: int, threshold: float, block_texts: int,
            block_words: int) -> DataFrame:
    """Links (_x, _y), a spanning forest for each pair of blocks."""
    sizes = members.groupBy("_group").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / block_texts), F.ceil(F.sum("_n") / block_words)).cast("int").alias("_blocks"))
    placed = members.join(sizes, "_group").select(
        "_rep", "_a", "_b", "_group", "_blocks", F.pmod(F.xxhash64("_rep"), F.col("_blocks")).cast("int").alias("_block"))

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            texts = texts_of(batch, "_text")
            for at, to in slices(list(map(len, texts)), _SLICE):
                unit, first, words, sums = elements(texts[at:to], run_words)
                part = batch.slice(at, to - at)
                # Another text of the same id is not the one that stands for its class.
                a, b = _text_keys(words, sums)
                own = np.flatnonzero((a == part.column("_a").to_numpy()) & (b == part.column("_b").to_numpy()))
                sets = [unit[first[i]:first[i + 1]].tobytes() for i in own]
                part = part.take(pa.array(own))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("_rep", "_group", "_blocks", "_block")), pa.array(sets, pa.binary())],
                    ["_rep", "_group", "_blocks", "_block", "_set"])

    sets = (docs.join(placed, F.col("_id") == F.col("_rep"))
            .select("_rep", "_a", "_b", "_group", "_blocks", "_block", "_text")
            .mapInArrow(regions, "_rep bigint, _group bigint, _blocks int, _block int, _set binary"))
    blocks = sets.groupBy("_group", "_block").agg(
        F.first("_blocks").alias("_blocks"), F.collect_list(F.struct("_rep", "_set")).alias("_members"))
    pairs = (blocks.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
             .groupBy("_group", F.least("_block", "_other").alias("_i"), F.greatest("_block", "_other").alias("_j"))
             .agg(F.collect_list("_members").alias("_sides")))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = [], []
            for k in range(batch.num_rows):
                sides = batch.column("_sides")[k].as_py()
                ids = [m["_rep"] for side in sides for m in side]
                if len(ids) < 2:
                    continue
                held = [np.frombuffer(m["_set"], np.uint64) for side in sides for m in side]
                label = _links(held, len(sides[0]) if len(sides) > 1 else 0, threshold)
                for i, p in enumerate(label):
                    if p != i:
                        x.append(ids[p])
                        y.append(ids[i])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["_x", "_y"])

    return pairs.select("_sides").mapInArrow(link, "_x bigint, _y bigint")
