"""Quality classifier by compression.

Two zstandard dictionaries are trained, one from texts labelled good and one
from texts labelled bad. A text compresses better with the dictionary of its
own kind: it is compressed with both, in pieces of a few hundred bytes so that
a long text's own history doesn't take the dictionaries' place, and the
difference of the two sizes divided by the smaller one is the only evidence.
An isotonic curve through labelled texts that the dictionaries have not seen
turns it into a calibrated score.

Defined results: a null text counts as empty, and an empty text gets a score
like any other (its difference is 0). Very long texts are compressed whole,
piece by piece. Equal texts get equal scores, and rows that repeat an id are
scored like any others. Labels other than 0 and 1, null labels and null ids
are not learnt from; an id labelled twice with different values counts for
both. If a class has no labelled text to learn from, or the tables are empty,
every score is 0.5. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_caches, texts_of


@dataclass
class CompressionModel:
    good: bytes
    bad: bytes
    differences: list[float]  # the curve's knots, ascending
    scores: list[float]
    piece: int
    level: int


def _cut(text: bytes, size: int) -> list[bytes]:
    return [text[i:i + size] for i in range(0, len(text), size)]


def differences(texts: list[bytes], good: bytes, bad: bytes, piece: int, level: int) -> np.ndarray:
    """(size with the bad dictionary - size with the good one) / the smaller
    one, for each text; 0 for an empty one."""
    packers = [zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False,
                                        write_checksum=False, write_dict_id=False) for d in (good, bad)]
    out = np.zeros(len(texts))
    for i, text in enumerate(texts):
        pieces = _cut(text, piece)
        if pieces:
            g, b = (sum([len(p.compress(x)) for x in pieces]) for p in packers)
            out[i] = (b - g) / min(b, g)
    return out


def _train_dictionary(texts: list[bytes], size: int, level: int, sample: int = 1000, segment: int = 64) -> bytes:
    """A dictionary of whole texts, given to the trainer in samples of
    ``sample`` bytes; it picks segments of up to ``segment`` bytes."""
    samples = [s for t in texts for s in _cut(t, sample)]
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(size, max(1024, total // 8)), samples, k=segment, d=8,
                                          level=level).as_bytes()
    except zstandard.ZstdError:  # too few or too small texts to train on
        return b"".join(texts)[-size:]


def isotonic(x: np.ndarray, y: np.ndarray, least: int = 10, slope: float = 0.1) -> tuple[list[float], list[float]]:
    """Knots of the rising step curve nearest to ``y`` in squares. A step's
    height is drawn to the middle as if one more good and one more bad text
    stood on it; a step of fewer than ``least`` rows goes into the one after it
    (the last into the one before). A place between two steps belongs to the
    upper one: in doubt a text is good. Along a step the curve rises by
    ``slope`` of the way from and to its neighbours."""
    def joined(a: list[float], b: list[float]) -> list[float]:
        return [a[0], b[1], a[2] + b[2], a[3] + b[3]]

    order = np.lexsort((y, x))
    steps: list[list[float]] = []  # first place, last place, labels' sum, rows
    for place, label in zip(x[order].tolist(), y[order].tolist()):
        step = [place, place, label, 1]
        if steps and steps[-1][1] == place:  # equal places are on one step from the start
            step = joined(steps.pop(), step)
        while steps and steps[-1][2] * step[3] >= step[2] * steps[-1][3]:
            step = joined(steps.pop(), step)
        steps.append(step)
    whole: list[list[float]] = []
    for step in steps:
        whole.append(joined(whole.pop(), step) if whole and whole[-1][3] < least else step)
    if len(whole) > 1 and whole[-1][3] < least:
        last = whole.pop()
        whole.append(joined(whole.pop(), last))
    height = np.maximum.accumulate([(s + 1) / (n + 2) for _, _, s, n in whole])
    around = np.r_[0.0, height, 1.0]
    low = height - slope * (height - around[:-2])
    high = height + slope * (around[2:] - height)
    starts = [whole[0][0], *(np.nextafter(b, np.inf) for _, b, _, _ in whole[:-1])]
    return [float(p) for a, (_, b, _, _) in zip(starts, whole) for p in (a, b)], np.c_[low, high].ravel().tolist()


def _chosen(rows: list, budget: int) -> list:
    """Rows in their order as far as their sizes fit; one that doesn't fit is
    passed over, never cut."""
    out, left = [], budget
    for r in rows:
        if r["_size"] <= left:
            out.append(r)
            left -= r["_size"]
    return out


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", rows_per_class: int = 6000, rows_per_id: int = 4, bytes_per_class: int = 16 << 20,
        dictionary_bytes: int = 112 * 1024, piece: int = 200, level: int = 3) -> CompressionModel:
    """Fit on a bounded sample of labelled rows: of each class the
    ``rows_per_class`` ids that are smallest by hash, and of the rows of an id
    (ids may repeat) ``rows_per_id`` different texts by hash. Another hash
    deals the ids into two halves: one half's whole texts make the dictionary,
    as many as fit ``bytes_per_class``; the other half's differences make the
    curve. Only the former's texts and the latter's numbers reach the driver."""
    ids = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).filter(
        F.col("_id").isNotNull() & F.col("_y").isin(0, 1))
    order = F.xxhash64(F.lit(9), F.col("_id"))
    picked = None
    for y in (0, 1):
        one = (ids.filter(F.col("_y") == y).select("_id", "_y").distinct()
               .orderBy(order, "_id").limit(rows_per_class))
        picked = one if picked is None else picked.unionByName(one)
    # At most 2 x rows_per_class rows of two numbers: a proven bound.
    text = F.encode(F.coalesce(text_col, F.lit("")), "UTF-8")
    found = (documents.select(F.col(id_col).alias("_id"), text.alias("_text")).join(F.broadcast(picked), "_id")
             .withColumn("_key", F.xxhash64("_text")))
    different = Window.partitionBy("_id", "_y").orderBy("_key")
    # Both steps shrink inside each task first, so an id that very many rows repeat stays small.
    sample = (found.dropDuplicates(["_id", "_y", "_key"])
              .withColumn("_rank", F.row_number().over(different)).filter(F.col("_rank") <= rows_per_id)
              .select("_id", "_y", "_key", "_text", F.octet_length("_text").cast("bigint").alias("_size"),
                      (F.pmod(F.xxhash64(F.lit(10), F.col("_id")), F.lit(2)) == 1).alias("_held")).checkpoint())
    first = sample.filter("not _held and _size > 0")
    sizes = first.select("_id", "_y", "_key", "_size", order.alias("_order")).collect()
    sizes.sort(key=lambda r: (r["_order"], r["_key"]))
    chosen = {y: _chosen([r for r in sizes if r["_y"] == y], bytes_per_class) for y in (0, 1)}
    flat = CompressionModel(b"", b"", [0.0], [0.5], piece, level)
    if not chosen[0] or not chosen[1]:
        return flat
    keys = documents.sparkSession.createDataFrame([(r["_id"], r["_y"], r["_key"]) for y in (0, 1) for r in chosen[y]],
                                                  sample.select("_id", "_y", "_key").schema)
    texts = {(r["_id"], r["_y"], r["_key"]): bytes(r["_text"]) for r in
             first.join(F.broadcast(keys), ["_id", "_y", "_key"], "left_semi").select("_id", "_y", "_key", "_text").collect()}
    good, bad = (_train_dictionary([texts[r["_id"], y, r["_key"]] for r in chosen[y]], dictionary_bytes, level) for y in (1, 0))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            x = differences(texts_of(batch, "_text"), good, bad, piece, level)
            yield pa.RecordBatch.from_arrays([batch.column("_y"), pa.array(x)], ["_y", "_x"])

    seen = sample.filter("_held").select("_y", "_text").mapInArrow(measure, "_y int, _x double").collect()
    y = np.array([r["_y"] for r in seen], float)
    if not 0 < y.sum() < len(y):
        return flat
    return CompressionModel(good, bad, *isotonic(np.array([r["_x"] for r in seen]), y), piece, level)


def _probabilities(texts: list[bytes], model: CompressionModel) -> np.ndarray:
    if not model.good:
        return np.full(len(texts), 0.5)
    x = differences(texts, model.good, model.bad, model.piece, model.level)
    return np.interp(x, model.differences, model.scores)


def score(documents: DataFrame, model: CompressionModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score)`` for every row, over the whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            p = _probabilities(texts_of(batch, "_text"), model)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(p)], ["_id", "score"])

    rows = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {id_type}, score double").withColumnRenamed("_id", id_col)


def accepted(documents: DataFrame, model: CompressionModel, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose score is at least ``least``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            yield batch.filter(pa.array(_probabilities(texts_of(batch, text_col), model) >= least))

    return documents.mapInArrow(run, documents.schema)
