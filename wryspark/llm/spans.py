"""Substring dedup by sliding sentence spans.

A text is cut into units: sentences (ended by . ! or ? before white space, or
by a line break), of which those over ``unit_words`` words are cut again: with
``by_words`` before the word of every ``unit_words`` consecutive ones whose
hash, taken together with the next word's, is smallest (the last of equal
ones), else every ``unit_words`` words. From every unit a span starts: the shortest run of at
least ``min_units`` consecutive units with at least ``min_words`` words. All
spans of all texts are hashed (128 bits over their lower-cased words) and
joined globally. A span's first occurrence is the one in the smallest
document, at the smallest place; units covered by any other occurrence are
removed, together with the white space after them.

With ``by_words`` the cuts depend on nothing but nearby words and no unit has
more than ``unit_words``, so two copies of a passage, wherever they stand in
their sentences and with or without punctuation, fall in step within
``unit_words`` words of its start and stay so until as many plus one before its
end. With the usual 12, 3 and 20 any passage of 49 words is hit. Without it a
passage is only hit if its copies stand on the same unit boundaries. What
repeats inside a text is found there: a text sends each different span once,
with its other places, so a text that repeats itself weighs no more than any
other in the join.

Documents are told apart by their id (null counts as the smallest) and, if ids
repeat, by a hash of the text. Rows that repeat both are one document and all
get its result. A null text stays null and has no units; a text without a
whole span keeps everything; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from .common import drop_caches, slices, texts_of
from .wordhash import Words, mix, run_hash, run_sums

_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True
_SLICE = 2 << 20
#: Positions take the low half of an occurrence's number, the text's tag the high one.
_POSITIONS = 1 << 32
_PAIR = np.uint64(0xD6E8FEB86659FD93)


def _smallest(words: Words, new: np.ndarray, place: np.ndarray, size: np.ndarray, unit_words: int) -> np.ndarray:
    """In sentences over ``unit_words`` words, the words with the smallest hash
    of a pair in any window of that many words."""
    h = words.hashes()
    follow = np.r_[h[1:], np.uint64(0)]
    follow[np.r_[new[1:], True]] = 0
    pair = mix(h * _PAIR + follow)
    window = np.flatnonzero((size > unit_words) & (size - place >= unit_words))
    at, least = window.copy(), pair[window]
    for k in range(1, unit_words):
        value = pair[window + k]
        lower = value <= least
        least[lower], at[lower] = value[lower], window[lower] + k
    return at


def _units(words: Words, unit_words: int, by_words: bool) -> tuple[np.ndarray, np.ndarray]:
    """First word of each unit, and for each text its first unit."""
    n = len(words.start)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(words.first), np.int64)
    breaks = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum(words.data == 10, out=breaks[1:])
    new = np.ones(n, bool)
    # The line break that Words puts between texts starts a sentence as well.
    new[1:] = _STOP[words.data[words.end[:-1] - 1]] | (breaks[words.start[1:]] > breaks[words.end[:-1]])
    sentence = np.flatnonzero(new)
    place = np.arange(n) - sentence[np.cumsum(new) - 1]
    if by_words:
        cut, size = new.copy(), np.diff(np.r_[sentence, n])[np.cumsum(new) - 1]
        cut[_smallest(words, new, place, size, unit_words)] = True
        unit = np.flatnonzero(cut)
    else:
        unit = np.flatnonzero(place % unit_words == 0)
    return unit, np.searchsorted(unit, words.first)


def _spans(words: Words, unit: np.ndarray, first: np.ndarray, min_units: int, min_words: int):
    """(first unit, end unit, hash, hash) of every span."""
    n = len(unit)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    edge = np.r_[unit, len(words.start)]
    start = np.arange(n)
    end = np.maximum(np.searchsorted(edge, unit + min_words), start + min_units)
    own_end = np.repeat(first[1:], np.diff(first))
    ok = end <= own_end
    start, end = start[ok], end[ok]
    h = words.hashes()
    keys = [run_hash(run_sums(v), edge[start], edge[end]) for v in (h, mix(h + np.uint64(0x5851F42D4C957F2D)))]
    return start, end, *keys


def _once(owner: np.ndarray, start: np.ndarray, end: np.ndarray, a: np.ndarray, b: np.ndarray):
    """The first of equal spans of a text, and the others' (start, length)
    pairs, as bytes, or None."""
    order = np.lexsort((start, b, a, owner))
    new = np.ones(len(order), bool)
    for v in (owner, a, b):
        new[1:] &= v[order][1:] == v[order][:-1]
    new[1:] = ~new[1:]
    at = np.flatnonzero(new)
    size = np.diff(np.r_[at, len(order)])
    pairs = np.c_[start, end - start][order].astype("<i4")
    return order[at], [pairs[x + 1:x + n].tobytes() if n > 1 else None for x, n in zip(at.tolist(), size.tolist())]


def _rows_of(batch: pa.RecordBatch, unit_words: int, by_words: bool, min_units: int, min_words: int):
    texts = texts_of(batch, "_text")
    for at, to in slices(list(map(len, texts)), _SLICE):
        words = Words(texts[at:to])
        unit, first = _units(words, unit_words, by_words)
        yield at, to, words, unit, first, _spans(words, unit, first, min_units, min_words)


def _tag() -> Column:
    """The text's part of an occurrence's number: 31 bits."""
    return F.pmod(F.xxhash64("_text"), F.lit(1 << 31)) * F.lit(_POSITIONS)


def remove_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit_words: int = 12,
                   min_units: int = 3, min_words: int = 20, carry: tuple[str, ...] = (),
                   by_words: bool = False) -> DataFrame:
    """``(id, text, n_units, n_removed, removed_words)`` for every row; the
    text is without the removed units. ``carry`` names columns that go along,
    in a struct ``carried``."""
    docs = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                            *([F.struct(*carry).alias("_carried")] if carry else []))
    carried = ["_carried"] if carry else []
    id_type = docs.schema["_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            tags = batch.column("_tag").to_numpy()
            for at, to, _, unit, first, (start, end, a, b) in _rows_of(batch, unit_words, by_words, min_units, min_words):
                owner = np.searchsorted(first, start, side="right") - 1
                place = start - first[owner]
                one, more = _once(owner, place, place + end - start, a, b)
                owner = owner[one]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[one].view(np.int64)), pa.array(b[one].view(np.int64)),
                     batch.column("_id").take(pa.array(at + owner)), pa.array(tags[at + owner] + place[one]),
                     pa.array((end - start)[one].astype(np.int32)), pa.array(more, pa.binary())],
                    ["_a", "_b", "_id", "_at", "_len", "_more"])

    spans = docs.select("_id", "_text", _tag().alias("_tag")).mapInArrow(
        hashed, f"_a bigint not null, _b bigint not null, _id {id_type}, _at bigint not null, _len int not null, _more binary")
    # Half the hash tells nearly all spans that stand alone, in the smallest rows that can be shuffled.
    again = (spans.groupBy("_a").agg(F.count(F.lit(1)).alias("_n"), F.max(F.col("_more").isNotNull()).alias("_again"))
             .filter("_n > 1 or _again").select("_a"))
    repeated = spans.join(again, "_a", "left_semi")
    # With _len, which changes nothing, and without null checks both readers of the repeated spans share one shuffle.
    firsts = (repeated.groupBy("_a", "_b")
              .agg(F.min(F.struct("_id", "_at", "_len")).alias("_first"), F.count(F.lit(1)).alias("_n"),
                   F.max(F.col("_more").isNotNull()).alias("_again"))
              .filter("_n > 1 or _again").select("_a", "_b", "_first"))
    is_first = F.col("_id").eqNullSafe(F.col("_first._id")) & (F.col("_at") == F.col("_first._at"))
    later = repeated.join(firsts, ["_a", "_b"]).filter(~is_first | F.col("_more").isNotNull())
    own = F.when(~is_first, F.struct((F.col("_at") % _POSITIONS).cast("int").alias("at"), F.col("_len").alias("len")))
    # One row per document that loses something; its size is bounded by the text's.
    covered = (later.select("_id", F.shiftright("_at", 32).alias("_text_tag"), own.alias("_span"), "_more")
               .groupBy("_id", "_text_tag").agg(F.collect_set("_span").alias("_spans"), F.collect_list("_more").alias("_more")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            texts, gone, more = (texts_of(batch, "_text"), *(batch.column(c).to_pylist() for c in ("_spans", "_more")))
            kept, n_units, n_gone, words_gone = list(texts), [0] * len(texts), [0] * len(texts), [0] * len(texts)
            for at, to in slices(list(map(len, texts)), _SLICE):
                words = Words(texts[at:to])
                unit, first = _units(words, unit_words, by_words)
                offset = 0
                for i in range(at, to):
                    u = unit[first[i - at]:first[i - at + 1]]
                    n_units[i] = len(u)
                    if gone[i] or more[i]:
                        pairs = np.array([tuple(s.values()) for s in gone[i]], "<i4").reshape(-1, 2)
                        pairs = np.r_[pairs, np.frombuffer(b"".join(more[i]), "<i4").reshape(-1, 2)]
                        out = np.zeros(len(u) + 1, np.int64)
                        np.add.at(out, pairs[:, 0], 1)
                        np.add.at(out, pairs.sum(1), -1)
                        out = np.cumsum(out[:-1]) > 0
                        # A unit's bytes: from its first word to the next unit's, the text's ends included.
                        edges = np.r_[0, words.start[u[1:]] - offset, len(texts[i])]
                        kept[i] = b"".join(texts[i][a:b] for a, b, x in zip(edges[:-1], edges[1:], out) if not x)
                        n_gone[i] = int(out.sum())
                        sizes = np.diff(np.r_[u, words.first[i - at + 1]])
                        words_gone[i] = int(sizes[out].sum())
                    offset += len(texts[i]) + 1
            null = batch.column("_text").is_null().to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array([None if z else k.decode() for k, z in zip(kept, null)], pa.string()),
                 pa.array(n_units, pa.int32()), pa.array(n_gone, pa.int32()), pa.array(words_gone, pa.int64()),
                 *map(batch.column, carried)],
                ["_id", "_text", "n_units", "n_removed", "removed_words", *carried])

    joined = (docs.withColumn("_text_tag", F.shiftright(_tag(), 32)).alias("d")
              .join(covered.alias("c"), F.col("d._id").eqNullSafe(F.col("c._id"))
                    & (F.col("d._text_tag") == F.col("c._text_tag")), "left")
              .select("d._id", "d._text", "c._spans", "c._more", *(f"d.{c}" for c in carried)))
    out = joined.mapInArrow(cut, StructType(
        [docs.schema["_id"], StructField("_text", StringType()), StructField("n_units", IntegerType()),
         StructField("n_removed", IntegerType()), StructField("removed_words", LongType()),
         *(docs.schema[c] for c in carried)]))
    return out.withColumnsRenamed({"_id": id_col, "_text": text_col, "_carried": "carried"})
