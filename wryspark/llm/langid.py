"""Language identification by nearest centroid.

A text's letters (lower-cased; anything else is one space) give runs of one to
three characters, counted in hashed places: log-scaled counts times inverse
document frequency, normalised. Every language has several centroids, from
spherical k-means over its training texts. A text takes the language of the
centroid with the highest cosine. If that is lower than nearly all of the
centroid's own training texts have, the prediction is marked as rejected. The
score is the language's share in a softmax of the best cosines.

Document frequencies cover all training texts. The centroids are fitted on a
sample of ``rows_per_language`` different texts of each language (all, if it has
fewer), picked by the hash of the text.

Defined results: a null text or one without a letter is ``und`` with score 0;
so is every text if there is no training text with a letter. Null languages
aren't learnt. Rows are predicted one by one, so repeated rows and null ids
come out as they went in. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices

UNKNOWN = "und"
_SLICE = 1 << 18


@dataclass
class CentroidModel:
    places: int
    idf: np.ndarray
    languages: list[str]  # one per centroid
    centroids: np.ndarray
    reject_below: np.ndarray


_LETTER: list[np.ndarray] = []


def _is_letter(codes: np.ndarray) -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTER[0][codes]


def counts(texts: list[str], places: int) -> tuple[np.ndarray, np.ndarray]:
    """(texts, places) counts of hashed runs, and which texts have letters."""
    low = [t.lower() for t in texts]
    sizes = np.array([len(t) + 1 for t in low])
    codes = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    owner = np.repeat(np.arange(len(low)), sizes)
    letter = _is_letter(codes)
    has = np.bincount(owner[letter], minlength=len(low)) > 0
    codes = np.where(letter, codes, 32).astype(np.uint32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of white space between letters, one place
    codes, owner = codes[keep], owner[keep]
    out = np.zeros(len(low) * places)
    h = np.zeros(len(codes), np.uint32)
    for n in range(1, 4):
        if len(codes) < n:
            break
        h = h[:len(codes) - n + 1] * np.uint32(0x9E3779B1) + codes[n - 1:] * np.uint32(0x85EBCA77)
        one_text = owner[n - 1:] == owner[:len(codes) - n + 1]
        mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        place = (mixed ^ (mixed >> np.uint32(13))) % np.uint32(places)
        out += np.bincount((owner[:len(place)] * places + place)[one_text], minlength=len(out))
    return out.reshape(len(low), places), has


def _vectors(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(count) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _parts(batch: pa.RecordBatch, column: str):
    texts = [t or "" for t in batch.column(column).to_pylist()]
    for at, to in slices([len(t) + 2000 for t in texts], _SLICE):
        yield at, to, texts[at:to]


def _k_means(v: np.ndarray, k: int, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart starts; (centroids, own centroid)."""
    starts = [int(np.argmax(v @ v.mean(0)))]
    while len(starts) < min(k, len(v)):
        starts.append(int(np.argmin((v @ v[starts].T).max(1))))
    c, own = v[starts], None
    for _ in range(rounds):
        new = (v @ c.T).argmax(1)
        if own is not None and (new == own).all():
            break
        own = new
        for j in range(len(c)):
            if (own == j).any():
                mean = v[own == j].mean(0)
                c[j] = mean / max(np.linalg.norm(mean), 1e-12)
    return c, own


def fit(documents: DataFrame, text_col: str = "text", lang_col: str = "lang", places: int = 1 << 13, clusters: int = 4,
        rows_per_language: int = 600, max_languages: int = 1000, reject_quantile: float = 0.002) -> CentroidModel:
    """Fit on ``documents`` with a language. The driver gets one number per
    place and ``clusters`` centroids per language. Every language is learnt;
    up to ``max_languages`` their sizes are broadcast, beyond that joined by
    shuffle."""
    train = documents.select(F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang")).filter(
        "_text is not null and _lang is not null")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(places, np.int64), 0
        for batch in batches:
            for _, _, texts in _parts(batch, "_text"):
                count, has = counts(texts, places)
                total += (count > 0).sum(0)
                rows += int(has.sum())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at].astype(np.int32)), pa.array(np.r_[rows, total[at]])],
                                         ["place", "n"])

    found = dict(train.select("_text").mapInArrow(frequencies, "place int, n bigint")
                 .groupBy("place").agg(F.sum("n").alias("n")).collect())
    rows = found.pop(-1, 0)
    df = np.zeros(places)
    df[list(found)] = list(found.values())
    idf = np.log((1 + rows) / (1 + df)) + 1
    # Different texts of each language: copies don't count. The 1.5 below is far beyond the estimate's error.
    sizes = train.groupBy("_lang").agg(F.approx_count_distinct(F.xxhash64(F.lit(5), "_text"), 0.02).alias("_n"))
    if train.select("_lang").distinct().count() <= max_languages:
        sizes = F.broadcast(sizes)
    drawn = F.pmod(F.xxhash64(F.lit(5), "_text"), F.lit(1 << 30)) / (1 << 30)
    first = Window.partitionBy("_lang").orderBy(F.xxhash64(F.lit(5), "_text"), "_text")
    # Copies of a text have one hash and are drawn together; one of them is enough.
    sample = (train.join(sizes, "_lang").filter(drawn < 1.5 * rows_per_language / F.col("_n"))
              .dropDuplicates(["_lang", "_text"]).withColumn("_k", F.row_number().over(first)).filter(F.col("_k") <= rows_per_language)
              .select("_lang", "_text"))

    def centre(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        held = []
        for batch in group.to_batches():
            for _, _, texts in _parts(batch, "_text"):
                count, has = counts(texts, places)
                held.append(_vectors(count[has], idf).astype(np.float32))
        v = np.concatenate(held)
        out = []
        if len(v):
            c, own = _k_means(v, clusters)
            for j in range(len(c)):
                near = (v[own == j] @ c[j]) if (own == j).any() else np.ones(1)
                out.append((c[j].astype("<f4").tobytes(), float(np.quantile(near, reject_quantile))))
        return pa.table({"_lang": pa.array([key[0].as_py()] * len(out), pa.string()),
                         "centroid": pa.array([o[0] for o in out], pa.binary()),
                         "below": pa.array([o[1] for o in out], pa.float64())})

    got = sample.groupBy("_lang").applyInArrow(centre, "_lang string, centroid binary, below double").collect()
    got.sort(key=lambda r: (r["_lang"], bytes(r["centroid"])))
    return CentroidModel(places, idf, [r["_lang"] for r in got],
                         np.array([np.frombuffer(r["centroid"], "<f4") for r in got], np.float32).reshape(-1, places),
                         np.array([r["below"] for r in got]))


def predict(documents: DataFrame, model: CentroidModel, id_col: str = "doc_id", text_col: str = "text",
            sharpness: float = 20.0) -> DataFrame:
    """``(id, lang_pred, score, cosine, rejected)`` for every row."""
    names = sorted(set(model.languages))
    of = np.array([names.index(x) for x in model.languages], int)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, texts in _parts(batch, "_text"):
                count, has = counts(texts, model.places)
                has &= len(names) > 0
                lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                best, rejected = np.zeros(len(texts)), ~has
                if has.any():
                    cosine = _vectors(count, model.idf).astype(np.float32) @ model.centroids.T
                    per = np.stack([cosine[:, of == j].max(1) for j in range(len(names))], 1).astype(float)
                    top = per.argmax(1)
                    weight = np.exp(sharpness * (per - per.max(1, keepdims=True)))
                    share = (weight / weight.sum(1, keepdims=True))[np.arange(len(texts)), top]
                    lang = [names[t] if h else UNKNOWN for t, h in zip(top, has)]
                    score = np.where(has, share, 0.0)
                    nearest = cosine.argmax(1)
                    best = np.where(has, cosine.max(1), 0.0)
                    rejected |= best < model.reject_below[nearest]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(at, to - at), pa.array(lang, pa.string()), pa.array(score),
                     pa.array(np.asarray(best, float)), pa.array(rejected)],
                    ["_id", "lang_pred", "score", "cosine", "rejected"])

    rows = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, lang_pred string, score double, cosine double, rejected boolean") \
        .withColumnRenamed("_id", id_col)
