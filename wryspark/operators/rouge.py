"""ROUGE scores (R-02..R-06) between a prediction and a reference column.

ROUGE-1/2 are plain Spark: n-grams of both sides are exploded, counted per
(pair, n-gram), clipped with ``least`` and summed per pair. ROUGE-L and
ROUGE-Lsum fold the dynamic program of the longest common subsequence over
the pair's word arrays (``functions.lcs``), row by row in the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lcs import lcs_length, union_hits
from ..functions.regex import ROUGE_TOKEN


def rouge_tokens(c) -> Column:
    """Lower-case, keep runs of ``[a-z0-9]`` (everything else separates)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(ROUGE_TOKEN), 0)


def _ngrams(tokens: Column, n: int) -> Column:
    if n == 1:
        return tokens
    idx = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1))) \
        .otherwise(F.array().cast("array<int>"))
    return F.transform(idx, lambda i: F.array_join(F.slice(tokens, i, n), " "))


def _f(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def rouge_n(pairs: DataFrame, id_col: str, pred_col: str, ref_col: str, n: int) -> DataFrame:
    """Per pair ``precision, recall, fmeasure`` of ROUGE-n."""
    g = pairs.select(id_col, F.posexplode_outer(F.array(
        _ngrams(rouge_tokens(pred_col), n), _ngrams(rouge_tokens(ref_col), n))).alias("side", "grams"))
    ex = g.select(id_col, "side", F.explode("grams").alias("gram"))
    per = ex.groupBy(id_col, "gram").agg(
        F.sum((F.col("side") == 0).cast("long")).alias("cp"),
        F.sum((F.col("side") == 1).cast("long")).alias("cr"))
    tot = per.groupBy(id_col).agg(F.sum(F.least("cp", "cr")).alias("hit"), F.sum("cp").alias("np"),
                                  F.sum("cr").alias("nr"))
    out = pairs.select(id_col).join(tot, id_col, "left").fillna(0, ["hit", "np", "nr"])
    p = F.when(F.col("np") > 0, F.col("hit") / F.col("np")).otherwise(F.lit(0.0))
    r = F.when(F.col("nr") > 0, F.col("hit") / F.col("nr")).otherwise(F.lit(0.0))
    return out.select(id_col, p.alias("precision"), r.alias("recall"), _f(p, r).alias("fmeasure"))


def _scores(hit: Column, n_pred: Column, n_ref: Column) -> list[Column]:
    p = F.when(n_pred > 0, hit / n_pred).otherwise(F.lit(0.0))
    r = F.when(n_ref > 0, hit / n_ref).otherwise(F.lit(0.0))
    return [p.alias("precision"), r.alias("recall"), _f(p, r).alias("fmeasure")]


def _sentence_tokens(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.transform(F.split(F.coalesce(col, F.lit("")), "\n"), lambda s: rouge_tokens(s))


def rouge_l(pairs: DataFrame, id_col: str, pred_col: str, ref_col: str) -> DataFrame:
    """R-04: ROUGE-L on whole texts."""
    rows = pairs.select(id_col, rouge_tokens(pred_col).alias("_p"), rouge_tokens(ref_col).alias("_r"))
    counted = rows.select(id_col, lcs_length(F.col("_p"), F.col("_r")).alias("_hit"), F.size("_p").alias("_np"),
                          F.size("_r").alias("_nr"))
    return counted.select(id_col, *_scores(F.col("_hit"), F.col("_np"), F.col("_nr")))


def rouge_lsum(pairs: DataFrame, id_col: str, pred_col: str, ref_col: str) -> DataFrame:
    """R-05: ROUGE-Lsum; sentences are the newline-separated lines."""
    def sentences(c: str) -> Column:
        return F.filter(_sentence_tokens(c), lambda s: F.size(s) > 0)
    rows = pairs.select(id_col, sentences(pred_col).alias("_p"), sentences(ref_col).alias("_r"))
    counted = rows.select(id_col, union_hits(F.col("_r"), F.col("_p")).alias("_hit"), F.size(F.flatten("_p")).alias("_np"),
                          F.size(F.flatten("_r")).alias("_nr"))
    return counted.select(id_col, *_scores(F.col("_hit"), F.col("_np"), F.col("_nr")))


def corpus_scores(pairs: DataFrame, id_col: str, pred_col: str, ref_col: str,
                  with_lcs: bool = True) -> DataFrame:
    """R-06: mean F of every ROUGE variant over the pairs, rounded to 4."""
    parts = {"rouge1": rouge_n(pairs, id_col, pred_col, ref_col, 1),
             "rouge2": rouge_n(pairs, id_col, pred_col, ref_col, 2)}
    if with_lcs:
        parts["rougeL"] = rouge_l(pairs, id_col, pred_col, ref_col)
        parts["rougeLsum"] = rouge_lsum(pairs, id_col, pred_col, ref_col)
    out = None
    for name, df in parts.items():
        m = df.agg(F.round(F.avg("fmeasure"), 4).alias("score")).select(F.lit(name).alias("metric"), "score")
        out = m if out is None else out.unionByName(m)
    return out


_PER_DIGEST = 8


def _poisson_steps(limit: int = 10) -> list[int]:
    """Where, of 65,536 equal parts, a Poisson(1) count goes up by one."""
    steps, total, term = [], 0.0, math.exp(-1)
    for k in range(limit):
        total += term
        term /= k + 1
        steps.append(math.floor(total * 65536))
    return [s for s in steps if s < 65536]


POISSON_STEPS = _poisson_steps()


def bootstrap_scores(scored: DataFrame, id_col: str, metrics: list[str], replicates: int = 1000,
                     confidence: float = 0.95) -> DataFrame:
    """R-06 with its resampling: ``(metric, low, mid, high)``, the percentiles
    of the mean over ``replicates`` bootstrap samples of the rows.

    A row stands in a sample a Poisson(1) number of times, read from a hash of
    its id and the sample's number (Poisson bootstrap). So no sample is ever
    drawn or stored: one aggregate holds the sums of all samples, partially
    summed before its shuffle of ``replicates`` keys."""
    blocks = -(-replicates // _PER_DIGEST)
    digest = scored.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))) \
        .withColumn("_h", F.md5(F.concat_ws("-", F.col(id_col).cast("string"), F.col("_block").cast("string"))))
    part = digest.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(_PER_DIGEST - 1))))
    value = F.conv(F.substr("_h", 4 * F.col("_j") + 1, F.lit(4)), 16, 10).cast("int")
    times = sum(((value >= s).cast("int") for s in POISSON_STEPS[1:]), (value >= POISSON_STEPS[0]).cast("int"))
    drawn = part.select((F.col("_block") * _PER_DIGEST + F.col("_j")).alias("_rep"), times.alias("_times"), *metrics) \
        .filter((F.col("_times") > 0) & (F.col("_rep") < replicates))
    means = drawn.groupBy("_rep").agg(*[(F.sum(F.col(m) * F.col("_times")) / F.sum("_times")).alias(m) for m in metrics])
    tail = (1 - confidence) / 2
    cut = means.agg(*[F.percentile(m, F.array(F.lit(tail), F.lit(0.5), F.lit(1 - tail))).alias(m) for m in metrics])
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.round(F.col(m)[0], 4).alias("low"), F.round(F.col(m)[1], 4).alias("mid"),
                              F.round(F.col(m)[2], 4).alias("high")) for m in metrics])
    return cut.select(F.explode(rows).alias("_r")).select("_r.*")
