"""Longest common subsequences of word arrays as column expressions.

The dynamic program runs bit-parallel over one of the arrays: a row of its
table is a few whole numbers of 62 bits, in which a zero at place j says that
the length grows there. A word of the other array turns one row into the next
with an addition, so a row costs a 62nd of its cells, and the whole is a fold
over an array (``aggregate``): no Python worker, and nothing leaves the row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of a whole number that are used: a sum of two such and a carry fits.
_BITS = 62
_FULL = (1 << _BITS) - 1


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, though used often."""
    return F.transform(F.array(value), body)[0]


def _shift(bits: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bits.cast("int"))


def _limbs(words: Column) -> Column:
    """Numbers 0.. of the limbs of a row over ``words``; at least one."""
    return F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(words) - 1) / _BITS)).cast("int"))


def word_masks(words: Column) -> Column:
    """Map of each different word to the bits of its places, limb by limb."""
    def places(word: Column) -> Column:
        return F.transform(_limbs(words), lambda k: F.aggregate(
            F.sequence(F.lit(1), F.lit(_BITS)), F.lit(0).cast("bigint"),
            lambda bits, i: F.when(F.get(words, k * _BITS + i - 1) == word, bits.bitwiseOR(_shift(i - 1))).otherwise(bits)))
    return _let(F.array_distinct(words), lambda different: F.map_from_arrays(different, F.transform(different, places)))


def _ones(words: Column) -> Column:
    return F.transform(_limbs(words), lambda k: F.lit(_FULL))


def _next_row(row: Column, mask: Column) -> Column:
    """The row after one more word of the other array; ``mask`` is where the
    row's array holds that word, null if nowhere."""
    def limb(state: Column, k: Column) -> Column:
        old = F.get(row, k)
        found = old.bitwiseAND(F.get(mask, k))
        total = old + found + state["carry"]
        new = total.bitwiseAND(F.lit(_FULL)).bitwiseOR(old.bitwiseAND(F.bitwise_not(found)))
        return F.struct(F.shiftright(total, _BITS).alias("carry"), F.concat(state["row"], F.array(new)).alias("row"))
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("row"))
    moved = F.aggregate(F.sequence(F.lit(0), F.size(row) - 1), start, limb)["row"]
    return F.when(mask.isNull(), row).otherwise(moved)


def _prefix_length(row: Column, n: Column) -> Column:
    """Length of the longest common subsequence with the first ``n`` words of
    the row's array: the zeros among its first n bits."""
    def zeros(total: Column, k: Column) -> Column:
        bits = F.least(F.greatest(n - k * _BITS, F.lit(0)), F.lit(_BITS))
        return total + bits - F.bit_count(F.get(row, k).bitwiseAND(_shift(bits) - 1)).cast("int")
    return F.aggregate(F.sequence(F.lit(0), F.size(row) - 1), F.lit(0), zeros)


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two word arrays."""
    def walk(x: Column) -> Column:
        rows = _let(word_masks(x["a"]), lambda masks: F.aggregate(
            x["b"], _ones(x["a"]), lambda row, word: _next_row(row, F.try_element_at(masks, word))))
        return _let(rows, lambda row: _prefix_length(row, F.size(x["a"])))
    return _let(F.struct(a.alias("a"), b.alias("b")), walk)


def lcs_places(ref: Column, cand: Column, masks: Column) -> Column:
    """Places (from 0) of the words of ``ref`` on one longest common
    subsequence with ``cand``, given ``word_masks(cand)``. Where both ways back
    are as long, a word of ``ref`` is passed over."""
    rows = F.aggregate(ref, F.array(_ones(cand)), lambda made, word: F.concat(
        made, F.array(_next_row(F.element_at(made, -1), F.try_element_at(masks, word)))))

    def back(table: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            i, j = at["i"], at["j"]
            def go(di: int, dj: int, hits: Column) -> Column:
                return F.struct((i - di).alias("i"), (j - dj).alias("j"), hits.alias("hits"))
            shorter = _prefix_length(F.get(table, i), j - 1) > _prefix_length(F.get(table, i - 1), j)
            return (F.when((i == 0) | (j == 0), at)
                    .when(F.get(ref, i - 1) == F.get(cand, j - 1), go(1, 1, F.concat(at["hits"], F.array(i - 1))))
                    .when(shorter, go(0, 1, at["hits"])).otherwise(go(1, 0, at["hits"])))
        start = F.struct(F.size(ref).alias("i"), F.size(cand).alias("j"), F.array().cast("array<int>").alias("hits"))
        return F.aggregate(F.sequence(F.lit(0), F.size(ref) + F.size(cand)), start, step)["hits"]

    return _let(rows, back)


def union_hits(refs: Column, cands: Column) -> Column:
    """For every sentence of ``refs``, the union of its words' places on the
    subsequences with each sentence of ``cands``; of the words found so, each
    counts at most as often as the candidate holds it."""
    def walk(x: Column) -> Column:
        known = F.transform(x["cands"], lambda c: F.struct(c.alias("words"), word_masks(c).alias("masks")))
        def words_of(r: Column, c: Column) -> Column:
            return lcs_places(r, c["words"], c["masks"])
        found = _let(known, lambda all_of: F.flatten(F.transform(x["refs"], lambda r: F.transform(
            F.array_distinct(F.flatten(F.transform(all_of, lambda c: words_of(r, c)))), lambda i: F.get(r, i)))))
        return _let(F.struct(found.alias("found"), F.flatten(x["cands"]).alias("held")), lambda y: F.aggregate(
            F.array_distinct(y["found"]), F.lit(0), lambda total, word: total + F.least(
                F.size(F.filter(y["found"], lambda w: w == word)), F.size(F.filter(y["held"], lambda w: w == word)))))
    return _let(F.struct(refs.alias("refs"), cands.alias("cands")), walk)
