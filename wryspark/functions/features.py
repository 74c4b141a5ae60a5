"""Scalar features (F-01..F-10): one text in, one number out.

Counts are BIGINT so the same column reads alike in Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import regex as rx
from .text import _c, ws_tokens


def _big(c: Column) -> Column:
    return c.cast("bigint")


def word_count(c) -> Column:
    """F-01: number of whitespace tokens."""
    return _big(F.size(ws_tokens(c)))


def char_count(c) -> Column:
    """F-02: length in code points (also ``headline_length``)."""
    return _big(F.length(_c(c)))


def char_occurrences(c, ch: str) -> Column:
    return _big(F.length(_c(c)) - F.length(F.replace(_c(c), F.lit(ch), F.lit(""))))


def exclamation_count(c) -> Column:
    """F-03."""
    return char_occurrences(c, "!")


def question_count(c) -> Column:
    """F-04."""
    return char_occurrences(c, "?")


def ascii_punct_count(c) -> Column:
    """F-05: the 32 ASCII punctuation marks (``_`` included)."""
    return _big(F.length(F.regexp_replace(_c(c), rx.NOT_ASCII_PUNCT, "")))


def nonword_count(c) -> Column:
    """F-06: characters that are neither word characters nor whitespace."""
    return _big(F.length(_c(c)) - F.length(F.regexp_replace(_c(c), rx.NON_WORD_NON_SPACE, "")))


def multi_punct_count(c) -> Column:
    """F-07: runs of two or more of ``? ! .``."""
    return _big(F.regexp_count(_c(c), F.lit(rx.MULTI_PUNCT)))


def large_number_flag(c) -> Column:
    """F-08: 1 when a standalone run of five or more digits occurs."""
    return _big(F.when(_c(c).rlike(rx.LARGE_NUMBER), 1).otherwise(0))


def all_caps_count(c) -> Column:
    """F-09: whitespace tokens longer than one character written in capitals
    (at least one cased letter, none lower-case)."""
    return _big(F.size(F.filter(
        ws_tokens(c),
        lambda w: (F.length(w) > 1) & (F.upper(w) == w) & (F.lower(w) != w))))


def avg_word_length(c) -> Column:
    """F-10: mean length of whitespace tokens; null when there is none."""
    toks = ws_tokens(c)
    total = F.aggregate(toks, F.lit(0).cast("bigint"), lambda acc, w: acc + F.length(w))
    return F.when(F.size(toks) > 0, total / F.size(toks))


FEATURES = {
    "word_count": word_count,
    "char_count": char_count,
    "headline_length": char_count,
    "exclamation_mark": exclamation_count,
    "question_mark": question_count,
    "ascii_punct_count": ascii_punct_count,
    "punctuation_count": nonword_count,
    "multiple_punct_count": multi_punct_count,
    "large_number_flag": large_number_flag,
    "all_caps_count": all_caps_count,
    "avg_word_length": avg_word_length,
}


def with_features(df, text_col: str, names=None):
    """Append the named features (default: all) in one projection."""
    names = names or list(FEATURES)
    return df.withColumns({n: FEATURES[n](text_col) for n in names})
