"""Scalar text functions (T-01..T-14): pure ``Column -> Column``.

All of them are built-in expressions, so they stay inside whole-stage
codegen; none calls back into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import regex as rx
from .wordlists import ENGLISH_STOPWORDS, LINK_PREFIX_LEN

_END = "(" + rx.SPACE + r"|\z)"
# The classes of ``rx``, ASCII ranges first: Java tries a class's parts in turn.
_MARK = r"[^a-zA-Z0-9_ \t\n\x0B\f\r\p{L}\p{N}]"
_PADDED = r"([^a-zA-Z0-9_ \t\n\x0B\f\r.'/\p{L}\p{N}-])"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c) -> Column:
    """T-01: lower, drop links, drop digits, drop non-word-non-space marks."""
    t = F.lower(_c(c))
    t = F.regexp_replace(t, rx.URL, "")
    t = F.regexp_replace(t, rx.DIGIT, "")
    return F.regexp_replace(t, _MARK, "")


def letters_only(c) -> Column:
    """T-02: every non-ASCII-letter becomes a space, then lower-case."""
    return F.lower(F.regexp_replace(_c(c), "[^a-zA-Z]", " "))


def ws_tokens(c) -> Column:
    """T-04: whitespace tokens, no empty strings (Python ``str.split()``)."""
    return F.filter(F.split(_c(c), rx.SPACE + "+"), lambda x: x != "")


def treebank_spaced(c) -> Column:
    """Detach punctuation and contraction suffixes with spaces.

    Ellipses and a period before whitespace/end are detached; every other
    non-word mark except ``. ' / -`` is padded; ``n't`` and ``'s 're 've
    'll 'd 'm`` are split off their word; a closing apostrophe is split.
    """
    t = _c(c)
    t = F.regexp_replace(t, r"\.{2,}", " $0 ")
    t = F.regexp_replace(t, r"\." + _END, " .$1")
    t = F.regexp_replace(t, _PADDED, " $1 ")
    u = F.regexp_replace(t, r"(?i)n't" + _END, " n't$1")
    u = F.regexp_replace(u, r"(?i)'(s|re|ve|ll|d|m)" + _END, " '$1$2")
    # Texts without an apostrophe, which no step adds, are not searched for one.
    return F.when(F.contains(_c(c), F.lit("'")), F.regexp_replace(u, r"'" + _END, " '$1")).otherwise(t)


def word_tokens(c) -> Column:
    """T-05: Treebank-style tokens (punctuation kept as tokens)."""
    return ws_tokens(treebank_spaced(c))


def alphabetic(tokens) -> Column:
    """Tokens of an array column that are letters only."""
    return F.filter(_c(tokens), lambda x: x.rlike(rx.ALPHA_TOKEN))


def alpha_tokens(c) -> Column:
    """T-03: Treebank-style tokens kept when purely alphabetic."""
    return alphabetic(word_tokens(c))


def remove_stopwords(tokens, stopwords=None, case_sensitive: bool = False) -> Column:
    """Drop stopwords from an array column (compared lower-cased unless
    ``case_sensitive``). The optimizer turns the literal list into a hash set."""
    words = list(stopwords or ENGLISH_STOPWORDS)
    if case_sensitive:
        return F.filter(_c(tokens), lambda x: ~x.isin(words))
    return F.filter(_c(tokens), lambda x: ~F.lower(x).isin(words))


def filtered_tokens(c, stopwords=None) -> Column:
    """T-07: alphabetic tokens, lower-cased, minus stopwords."""
    return filtered(alpha_tokens(c), stopwords)


def filtered(tokens, stopwords=None) -> Column:
    """Tokens of an array column, lower-cased, minus stopwords."""
    lowered = F.transform(_c(tokens), lambda x: F.lower(x))
    return remove_stopwords(lowered, stopwords, case_sensitive=True)


def drop_stopwords_text(c, stopwords=None, case_sensitive: bool = True) -> Column:
    """T-06: whitespace tokens minus stopwords, re-joined by one space."""
    return F.array_join(remove_stopwords(ws_tokens(c), stopwords, case_sensitive), " ")


def strip_link_prefix(c, n: int = LINK_PREFIX_LEN) -> Column:
    """T-14: drop the first ``n`` characters of a link (``url[n:]``)."""
    return F.substring(_c(c), n + 1, 1 << 30)


# Abbreviations after which a period does not end a sentence.
SENTENCE_ABBREVIATIONS = ["Mr", "Mrs", "Ms", "Dr", "Prof", "Sr", "Jr", "St",
                          "vs", "etc", "e.g", "i.e", "U.S", "Inc", "Ltd", "Co"]

_SENT_MARK = "\u0001"


def strip(c) -> Column:
    """Python ``str.strip()`` for the whitespace class (``trim`` only drops spaces)."""
    return F.regexp_replace(_c(c), "^" + rx.SPACE + "+|" + rx.SPACE + "+$", "")


def sentences(c) -> Column:
    """T-09: split after ``[.!?]`` plus closing quotes/brackets and whitespace.

    A period right after a listed abbreviation does not split. Sentences
    are stripped; empty ones dropped.
    """
    t = strip(c)
    t = F.regexp_replace(t, r"([.!?][\"')\]]*)" + rx.SPACE + "+", "$1" + _SENT_MARK)
    abbr = "|".join(a.replace(".", r"\.") for a in SENTENCE_ABBREVIATIONS)
    t = F.regexp_replace(t, r"(^|[^\p{L}\p{N}_])(" + abbr + r")\." + _SENT_MARK, "$1$2. ")
    return F.filter(F.transform(F.split(t, _SENT_MARK), strip), lambda s: s != "")


def newline_sentences(c) -> Column:
    """T-11: strip, split into sentences, join them with newlines."""
    return F.array_join(sentences(c), "\n")


def join_tokens(tokens, sep: str = " ") -> Column:
    """T-12."""
    return F.array_join(_c(tokens), sep)
