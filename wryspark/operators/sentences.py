"""T-09 with learned abbreviations (Kiss and Strunk 2006, type-based stage).

A period after an abbreviation ends no sentence. Which words are abbreviations
is learnt from the corpus alone, without labels: an abbreviation nearly always
has its period, is short, and may hold more periods inside. One aggregate
counts every word with and without a period; a log-likelihood ratio weighted
by those three properties decides. The table of abbreviations is joined to
the different words that end a piece of a document with a period, so that a
document's own few abbreviations come back to it and the splitting is local to
the row.

The later stages of the paper (initials, ordinals, and the spelling of the
word after the period) are not built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import regex as rx
from ..functions import text as T
from ..session import cut_lineage

#: What may stand around a word, and what a word with a period looks like.
AROUND = r"^[\"'(\[]+|[\"')\],;:!?]+$"
TYPE = r"^\p{L}[\p{L}.]*$"
THRESHOLD = 0.3
_MARK = "\u0001"


def _bare(token: Column) -> Column:
    return F.lower(F.regexp_replace(token, AROUND, ""))


def learn_abbreviations(docs: DataFrame, text_col: str, threshold: float = THRESHOLD) -> DataFrame:
    """``(word, score)`` of the words whose score reaches ``threshold``.

    ``score = ll * exp(-letters) * periods * letters ** -without``: ll is the
    log-likelihood ratio of "the period comes at the corpus's rate" against
    "it comes in 99 of 100 cases"; ``periods`` counts the last one too, and
    ``without`` how often the word had none."""
    # Words are counted as they stand, so that only different ones are stripped of their marks.
    tokens = docs.select(F.explode_outer(F.split(text_col, rx.SPACE + "+")).alias("_token")).filter("_token != ''") \
        .groupBy("_token").agg(F.count(F.lit(1)).alias("_n"))
    words = tokens.select(_bare(F.col("_token")).alias("_bare"), "_n") \
        .select(F.regexp_replace("_bare", r"\.$", "").alias("word"), F.when(F.endswith("_bare", F.lit(".")), F.col("_n")).otherwise(0).alias("_dots"), "_n")
    # Read twice below.
    counts = cut_lineage(words.filter(F.col("word").rlike(TYPE)).groupBy("word").agg(F.sum("_n").alias("n"), F.sum("_dots").alias("dots")))
    total = counts.agg(F.sum("n").alias("tokens"), F.sum("dots").alias("all_dots"))
    rate = F.col("all_dots") / F.col("tokens")
    without = F.col("n") - F.col("dots")
    periods = F.length("word") - F.length(F.replace("word", F.lit("."), F.lit(""))) + 1
    letters = F.length("word") - periods + 1
    # One row of two sums.
    scored = counts.filter("dots > 0").join(F.broadcast(total)).withColumn(
        "ll", -2 * ((F.col("dots") * F.log(rate) + F.when(without > 0, without * F.log(1 - rate)).otherwise(0.0))
                    - (F.col("dots") * F.log(F.lit(0.99)) + without * F.log(F.lit(0.01)))))
    score = F.round(F.col("ll") * F.exp(-letters) * periods * F.pow(letters.cast("double"), -without), 9)
    return scored.select("word", score.alias("score")).filter(F.col("score") >= threshold)


def split_sentences(docs: DataFrame, id_col: str, text_col: str, abbreviations: DataFrame) -> DataFrame:
    """``(id, sentences)``: split after ``[.!?]``, closing marks and white
    space, unless the word before a lone period is one of ``abbreviations
    (word)``. Sentences are stripped, empty ones dropped; a null text has none.
    Ids must be unique."""
    marked = F.regexp_replace(T.strip(F.col(text_col)), r"([.!?][\"')\]]*)" + rx.SPACE + "+", "$1" + _MARK)
    pieces = F.filter(F.transform(F.split(F.coalesce(marked, F.lit("")), _MARK), T.strip), lambda s: s != "")

    def ending(piece: Column) -> Column:
        """The word before a piece's last period, empty if that doesn't end it."""
        last = F.regexp_extract(piece, r"(?:^|[ \t\n\x0B\f\r])([^ \t\n\x0B\f\r]*+)\z", 1)
        return F.regexp_extract(_bare(last), r"(?s)^(.*)\.\z", 1)

    own = docs.select(id_col, F.explode_outer(F.array_distinct(F.transform(pieces, ending))).alias("word")) \
        .filter("word != ''").join(abbreviations.select("word"), "word", "left_semi") \
        .groupBy(id_col).agg(F.collect_set("word").alias("_abbr"))
    rows = docs.select(id_col, F.col(text_col)).join(own, id_col, "left")
    # A piece that ends in an abbreviation goes on after a space; no piece holds the mark.
    is_open = lambda piece: F.array_contains("_abbr", ending(piece))
    lines = F.concat_ws("", F.transform(pieces, lambda p: F.concat(p, F.when(is_open(p), " ").otherwise(_MARK))))
    done = F.filter(F.transform(F.split(lines, _MARK), T.strip), lambda s: s != "")
    return rows.select(id_col, done.alias("sentences"))
