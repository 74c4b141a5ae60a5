"""Vectorisation and encoding (E-01..E-06, A-16, K-02).

TF-IDF is kept in two interchangeable forms: a long table
``(row_id, term, weight)`` built from joins and aggregates (checked against
SQL), and an ML ``Pipeline`` stage chain producing sparse vectors for the
classifiers. Both use ``idf = ln((1 + n) / (1 + df)) + 1`` and L2 rows.
"""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.ml.feature import CountVectorizer, ElementwiseProduct, IDF, Normalizer, RegexTokenizer
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.wordlists import OOV_ID, PAD_ID, SEQUENCE_FILTERS
from .profile import explode_tokens
from .ordering import stream_key

TERM_PATTERN = r"[\p{L}\p{N}_]{2,}"


def tfidf_terms(c) -> Column:
    """Terms of two or more word characters of the lower-cased text."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.lower(col), F.lit(TERM_PATTERN), 0)


def term_table(df: DataFrame, text_col: str, id_col: str = "row_id") -> DataFrame:
    """Per (document, term) raw count; a document's terms stay together."""
    ex = explode_tokens(df.withColumn("_terms", tfidf_terms(text_col)), "_terms", [id_col], "term")
    return ex.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def doc_freq(terms: DataFrame, id_col: str = "row_id") -> DataFrame:
    """A-16: document frequency and corpus term frequency per term.

    Documents are counted by their ``tf``: a fit alone would read a term table
    without it, and the fit and its application shuffle the table once each."""
    return terms.groupBy("term").agg(F.sum(F.when(F.col("tf") > 0, 1)).alias("df"), F.sum("tf").alias("tf"))


def vocabulary(terms: DataFrame, size: int) -> DataFrame:
    """K-02: the ``size`` most frequent terms (ties alphabetical);
    ``orderBy().limit()`` plans as a per-task top-k plus a final merge."""
    return doc_freq(terms).orderBy(F.col("tf").desc(), F.col("term")).limit(size).select("term")


def tfidf_fit(df: DataFrame, text_col: str, id_col: str = "row_id",
              max_features: int | None = None) -> DataFrame:
    """Fit the long form on training rows: ``(term, idf)`` with
    ``idf = ln((1 + n) / (1 + df)) + 1``; optionally only the top
    ``max_features`` terms by corpus frequency."""
    return idf_of(term_table(df, text_col, id_col), df.agg(F.count(F.lit(1))).scalar(), id_col, max_features)


def idf_of(terms: DataFrame, n_docs: Column, id_col: str = "row_id", max_features: int | None = None) -> DataFrame:
    """``(term, idf)`` from a term table of ``n_docs`` documents."""
    dfs = doc_freq(terms, id_col)
    if max_features:
        dfs = dfs.orderBy(F.col("tf").desc(), F.col("term")).limit(max_features)
    return dfs.select("term", (F.log((F.lit(1) + n_docs) / (F.lit(1) + F.col("df"))) + F.lit(1)).alias("idf"))


def weights_of(terms: DataFrame, idf: DataFrame, id_col: str = "row_id") -> DataFrame:
    """``(id, term, weight)`` of a term table: terms outside the fitted
    vocabulary dropped, then L2 per document."""
    w = terms.join(idf, "term").withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", (F.col("_w") / norm).alias("weight"))


def tfidf_apply(df: DataFrame, idf: DataFrame, text_col: str, id_col: str = "row_id") -> DataFrame:
    """Apply a fitted ``(term, idf)`` table: ``(id, term, weight)``, terms
    outside the fitted vocabulary dropped, then L2 per document."""
    return weights_of(term_table(df, text_col, id_col), idf, id_col)


def tfidf_long(df: DataFrame, text_col: str, id_col: str = "row_id",
               max_features: int | None = None) -> DataFrame:
    """E-01 long form: ``(id, term, weight)`` with smooth IDF (+1) and L2
    normalisation per document, fitted and applied on ``df``. A capped
    vocabulary (``max_features``) is bounded and joins as a broadcast."""
    idf = tfidf_fit(df, text_col, id_col, max_features)
    if max_features:
        idf = F.broadcast(idf)
    return tfidf_apply(df, idf, text_col, id_col)


class SmoothIDF(Estimator, HasInputCol, HasOutputCol):
    """IDF with the +1 of the smooth form: ``tf * (ln((n+1)/(df+1)) + 1)``.

    Fits Spark's ``IDF`` (document frequencies by a distributed
    aggregate; its idf is ``ln((n+1)/(df+1))``) and returns a built-in
    ``ElementwiseProduct`` scaling by ``idf + 1``: sparse vectors stay
    sparse, the work stays in the JVM, and the fitted pipeline saves as
    standard stages. The scaling vector is vocabulary-sized (bounded by
    ``vocabSize``).
    """

    def __init__(self, inputCol=None, outputCol=None):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _fit(self, dataset):
        model = IDF(inputCol=self.getInputCol(), outputCol="_idf_unused").fit(dataset)
        scale = DenseVector(model.idf.toArray() + 1.0)
        return ElementwiseProduct(scalingVec=scale, inputCol=self.getInputCol(),
                                  outputCol=self.getOutputCol())


def tfidf_stages(input_col: str, output_col: str = "features", max_features: int | None = None,
                 min_df: float = 1.0):
    """E-01 as ``Pipeline`` stages: tokens -> counts -> IDF -> +tf -> L2.
    Without ``max_features`` every term is kept (the stage's largest size)."""
    vocab = max_features or (1 << 31) - 1
    return [
        RegexTokenizer(inputCol=input_col, outputCol="_tok", pattern=TERM_PATTERN, gaps=False,
                       toLowercase=True, minTokenLength=2),
        CountVectorizer(inputCol="_tok", outputCol="_tf", vocabSize=vocab, minDF=min_df),
        SmoothIDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol=output_col, p=2.0),
    ]


def filter_class(chars: str = SEQUENCE_FILTERS) -> str:
    """Regex character class of ``chars`` readable by Java regex and RE2."""
    esc = {"\\": "\\\\", "]": "\\]", "[": "\\[", "^": "\\^", "-": "\\-", "\t": "\\t", "\n": "\\n"}
    return "[" + "".join(esc.get(ch, ch) for ch in chars) + "]"


SEQUENCE_CLASS = filter_class()


def sequence_tokens(c) -> Column:
    """Tokens of the sequence encoder: lower, filter characters to spaces,
    split on spaces, drop empties."""
    col = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(F.regexp_replace(F.lower(col), SEQUENCE_CLASS, " "), " "), lambda x: x != "")


def word_index(df: DataFrame, tokens_col: str, num_words: int, id_col: str = "row_id",
               version_col: str | None = None) -> DataFrame:
    """E-02 vocabulary: ``(word, id)`` for the ``num_words - 2`` most frequent
    words, ties by first appearance; ids start at 2 (0 pad, 1 OOV)."""
    keep = [id_col] + ([version_col] if version_col else [])
    ex = explode_tokens(df, tokens_col, keep, "word")
    ver = F.col(version_col) if version_col else F.lit(0)
    counts = ex.groupBy("word").agg(F.count(F.lit(1)).alias("count"),
                                    F.min(stream_key(ver, id_col, "pos")).alias("first_seen"))
    top = counts.orderBy(F.col("count").desc(), "first_seen").limit(num_words - 2)
    return top.withColumn("id", (F.row_number().over(
        Window.orderBy(F.col("count").desc(), "first_seen")) + 1).cast("int")).select("word", "id")


def to_sequences(df: DataFrame, tokens_col: str, vocab: DataFrame, id_col: str = "row_id") -> DataFrame:
    """E-02: token array -> id array (OOV = 1), order kept. The vocabulary
    is bounded by ``num_words`` and broadcast; ids are regrouped per
    document (a document's tokens only)."""
    ex = df.select(id_col, F.posexplode_outer(tokens_col).alias("pos", "word"))
    j = ex.join(F.broadcast(vocab), "word", "left").withColumn(
        "id", F.when(F.col("word").isNotNull(), F.coalesce("id", F.lit(OOV_ID))))
    g = j.groupBy(id_col).agg(F.array_sort(F.collect_list(
        F.when(F.col("id").isNotNull(), F.struct("pos", "id")))).alias("_p"))
    return g.select(id_col, F.transform("_p", lambda s: s["id"]).alias("ids"))


def pad(ids, length: int, value: int = PAD_ID) -> Column:
    """E-03: post-pad / post-truncate to ``length``."""
    col = F.col(ids) if isinstance(ids, str) else ids
    return F.slice(F.concat(col, F.array_repeat(F.lit(value), length)), 1, length)


def with_markers(ids, length: int, start_id: int, end_id: int) -> tuple[Column, Column]:
    """E-04: ``[start] + ids[:length-2] + [end]`` padded to ``length``,
    and the attention mask (1 on real positions)."""
    col = F.col(ids) if isinstance(ids, str) else ids
    body = F.slice(col, 1, length - 2)
    seq = pad(F.concat(F.array(F.lit(start_id)), body, F.array(F.lit(end_id))), length)
    return seq, F.transform(seq, lambda x: (x != PAD_ID).cast("int"))
