"""Article branch: link lookup with fallback (J-03), body extraction from
stored pages (T-13), summarisation pairs, lead-1 and extractive summaries
(R-01, R-07, R-08).

Body extraction is a state machine over a page's tags, in columns
(``functions.markup``). (Spark's ``xpath`` fails the whole job on malformed
HTML, and the stored pages are malformed.)
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.markup import title_and_body
from ..functions.wordlists import BODY_ALLOWED_PARENTS, BODY_BLOCKLIST, LINK_PREFIX_LEN
from ..session import cut_lineage, small_side
from .encode import tfidf_terms


def extract_articles(pages: DataFrame) -> DataFrame:
    """T-13: ``(page_id, url, title, body)`` for every stored page; a null or
    empty page has an empty title and body."""
    page = title_and_body(F.col("html"), BODY_ALLOWED_PARENTS, BODY_BLOCKLIST)
    return pages.select("page_id", "url", page.alias("_page")).select("page_id", "url", "_page.title", "_page.body")


def lookup_bodies(links: DataFrame, link_col: str, articles: DataFrame,
                  prefix_len: int = LINK_PREFIX_LEN, order_col: str = "body") -> DataFrame:
    """J-03: body for each link - by the link itself, else by the link
    without its first ``prefix_len`` characters, else ``''``. Of several
    articles with one url the first by ``order_col`` counts.

    Two left equi-joins on the article table (a shuffle each, or a
    broadcast when AQE finds the article side small). A link of up to
    ``prefix_len`` characters has an empty rest; as null it joins nothing and
    is dealt out evenly.
    """
    one = articles.filter("url is not null").groupBy("url").agg(F.min_by("body", order_col).alias("body"))
    a1 = one.select(F.col("url").alias("_u1"), F.col("body").alias("_b1"))
    a2 = one.select(F.col("url").alias("_u2"), F.col("body").alias("_b2"))
    out = (links.withColumn("_tail", T.strip_link_prefix(link_col, prefix_len))
           .withColumn("_tail", F.when(F.col("_tail") != "", F.col("_tail")))
           .join(a1, F.col(link_col) == F.col("_u1"), "left")
           .join(a2, F.col("_tail") == F.col("_u2"), "left"))
    return out.withColumn("body", F.coalesce("_b1", "_b2", F.lit(""))) \
        .drop("_tail", "_u1", "_b1", "_u2", "_b2")


def lead_sentence(c):
    """R-01/K-03: first sentence (``''`` when there is none)."""
    return F.coalesce(F.try_element_at(T.sentences(c), F.lit(1)), F.lit(""))


def extractive_summary(docs: DataFrame, id_col: str, text_col: str, weights: DataFrame | None = None,
                       min_words: int = 10, max_words: int = 30) -> DataFrame:
    """R-07: pick the sentence with the highest mean term weight (ties: the
    earlier one), then take ``clamp(words in it, min_words, max_words)``
    whitespace words starting at it.

    ``weights`` is a long table ``(id_col, term, weight)``, a row per term of
    a document, such as ``tfidf_long`` over the same documents. A document's
    weights come to its text as one list, and its sentences are scored there;
    neither sentences nor their terms are shuffled. Rows that repeat an id are
    scored together, sentence by sentence; rows without an id take their first.

    Without ``weights`` they are ``tfidf_long`` of ``docs`` themselves, worked
    out in the text: no row per document and term is made, but for rare terms.
    """
    score = F.arrow_udf(_best_sentences, "int")
    if weights is None:
        own, score = _rare_idfs(docs, id_col, text_col)
    else:
        own = weights.groupBy(F.col(id_col).alias("_of")).agg(
            F.collect_list("term").alias("_terms"), F.collect_list(F.coalesce("weight", F.lit(0.0))).alias("_weights"))
    d = docs.groupBy(id_col).agg(F.collect_list(F.struct(T.sentences(text_col).alias("s"))).alias("_rows")) \
        .join(own, F.col(id_col) == F.col("_of"), "left")
    terms = F.transform("_rows", lambda row: F.transform(row["s"], lambda s: tfidf_terms(s)))
    best = F.when(F.col(id_col).isNotNull(), score(terms, "_terms", "_weights")).otherwise(0)
    d = d.select(id_col, best.alias("best"), F.explode("_rows").alias("_row")).select(id_col, "best", F.col("_row.s").alias("_s"))
    tail = F.slice("_s", F.col("best") + 1, F.greatest(F.size("_s"), F.lit(1)))
    first_len = F.size(T.ws_tokens(F.coalesce(F.try_element_at("_s", F.col("best") + 1), F.lit(""))))
    words = T.ws_tokens(F.array_join(tail, " "))
    n_take = F.least(F.lit(max_words), F.greatest(F.lit(min_words), first_len))
    return d.select(id_col, F.array_join(F.slice(words, 1, n_take), " ").alias("summary"))


def term_documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(term, df)``: in how many documents a term stands; rows that repeat an
    id are one document. Only the terms of those rows are shuffled singly."""
    again = small_side(docs.groupBy(F.col(id_col).alias("_again")).count().filter("count > 1").select("_again", F.lit(True).alias("_twice")))
    terms = F.explode_outer(F.array_distinct(tfidf_terms(text_col))).alias("term")
    rows = docs.select(F.col(id_col).alias("_id"), text_col).join(again, F.col("_id").eqNullSafe(F.col("_again")), "left")
    once = rows.filter("_twice is null").select(terms).filter("term is not null").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    twice = rows.filter("_twice").select("_id", terms).filter("term is not null").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return once.unionByName(twice).groupBy("term").agg(F.sum("df").alias("df"))


#: Terms whose document frequencies are broadcast, about 10 MB: the most frequent ones, if there are more.
NEAR_TERMS = 200_000


def _rare_idfs(docs: DataFrame, id_col: str, text_col: str):
    """``(_of, _terms, _weights)`` with the idf of a document's rare terms, and
    the function that scores its sentences with them.

    The ``NEAR_TERMS`` most frequent terms are broadcast. A term that is neither
    among them nor in its document's list stands in that document alone."""
    n = docs.count()
    found = cut_lineage(term_documents(docs, id_col, text_col))
    near = found.orderBy(F.col("df").desc(), "term").limit(NEAR_TERMS).collect()
    idf = lambda df: float(np.log((1 + n) / (1 + df)) + 1)
    table = docs.sparkSession.sparkContext.broadcast(([r.term for r in near], [idf(r.df) for r in near]))
    score = F.arrow_udf(_own_scorer(table, idf(1)), "int")
    if len(near) < NEAR_TERMS:
        nothing = docs.select(F.col(id_col).alias("_of"), F.lit(None).cast("array<string>").alias("_terms"),
                              F.lit(None).cast("array<double>").alias("_weights")).limit(0)
        return nothing, score
    last = near[-1]
    rare = found.filter((F.col("df") > 1) & ((F.col("df") < last.df) | ((F.col("df") == last.df) & (F.col("term") > last.term))))
    rare = rare.select("term", (F.log((F.lit(1) + n) / (F.lit(1) + F.col("df"))) + F.lit(1)).alias("_idf"))

    def others(terms: pa.Array) -> pa.Array:
        flat = terms.flatten().cast(pa.string())
        far = pc.invert(pc.is_in(flat, value_set=pa.array(table.value[0], pa.string())))
        sizes = _sizes(terms)
        kept = np.bincount(np.repeat(np.arange(len(terms)), sizes)[far.to_numpy(zero_copy_only=False)], minlength=len(terms))
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(kept)].astype(np.int32)), flat.filter(far))

    far = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_of"), F.explode_outer(
        F.arrow_udf(others, "array<string>")(F.array_distinct(tfidf_terms(text_col)))).alias("term")).filter("term is not null")
    own = far.join(rare, "term").groupBy("_of").agg(F.collect_list("term").alias("_terms"), F.collect_list("_idf").alias("_weights"))
    return own, score


def _own_scorer(table, alone: float):
    """As ``_best_sentences``, from idfs: a document's weights are made of the
    terms of its own sentences."""
    def scored(rows: pa.Array, terms: pa.Array, idfs: pa.Array) -> pa.Array:
        near, known = pa.array(table.value[0], pa.string()), np.array([*table.value[1], alone])
        parts = [np.zeros(0, np.int32)]
        for at in range(0, len(rows), _SCORED_ROWS):
            r, t, w = (x.slice(at, _SCORED_ROWS) for x in (rows, terms, idfs))
            said = r.flatten().flatten().flatten().cast(pa.string())
            words = pa.concat_arrays([t.flatten().cast(pa.string()), said]).dictionary_encode()
            span, codes = len(words.dictionary), words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            texts = r.flatten()
            doc = np.repeat(np.repeat(np.repeat(np.arange(len(r)), _sizes(r)), _sizes(texts)), _sizes(texts.flatten()))
            keys, tf = np.unique(doc * span + codes[len(codes) - len(said):], return_counts=True)
            place = pc.fill_null(pc.index_in(words.dictionary, value_set=near), len(near)).to_numpy(zero_copy_only=False)
            idf = known[place[keys % span]] if span else np.zeros(0)
            # A document's own list goes before.
            own = np.repeat(np.arange(len(r)), _sizes(t)) * span + codes[:len(codes) - len(said)]
            if len(own):
                order = np.argsort(own, kind="stable")
                where = np.searchsorted(own[order], keys).clip(max=len(own) - 1)
                idf = np.where(own[order][where] == keys, w.flatten().to_numpy(zero_copy_only=False)[order][where], idf)
            weight, of = tf * idf, keys // max(span, 1)
            weight = weight / np.sqrt(np.bincount(of, weight * weight, len(r)))[of]
            ends = pa.array(np.searchsorted(of, np.arange(len(r) + 1)).astype(np.int32))
            own_terms = words.dictionary.take(pa.array(keys % max(span, 1)))
            parts.append(_best(r, pa.ListArray.from_arrays(ends, own_terms), pa.ListArray.from_arrays(ends, pa.array(weight))))
        return pa.array(np.concatenate(parts))
    return scored


#: Documents scored at once, so that the arrays stay small.
_SCORED_ROWS = 500


def _best_sentences(rows: pa.Array, terms: pa.Array, weights: pa.Array) -> pa.Array:
    """Per document the place of the sentence with the highest mean weight."""
    parts = [_best(*(x.slice(at, _SCORED_ROWS) for x in (rows, terms, weights))) for at in range(0, len(rows), _SCORED_ROWS)]
    return pa.array(np.concatenate([np.zeros(0, np.int32), *parts]))


def _sizes(lists: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.list_value_length(lists), 0))


def _best(rows: pa.Array, terms: pa.Array, weights: pa.Array) -> np.ndarray:
    texts = rows.flatten()
    sentences = texts.flatten()
    doc = np.repeat(np.repeat(np.arange(len(rows)), _sizes(rows)), _sizes(texts))
    in_text = _sizes(texts)
    place = np.arange(len(sentences)) - np.repeat(np.cumsum(in_text) - in_text, in_text)
    said, known = sentences.flatten().cast(pa.string()), terms.flatten().cast(pa.string())
    codes = pa.concat_arrays([known, said]).dictionary_encode()
    span, codes = len(codes.dictionary), codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    of = np.repeat(np.arange(len(sentences)), _sizes(sentences))
    keys = np.repeat(np.arange(len(terms)), _sizes(terms)) * span + codes[:len(known)]
    order = np.argsort(keys, kind="stable")
    keys, value = keys[order], weights.flatten().to_numpy(zero_copy_only=False)[order]
    weight = np.zeros(len(said))
    if len(keys):
        asked = doc[of] * span + codes[len(known):]
        at = np.searchsorted(keys, asked).clip(max=len(keys) - 1)
        weight = np.where(keys[at] == asked, value[at], 0.0)
    # Sentences of one document and place are one: they come from rows with one id.
    wide = int(place.max(initial=0)) + 1
    group, back = np.unique((doc * wide + place)[of], return_inverse=True)
    # Rounded, so that sentences of one weight tie whatever the order of the sum.
    score = np.round(np.bincount(back, weight, len(group)) / np.bincount(back, minlength=len(group)), 9)
    out = np.zeros(len(rows), np.int32)
    first = np.lexsort((group % wide, -score, group // wide))
    docs, start = np.unique(group[first] // wide, return_index=True)
    out[docs] = group[first][start] % wide
    return out
