"""Row-function queries over whole tables: T-01..T-07, T-12, T-14, F-01..F-10, A-05."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as FT
from ..functions import text as T
from ..operators import profile as P
from ..operators.reconcile import merge_versions
from ..sources.tables import documents, pages, versions
from . import sqltext as S
from .catalog import register


@register("clean_text", "T-01 T-02",
          f"SELECT doc_id, {S.clean('text')} AS cleaned, {S.letters_only('text')} AS letters FROM documents")
def clean_text(spark, sf):
    return documents(spark, sf).select("doc_id", T.clean("text").alias("cleaned"),
                                       T.letters_only("text").alias("letters"))


@register("token_arrays", "T-03 T-04 T-05 T-07",
          f"""SELECT doc_id, {S.ws_tokens('text')} AS ws_tokens, {S.word_tokens('text')} AS word_tokens,
  {S.alpha_tokens('text')} AS alpha_tokens, {S.filtered_tokens('text')} AS filtered_tokens FROM documents""")
def token_arrays(spark, sf):
    # Each list is made from the one before, so that a text is tokenised once.
    rows = documents(spark, sf).select("doc_id", T.ws_tokens("text").alias("ws_tokens"), T.word_tokens("text").alias("word_tokens"))
    return rows.withColumn("alpha_tokens", T.alphabetic("word_tokens")).withColumn("filtered_tokens", T.filtered("alpha_tokens"))


@register("stopword_text", "T-06 T-12",
          f"""SELECT doc_id, {S.drop_stopwords_text('text', True)} AS no_stop_exact,
  {S.drop_stopwords_text('text', False)} AS no_stop_lower,
  {S.drop_stopwords_text(S.letters_only('text'), True)} AS letters_no_stop FROM documents""")
def stopword_text(spark, sf):
    return documents(spark, sf).select(
        "doc_id", T.drop_stopwords_text("text", case_sensitive=True).alias("no_stop_exact"),
        T.drop_stopwords_text("text", case_sensitive=False).alias("no_stop_lower"),
        T.drop_stopwords_text(T.letters_only("text"), case_sensitive=True).alias("letters_no_stop"))


_FEATS = ["word_count", "char_count", "exclamation_mark", "question_mark", "ascii_punct_count",
          "punctuation_count", "multiple_punct_count", "large_number_flag", "all_caps_count",
          "avg_word_length"]


@register("text_features", "F-01 F-02 F-03 F-04 F-05 F-06 F-07 F-08 F-09 F-10 V-01",
          "SELECT doc_id, " + ", ".join(
              (f"round({S.FEATURES[n]('text')}, 6) AS {n}" if n == "avg_word_length"
               else f"{S.FEATURES[n]('text')} AS {n}") for n in _FEATS) + " FROM documents")
def text_features(spark, sf):
    d = FT.with_features(documents(spark, sf), "text", _FEATS)
    return d.select("doc_id", *[F.round(n, 6).alias(n) if n == "avg_word_length" else F.col(n)
                                for n in _FEATS])


@register("link_suffix", "T-14", "SELECT page_id, substring(url, 31) AS link_tail FROM pages")
def link_suffix(spark, sf):
    return pages(spark, sf).select("page_id", T.strip_link_prefix("url").alias("link_tail"))


_COUNTED = ["exclamation_mark", "question_mark", "multiple_punct_count", "large_number_flag"]


@register("feature_label_counts", "A-05 F-03 F-04 F-07 F-08",
          f"""WITH {S.HEADLINES}, f AS (SELECT is_sarcastic, """ + ", ".join(
              f"{S.FEATURES[n]('headline')} AS {n}" for n in _COUNTED) + """ FROM merged),
u AS (UNPIVOT f ON """ + ", ".join(_COUNTED) + """ INTO NAME feature VALUE value)
SELECT feature, value, is_sarcastic, count(*) AS count FROM u GROUP BY ALL""")
def feature_label_counts(spark, sf):
    v1, v2 = versions(spark, sf)
    m = FT.with_features(merge_versions(v1, v2), "headline", _COUNTED)
    return P.feature_label_counts(m, _COUNTED, "is_sarcastic")
