"""Encoding queries: E-01..E-04, A-16, K-02."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode as EN
from ..operators.reconcile import merge_versions
from ..sources.tables import documents, versions
from . import sqltext as S
from .catalog import register

TERMS = f"regexp_extract_all(lower(headline), {S.q(EN.TERM_PATTERN)})"


def _terms_sql() -> str:
    return f"""{S.HEADLINES},
t AS (SELECT row_id, {TERMS} AS terms FROM merged),
tt AS (SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(terms) AS term FROM t) GROUP BY ALL)"""


def _tfidf_sql(capped: bool) -> str:
    vocab = """, v AS (SELECT term FROM (SELECT term, sum(tf) AS s FROM tt GROUP BY term) ORDER BY s DESC, term LIMIT 5000),
tv AS (SELECT tt.* FROM tt JOIN v USING (term))""" if capped else ", tv AS (SELECT * FROM tt)"
    return f"""WITH {_terms_sql()}{vocab},
n AS (SELECT count(*) AS n FROM merged),
d AS (SELECT term, count(*) AS df FROM tv GROUP BY term),
w AS (SELECT row_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM tv JOIN d USING (term), n)
SELECT row_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY row_id)), 6) AS weight FROM w"""


def _merged(spark, sf):
    v1, v2 = versions(spark, sf)
    return merge_versions(v1, v2)


@register("tfidf_weights", "E-01 A-16", _tfidf_sql(False))
def tfidf_weights(spark, sf):
    t = EN.tfidf_long(_merged(spark, sf), "headline")
    return t.select("row_id", "term", F.round("weight", 6).alias("weight"))


@register("tfidf_weights_capped", "E-01 K-02", _tfidf_sql(True))
def tfidf_weights_capped(spark, sf):
    t = EN.tfidf_long(_merged(spark, sf), "headline", max_features=5000)
    return t.select("row_id", "term", F.round("weight", 6).alias("weight"))


@register("term_frequencies", "A-16",
          f"WITH {_terms_sql()} SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM tt GROUP BY term")
def term_frequencies(spark, sf):
    return EN.doc_freq(EN.term_table(_merged(spark, sf), "headline"))


@register("vocabulary_top", "K-02",
          f"""WITH {_terms_sql()} SELECT term, CAST(sum(tf) AS BIGINT) AS tf FROM tt GROUP BY term
ORDER BY tf DESC, term LIMIT 5000""")
def vocabulary_top(spark, sf):
    t = EN.doc_freq(EN.term_table(_merged(spark, sf), "headline"))
    return t.orderBy(F.col("tf").desc(), "term").limit(5000).select("term", F.col("tf").cast("bigint").alias("tf"))


SEQ_TOKENS = (f"list_filter(string_split(regexp_replace(lower(text), {S.q(EN.SEQUENCE_CLASS)}, ' ', 'g'), ' '), "
              "lambda w: w <> '')")

_SEQ_SQL = f"""WITH t AS (SELECT doc_id, {SEQ_TOKENS} AS toks FROM documents),
e AS (SELECT doc_id, unnest(toks) AS word, unnest(generate_series(0, len(toks) - 1)) AS pos FROM t),
c AS (SELECT word, count(*) AS cnt, min((doc_id, pos)) AS fs FROM e GROUP BY word),
v AS (SELECT word, id FROM (SELECT word, row_number() OVER (ORDER BY cnt DESC, fs) + 1 AS id FROM c) WHERE id < 10000),
s AS (SELECT e.doc_id, list(CAST(coalesce(v.id, 1) AS INTEGER) ORDER BY e.pos) AS ids
      FROM e LEFT JOIN v ON e.word = v.word GROUP BY e.doc_id),
q AS (SELECT t.doc_id, coalesce(s.ids, CAST([] AS INTEGER[])) AS ids FROM t LEFT JOIN s ON t.doc_id = s.doc_id)"""


@register("word_sequences", "E-02 E-03 J-05",
          _SEQ_SQL + " SELECT doc_id, ids, list_resize(ids, 120, 0) AS padded FROM q")
def word_sequences(spark, sf):
    d = documents(spark, sf).withColumn("toks", EN.sequence_tokens("text"))
    vocab = EN.word_index(d, "toks", 10000, id_col="doc_id")
    seq = EN.to_sequences(d, "toks", vocab, id_col="doc_id")
    return seq.select("doc_id", "ids", EN.pad("ids", 120).alias("padded"))


@register("marked_sequences", "E-04 E-02",
          _SEQ_SQL + """, m AS (SELECT doc_id, list_resize(list_concat([10000], list_slice(ids, 1, 126), [10001]), 128, 0) AS input_ids FROM q)
SELECT doc_id, input_ids, list_transform(input_ids, lambda x: CAST(x <> 0 AS INTEGER)) AS attention_mask FROM m""")
def marked_sequences(spark, sf):
    d = documents(spark, sf).withColumn("toks", EN.sequence_tokens("text"))
    vocab = EN.word_index(d, "toks", 10000, id_col="doc_id")
    seq = EN.to_sequences(d, "toks", vocab, id_col="doc_id")
    ids, mask = EN.with_markers("ids", 128, 10000, 10001)
    return seq.select("doc_id", ids.alias("input_ids"), mask.alias("attention_mask"))
