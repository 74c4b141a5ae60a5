"""Split and sampling queries: P-01..P-08, K-05, W-03, Q-05, Q-08, M-08."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reconcile as R
from ..operators import split as SP
from ..sources.tables import documents, headlines, versions
from . import sqltext as S
from .catalog import register

H = S.HEADLINES


def _hash(key: str, seed: int = 42) -> str:
    return f"md5(CAST({key} AS VARCHAR) || '-{seed}')"


@register("seeded_shuffle", "K-05 P-03 Q-08",
          f"SELECT doc_id, CAST(row_number() OVER (ORDER BY {_hash('doc_id')}, doc_id) - 1 AS BIGINT) AS idx "
          "FROM documents")
def seeded_shuffle(spark, sf):
    return SP.shuffled(documents(spark, sf, ["doc_id"]), "doc_id")


@register("dense_row_numbers", "Q-08",
          f"WITH {H} SELECT row_id, version, CAST(row_number() OVER (ORDER BY version, row_id) - 1 AS BIGINT) AS idx "
          "FROM merged")
def dense_row_numbers(spark, sf):
    from ..operators.ordering import dense_index
    v1, v2 = versions(spark, sf)
    m = R.merge_versions(v1, v2).select("row_id", "version")
    return dense_index(m, ["version", "row_id"], [], "idx")


@register("random_split", "P-01",
          f"""WITH {H}, o AS (SELECT row_id, row_number() OVER (ORDER BY {_hash('row_id')}, row_id) - 1 AS i,
  count(*) OVER () AS n FROM h)
SELECT row_id, CASE WHEN i < ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM o""")
def random_split(spark, sf):
    return SP.random_split(headlines(spark, sf).select("row_id"), 0.2)


@register("stratified_split", "P-02",
          f"""WITH {H}, o AS (SELECT row_id, is_sarcastic,
  row_number() OVER (PARTITION BY is_sarcastic ORDER BY {_hash('row_id')}, row_id) - 1 AS i,
  count(*) OVER (PARTITION BY is_sarcastic) AS n FROM h)
SELECT row_id, is_sarcastic, CASE WHEN i < ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM o""")
def stratified_split(spark, sf):
    return SP.random_split(headlines(spark, sf).select("row_id", "is_sarcastic"), 0.2,
                           group_cols=["is_sarcastic"])


@register("long_text_slices", "Q-05 P-04 W-03",
          f"""WITH f AS (SELECT doc_id FROM documents WHERE {S.word_count('text')} > 30),
o AS (SELECT doc_id, row_number() OVER (ORDER BY {_hash('doc_id')}, doc_id) - 1 AS i, count(*) OVER () AS n FROM f),
b AS (SELECT *, floor(CAST(0.8 AS DOUBLE) * n) AS b1, floor((CAST(0.8 AS DOUBLE) + CAST(0.1 AS DOUBLE)) * n) AS b2,
  floor((CAST(0.8 AS DOUBLE) + CAST(0.1 AS DOUBLE) + CAST(0.1 AS DOUBLE)) * n) AS b3 FROM o)
SELECT doc_id, CASE WHEN i < b1 THEN 'train' WHEN i < b2 THEN 'val' ELSE 'test' END AS split FROM b WHERE i < b3""")
def long_text_slices(spark, sf):
    d = R.word_count_filter(documents(spark, sf), "text", 30, keep_long=True).select("doc_id")
    return SP.ordered_slices(d, {"train": 0.8, "val": 0.1, "test": 0.1}, "doc_id")


@register("short_texts", "Q-05",
          f"SELECT doc_id, n_chars FROM documents WHERE {S.word_count('text')} <= 30")
def short_texts(spark, sf):
    d = documents(spark, sf, ["doc_id", "text", "n_chars"])
    return R.word_count_filter(d, "text", 30, keep_long=False).select("doc_id", "n_chars")


@register("text_hash_split", "P-05",
          "SELECT doc_id, CASE WHEN md5(text) < 'cccccccc' THEN 'train' ELSE 'test' END AS split FROM documents")
def text_hash_split(spark, sf):
    return SP.hash_split(documents(spark, sf), "text").select("doc_id", "split")


@register("seeded_sample", "P-06 P-07 P-08",
          f"SELECT doc_id, text FROM documents ORDER BY {_hash('doc_id', 7)}, doc_id LIMIT 3")
def seeded_sample(spark, sf):
    return SP.sample_rows(documents(spark, sf), 3, "doc_id", seed=7)


@register("split_leakage", "M-08 U-01 P-01 P-05",
          f"""WITH {H}, u AS (SELECT row_id, headline FROM v1 UNION ALL SELECT row_id, headline FROM v2),
o AS (SELECT headline, row_number() OVER (ORDER BY {_hash('row_id')}, row_id) - 1 AS i, count(*) OVER () AS n FROM u),
s AS (SELECT headline, CASE WHEN i < ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM o),
t AS (SELECT headline, CASE WHEN md5(headline) < 'cccccccc' THEN 'train' ELSE 'test' END AS split FROM u)
SELECT 'random' AS method, CAST(count(*) AS BIGINT) AS leaked_texts FROM (SELECT headline FROM s GROUP BY headline
  HAVING max(split = 'train') AND max(split = 'test'))
UNION ALL SELECT 'text_hash', CAST(count(*) AS BIGINT) FROM (SELECT headline FROM t GROUP BY headline
  HAVING max(split = 'train') AND max(split = 'test'))""")
def split_leakage(spark, sf):
    v1, v2 = versions(spark, sf)
    u = R.bag_union(v1, v2).select("row_id", "headline")
    rnd = SP.leakage(SP.random_split(u, 0.2), "headline").select(F.lit("random").alias("method"), "leaked_texts")
    hsh = SP.leakage(SP.hash_split(u, "headline"), "headline").select(
        F.lit("text_hash").alias("method"), "leaked_texts")
    return rnd.unionByName(hsh)
