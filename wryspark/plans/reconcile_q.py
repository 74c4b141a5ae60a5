"""Version reconciliation queries: Q-*, J-01, J-02, J-04, U-*, A-01..A-03."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import profile as P
from ..operators import reconcile as R
from ..operators import sketches as SK
from ..sources import files as FS
from ..sources.tables import documents, headlines, read_table, versions
from . import sqltext as S
from .catalog import register

H = S.HEADLINES


@register("labelled_headlines", "S-06 J-04 Q-01", f"WITH {H} SELECT row_id, headline, is_sarcastic FROM h")
def labelled_headlines(spark, sf):
    return headlines(spark, sf)


@register("merged_versions", "Q-03 J-01 U-01 U-03",
          f"WITH {H} SELECT row_id, headline, is_sarcastic, version FROM merged")
def merged_versions(spark, sf):
    v1, v2 = versions(spark, sf)
    return R.merge_versions(v1, v2)


@register("merge_summary", "U-03 Q-07 A-01",
          f"""WITH {H}, c AS (SELECT is_sarcastic, count(*) AS count FROM merged GROUP BY is_sarcastic)
SELECT is_sarcastic, count, count / sum(count) OVER () AS share, CAST(sum(count) OVER () AS BIGINT) AS n_rows FROM c""")
def merge_summary(spark, sf):
    v1, v2 = versions(spark, sf)
    m = R.merge_versions(v1, v2)
    bal = P.class_balance(m)
    return bal.withColumn("n_rows", F.sum("count").over(Window.partitionBy()))


@register("version_balance", "A-01 Q-02",
          f"""WITH {H}, c AS (SELECT 1 AS version, is_sarcastic, count(*) AS count FROM v1 GROUP BY ALL
  UNION ALL SELECT 2, is_sarcastic, count(*) FROM v2 GROUP BY ALL)
SELECT version, is_sarcastic, count, count / sum(count) OVER (PARTITION BY version) AS share FROM c""")
def version_balance(spark, sf):
    v1, v2 = versions(spark, sf)
    both = R.bag_union(v1.withColumn("version", F.lit(1)), v2.withColumn("version", F.lit(2)))
    c = both.groupBy("version", "is_sarcastic").agg(F.count(F.lit(1)).alias("count"))
    return c.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy("version")))


@register("class_counts", "A-02", f"WITH {H} SELECT is_sarcastic, count(*) AS count FROM merged GROUP BY ALL")
def class_counts(spark, sf):
    v1, v2 = versions(spark, sf)
    return P.class_counts(R.merge_versions(v1, v2))


@register("distinct_headlines", "A-03 U-02",
          f"""WITH {H} SELECT (SELECT count(DISTINCT headline) FROM v1) AS unique_v1,
  (SELECT count(DISTINCT headline) FROM v2) AS unique_v2,
  (SELECT count(*) FROM (SELECT headline FROM v1 INTERSECT SELECT headline FROM v2)) AS common""")
def distinct_headlines(spark, sf):
    """One shuffle by headline: per headline, which versions hold it; then
    three sums. Map-side partial aggregation absorbs a hot headline."""
    v1, v2 = versions(spark, sf)
    both = R.bag_union(v1.withColumn("version", F.lit(1)), v2.withColumn("version", F.lit(2)))
    per = both.filter(F.col("headline").isNotNull()).groupBy("headline").agg(
        F.max((F.col("version") == 1).cast("int")).alias("in1"),
        F.max((F.col("version") == 2).cast("int")).alias("in2"))
    return per.agg(F.sum("in1").cast("bigint").alias("unique_v1"),
                   F.sum("in2").cast("bigint").alias("unique_v2"),
                   F.sum(F.col("in1") * F.col("in2")).cast("bigint").alias("common"))


@register("sketched_headlines", "A-03 U-02", f"""WITH {H}
SELECT 'distinct' AS kind, '1' AS versions, count(DISTINCT headline) AS n FROM v1
UNION ALL SELECT 'distinct', '2', count(DISTINCT headline) FROM v2
UNION ALL SELECT 'union', '1+2', count(DISTINCT headline) FROM (SELECT headline FROM v1 UNION ALL SELECT headline FROM v2)
UNION ALL SELECT 'common', '1&2', count(*) FROM (SELECT headline FROM v1 INTERSECT SELECT headline FROM v2)""")
def sketched_headlines(spark, sf):
    """Distinct and common headlines from stored sketches, version 2 added to
    the table after version 1; exact up to 65,536 different headlines."""
    path = FS.scratch_path(spark, "sketches")
    for name, rows in zip("12", versions(spark, sf)):
        SK.store_sketches(rows.withColumn("version", F.lit(name)), "version", "headline", path)
    return SK.stored_distinct(spark, path, ["1", "2"])


@register("common_documents", "U-02",
          """SELECT text FROM documents WHERE doc_id % 2 = 0 INTERSECT SELECT text FROM documents WHERE doc_id % 2 = 1""")
def common_documents(spark, sf):
    d = documents(spark, sf)
    return R.common_distinct(d.filter("doc_id % 2 = 0"), d.filter("doc_id % 2 = 1"), "text")


@register("documents_anti_join", "J-01 Q-04",
          """SELECT o.doc_id, o.text FROM documents o WHERE o.doc_id % 2 = 1
  AND NOT EXISTS (SELECT 1 FROM documents e WHERE e.doc_id % 2 = 0 AND e.text = o.text)""")
def documents_anti_join(spark, sf):
    d = documents(spark, sf)
    return R.anti_join(d.filter("doc_id % 2 = 1"), d.filter("doc_id % 2 = 0"), "text")


@register("documents_semi_join", "J-02",
          """SELECT o.doc_id, o.text FROM documents o WHERE o.doc_id % 2 = 1
  AND EXISTS (SELECT 1 FROM documents e WHERE e.doc_id % 2 = 0 AND e.text = o.text)""")
def documents_semi_join(spark, sf):
    d = documents(spark, sf)
    return R.semi_join(d.filter("doc_id % 2 = 1"), d.filter("doc_id % 2 = 0"), "text")


@register("benchmark_overlap", "U-02 U-04 J-02",
          """SELECT 'intersect' AS kind, count(*) AS n FROM (SELECT text FROM documents INTERSECT SELECT text FROM benchmark)
UNION ALL SELECT 'benchmark_only', count(*) FROM (SELECT text FROM benchmark EXCEPT SELECT text FROM documents)
UNION ALL SELECT 'documents_only', count(*) FROM (SELECT text FROM documents EXCEPT SELECT text FROM benchmark)""")
def benchmark_overlap(spark, sf):
    d = documents(spark, sf).select("text")
    b = read_table(spark, sf, "benchmark", ["text"])
    def n(df, kind):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")
    return R.bag_union(n(R.common_distinct(d, b, "text"), "intersect"),
                       n(R.except_distinct(b, d, "text"), "benchmark_only"),
                       n(R.except_distinct(d, b, "text"), "documents_only"))


@register("except_audit", "U-04",
          f"""WITH {H} SELECT headline FROM v2 EXCEPT SELECT headline FROM v1""")
def except_audit(spark, sf):
    v1, v2 = versions(spark, sf)
    return R.except_distinct(v2, v1)


@register("sarcastic_rows", "Q-02 Q-01 Q-10",
          f"""WITH {H} SELECT row_id, headline, is_sarcastic, '' AS body FROM
  (SELECT * FROM v1 UNION ALL SELECT * FROM v2) WHERE is_sarcastic = 1""")
def sarcastic_rows(spark, sf):
    v1, v2 = versions(spark, sf)
    u = R.bag_union(v1, v2.select("is_sarcastic", "headline", "row_id"))
    return R.constant_column(R.label_filter(u, "is_sarcastic", 1), "body", "")


@register("head_preview", "Q-06", f"WITH {H} SELECT * FROM merged ORDER BY version, row_id LIMIT 5")
def head_preview(spark, sf):
    v1, v2 = versions(spark, sf)
    return R.merge_versions(v1, v2).orderBy("version", "row_id").limit(5)


@register("shape_report", "Q-07", f"WITH {H} SELECT count(*) AS n_rows, CAST(4 AS BIGINT) AS n_columns FROM merged")
def shape_report(spark, sf):
    v1, v2 = versions(spark, sf)
    return R.shape(R.merge_versions(v1, v2))


@register("keyed_lookup", "Q-09 J-02",
          f"""WITH {H} SELECT h.row_id, h.headline, h.is_sarcastic FROM h
  WHERE h.row_id IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def keyed_lookup(spark, sf):
    keys = read_table(spark, sf, "labels", ["doc_id", "quality"]).filter("quality = 1") \
        .select(F.col("doc_id").alias("row_id"))
    return R.lookup(headlines(spark, sf), keys)


@register("class_names", "Q-11",
          f"""WITH {H} SELECT row_id, CASE WHEN is_sarcastic = 1 THEN 'Sarcastic'
  WHEN is_sarcastic = 0 THEN 'Non Sarcastic' END AS class_name FROM h""")
def class_names(spark, sf):
    return headlines(spark, sf).select("row_id", R.class_name("is_sarcastic").alias("class_name"))
