"""Exploratory queries: word/n-gram frequencies, top-k, balances."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import profile as P
from ..operators.reconcile import merge_versions
from ..sources.tables import versions
from . import sqltext as S
from .catalog import register


def merged_table(spark, sf):
    v1, v2 = versions(spark, sf)
    return merge_versions(v1, v2)


def _top_sql(tokens_sql: str, k: int = 20) -> str:
    return f"""WITH {S.HEADLINES},
t AS (SELECT is_sarcastic, version, row_id, {tokens_sql} AS toks FROM merged),
e AS (SELECT is_sarcastic, version, row_id, unnest(toks) AS word,
             unnest(generate_series(0, len(toks) - 1)) AS pos FROM t),
c AS (SELECT is_sarcastic, word, count(*) AS count, min((version, row_id, pos)) AS fs
      FROM e GROUP BY is_sarcastic, word)
SELECT is_sarcastic, CAST(rank AS BIGINT) AS rank, word, count
FROM (SELECT *, row_number() OVER (PARTITION BY is_sarcastic ORDER BY count DESC, fs) AS rank FROM c)
WHERE rank <= {k}"""


def _top(counts, k=20):
    return P.top_k(counts, ["is_sarcastic"], k).select(
        "is_sarcastic", F.col("rank").cast("bigint").alias("rank"), "word", "count")


@register("top_words_per_label", "U-03 T-07 A-11 W-02 K-01", _top_sql(S.filtered_tokens("headline")))
def top_words_per_label(spark, sf):
    """Flagship: merged versions -> filtered tokens -> top-20 words per label."""
    m = merged_table(spark, sf).withColumn("tokens", T.filtered_tokens("headline"))
    return _top(P.token_counts(m, "tokens", ["is_sarcastic"]))


@register("top_unigrams_per_label", "T-03 A-10 W-02 K-01", _top_sql(S.alpha_tokens("headline")))
def top_unigrams_per_label(spark, sf):
    """Alphabetic tokens, case and stopwords kept."""
    m = merged_table(spark, sf).withColumn("tokens", T.alpha_tokens("headline"))
    return _top(P.token_counts(m, "tokens", ["is_sarcastic"]))


def _bigram_sql(tokens_sql: str, table: str, group: str, ver: str, row: str, where: str = "") -> str:
    """Cross-row bigrams: the last token of a non-empty row pairs with the
    first token of the next non-empty row of the same group."""
    return f"""t AS (SELECT {group} AS g, {ver} AS version, {row} AS row_id, {tokens_sql} AS toks FROM {table} {where}),
ne AS (SELECT * FROM t WHERE len(toks) > 0),
w AS (SELECT *, lead(toks[1]) OVER (PARTITION BY g ORDER BY version, row_id) AS nxt FROM ne),
x AS (SELECT *, CASE WHEN nxt IS NULL THEN toks ELSE list_append(toks, nxt) END AS ext FROM w),
gr AS (SELECT g, version, row_id, i - 1 AS pos, ext[i] || ' ' || ext[i + 1] AS ngram
       FROM (SELECT *, unnest(generate_series(1, len(toks))) AS i FROM x) WHERE i + 1 <= len(ext)),
c AS (SELECT g, ngram, count(*) AS count, min((version, row_id, pos)) AS fs FROM gr GROUP BY g, ngram)"""


@register("bigram_counts", "W-01 A-12",
          f"WITH {S.HEADLINES}, " + _bigram_sql(S.filtered_tokens("headline"), "merged", "is_sarcastic",
                                                "version", "row_id")
          + " SELECT g AS is_sarcastic, ngram, count FROM c")
def bigram_counts(spark, sf):
    m = merged_table(spark, sf).withColumn("tokens", T.filtered_tokens("headline"))
    return P.ngram_counts(m, "tokens", ["is_sarcastic"], 2).select("is_sarcastic", "ngram", "count")


@register("top_bigrams_per_label", "W-01 W-02 A-12 K-01",
          f"WITH {S.HEADLINES}, " + _bigram_sql(S.filtered_tokens("headline"), "merged", "is_sarcastic",
                                                "version", "row_id")
          + """ SELECT g AS is_sarcastic, CAST(rank AS BIGINT) AS rank, ngram, count FROM
  (SELECT *, row_number() OVER (PARTITION BY g ORDER BY count DESC, fs) AS rank FROM c) WHERE rank <= 20""")
def top_bigrams_per_label(spark, sf):
    m = merged_table(spark, sf).withColumn("tokens", T.filtered_tokens("headline"))
    c = P.ngram_counts(m, "tokens", ["is_sarcastic"], 2)
    return P.top_k(c, ["is_sarcastic"], 20).select(
        "is_sarcastic", F.col("rank").cast("bigint").alias("rank"), "ngram", "count")


@register("conversation_bigrams", "W-01 A-12",
          "WITH " + _bigram_sql(S.filtered_tokens("text"), "conversations", "role", "conv_id", "turn")
          + " SELECT g AS role, ngram, count FROM c")
def conversation_bigrams(spark, sf):
    """The same stream operator over ordered turns: one stream per role,
    ordered by (conv_id, turn); blocks of 4 turns exercise the carry."""
    from ..sources.tables import read_table
    conv = read_table(spark, sf, "conversations", ["conv_id", "turn", "role", "text"]) \
        .withColumn("tokens", T.filtered_tokens("text"))
    c = P.ngram_counts(conv, "tokens", ["role"], 2, version_col="conv_id", row_col="turn", block_rows=4)
    return c.select("role", "ngram", "count")


@register("top_conversation_bigrams", "W-01 W-02 K-01",
          "WITH " + _bigram_sql(S.filtered_tokens("text"), "conversations", "role", "conv_id", "turn")
          + """ SELECT g AS role, CAST(rank AS BIGINT) AS rank, ngram, count FROM
  (SELECT *, row_number() OVER (PARTITION BY g ORDER BY count DESC, fs) AS rank FROM c) WHERE rank <= 20""")
def top_conversation_bigrams(spark, sf):
    from ..sources.tables import read_table
    conv = read_table(spark, sf, "conversations", ["conv_id", "turn", "role", "text"]) \
        .withColumn("tokens", T.filtered_tokens("text"))
    c = P.ngram_counts(conv, "tokens", ["role"], 2, version_col="conv_id", row_col="turn")
    return P.top_k(c, ["role"], 20).select("role", F.col("rank").cast("bigint").alias("rank"), "ngram", "count")


@register("row_bigram_counts", "W-01 A-12",
          f"""WITH {S.HEADLINES}, t AS (SELECT is_sarcastic, {S.filtered_tokens('headline')} AS toks FROM merged),
g AS (SELECT is_sarcastic, toks[i] || ' ' || toks[i + 1] AS ngram
      FROM (SELECT *, unnest(generate_series(1, len(toks) - 1)) AS i FROM t WHERE len(toks) > 1))
SELECT is_sarcastic, ngram, count(*) AS count FROM g GROUP BY ALL""")
def row_bigram_counts(spark, sf):
    m = merged_table(spark, sf).withColumn("tokens", T.filtered_tokens("headline"))
    return P.ngram_counts(m, "tokens", ["is_sarcastic"], 2, boundary="row").select(
        "is_sarcastic", "ngram", "count")


@register("length_caps", "A-15 F-01",
          f"SELECT CAST(floor(quantile_cont(wc, 0.995)) AS BIGINT) AS words_cap "
          f"FROM (SELECT {S.word_count('text')} AS wc FROM documents)")
def length_caps(spark, sf):
    from ..functions.features import word_count
    from ..sources.tables import read_table
    d = read_table(spark, sf, "documents", ["text"])
    return P.percentile_cap(d.select(word_count("text").alias("words")), ["words"])


@register("describe_headlines", "A-04",
          f"""WITH {S.HEADLINES},
num AS (SELECT 'row_id' AS column_name, CAST(row_id AS DOUBLE) AS v FROM h
        UNION ALL SELECT 'is_sarcastic', CAST(is_sarcastic AS DOUBLE) FROM h),
ns AS (SELECT column_name, count(v) AS count, CAST(NULL AS BIGINT) AS unique_count, CAST(NULL AS VARCHAR) AS top,
  CAST(NULL AS BIGINT) AS freq, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(min(v), 6) AS min,
  round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
  round(quantile_cont(v, 0.75), 6) AS q75, round(max(v), 6) AS max FROM num GROUP BY column_name),
vc AS (SELECT headline, count(*) AS c, min(row_id) AS fr FROM h WHERE headline IS NOT NULL GROUP BY headline),
st AS (SELECT 'headline' AS column_name, (SELECT count(headline) FROM h) AS count, (SELECT count(*) FROM vc) AS unique_count,
  (SELECT headline FROM vc ORDER BY c DESC, fr LIMIT 1) AS top, (SELECT max(c) FROM vc) AS freq,
  CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS q25,
  CAST(NULL AS DOUBLE) AS q50, CAST(NULL AS DOUBLE) AS q75, CAST(NULL AS DOUBLE) AS max)
SELECT * FROM ns UNION ALL SELECT * FROM st""")
def describe_headlines(spark, sf):
    from ..sources.tables import headlines
    return P.describe(headlines(spark, sf), ["row_id", "is_sarcastic"], ["headline"], order_col="row_id")


# ---- distributions behind the box plots, histograms and density curves ----

_BOX_FEATURES = ["headline_length", "all_caps_count", "punctuation_count"]


def _featured(spark, sf, names):
    from ..functions.features import with_features
    return with_features(merged_table(spark, sf), "headline", names)


def _long_sql(names) -> str:
    cols = ", ".join(f"CAST({S.FEATURES[n]('headline')} AS DOUBLE) AS {n}" for n in names)
    return f"""f AS (SELECT row_id, is_sarcastic, {cols} FROM merged),
l AS (UNPIVOT f ON {', '.join(names)} INTO NAME feature VALUE value)"""


@register("box_stats", "A-06 F-02 F-06 F-09",
          f"""WITH {S.HEADLINES}, {_long_sql(_BOX_FEATURES)},
q AS (SELECT feature, is_sarcastic, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.75) AS q3 FROM l GROUP BY ALL),
j AS (SELECT l.*, q1, median, q3, q3 - q1 AS iqr FROM l JOIN q USING (feature, is_sarcastic))
SELECT feature, is_sarcastic, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(iqr, 6) AS iqr, round(min(value) FILTER (WHERE value >= q1 - 1.5 * iqr), 6) AS whisker_low,
  round(max(value) FILTER (WHERE value <= q3 + 1.5 * iqr), 6) AS whisker_high,
  count(*) FILTER (WHERE value < q1 - 1.5 * iqr OR value > q3 + 1.5 * iqr) AS n_outliers, count(*) AS n
FROM j GROUP BY feature, is_sarcastic, q1, median, q3, iqr""")
def box_stats(spark, sf):
    from ..operators import distribution as D
    long = D.long_values(_featured(spark, sf, _BOX_FEATURES), _BOX_FEATURES, "is_sarcastic")
    # The three features are counts bounded by the text length.
    b = D.box_stats(long, ["feature", "is_sarcastic"], bounded_values=True)
    return b.select("feature", "is_sarcastic", *[F.round(c, 6).alias(c) for c in
                    ["q1", "median", "q3", "iqr", "whisker_low", "whisker_high"]], "n_outliers", "n")


@register("box_outliers", "A-07",
          f"""WITH {S.HEADLINES}, {_long_sql(_BOX_FEATURES)},
q AS (SELECT feature, is_sarcastic, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM l GROUP BY ALL)
SELECT row_id, is_sarcastic, feature, value FROM l JOIN q USING (feature, is_sarcastic)
WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def box_outliers(spark, sf):
    from ..operators import distribution as D
    long = D.long_values(_featured(spark, sf, _BOX_FEATURES), _BOX_FEATURES, "is_sarcastic")
    return D.outliers(long, ["feature", "is_sarcastic"], bounded_values=True) \
        .select("row_id", "is_sarcastic", "feature", "value")


_AWL = f"""a AS (SELECT row_id, is_sarcastic, {S.avg_word_length('headline')} AS value FROM merged),
l AS (SELECT * FROM a WHERE value IS NOT NULL),
st0 AS (SELECT is_sarcastic, count(*) AS n, min(value) AS vmin, max(value) AS vmax, stddev_samp(value) AS sd,
  quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM l GROUP BY is_sarcastic)"""


@register("word_length_histogram", "A-08 F-10",
          f"""WITH {S.HEADLINES}, {_AWL},
st1 AS (SELECT *, 2 * (q3 - q1) / pow(CAST(n AS DOUBLE), 1.0 / 3.0) AS h FROM st0),
st2 AS (SELECT *, CAST(greatest(least(CASE WHEN n < 2 THEN 1 WHEN h = 0 THEN floor(sqrt(CAST(n AS DOUBLE)))
  ELSE ceil((vmax - vmin) / h) END, 50), 1) AS INTEGER) AS bins FROM st1),
st AS (SELECT *, CASE WHEN vmax > vmin THEN vmin ELSE vmin - 0.5 END AS lo,
  CASE WHEN vmax > vmin THEN vmax ELSE vmax + 0.5 END AS hi FROM st2),
sw AS (SELECT *, (hi - lo) / bins AS width FROM st),
c AS (SELECT l.is_sarcastic, CAST(least(floor((value - lo) / width), bins - 1) AS INTEGER) AS bin, count(*) AS cnt
  FROM l JOIN sw USING (is_sarcastic) GROUP BY ALL),
g AS (SELECT is_sarcastic, n, lo, width, unnest(generate_series(0, bins - 1)) AS bin FROM sw)
SELECT g.is_sarcastic, CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * width, 6) AS bin_start,
  round(lo + (g.bin + 1) * width, 6) AS bin_end, CAST(coalesce(cnt, 0) AS BIGINT) AS count,
  round(coalesce(cnt, 0) / (n * width), 6) AS density
FROM g LEFT JOIN c ON c.is_sarcastic = g.is_sarcastic AND c.bin = g.bin""")
def word_length_histogram(spark, sf):
    from ..functions.features import avg_word_length
    from ..operators import distribution as D
    m = merged_table(spark, sf).select("row_id", "is_sarcastic", avg_word_length("headline").alias("value")) \
        .filter(F.col("value").isNotNull())
    h = D.histogram(m, ["is_sarcastic"])
    return h.select("is_sarcastic", F.col("bin").cast("int").alias("bin"),
                    *[F.round(c, 6).alias(c) for c in ["bin_start", "bin_end"]], "count",
                    F.round("density", 6).alias("density"))


@register("word_length_density", "A-09 F-10",
          f"""WITH {S.HEADLINES}, {_AWL},
st AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw FROM st0 WHERE sd > 0),
sd2 AS (SELECT *, vmin - 3.0 * bw AS lo, (vmax + 3.0 * bw - (vmin - 3.0 * bw)) / 199 AS delta FROM st),
p AS (SELECT l.is_sarcastic, (value - lo) / delta AS pos FROM l JOIN sd2 USING (is_sarcastic)),
b0 AS (SELECT is_sarcastic, CAST(floor(pos) AS INTEGER) AS j, 1 - (pos - floor(pos)) AS c FROM p
  UNION ALL SELECT is_sarcastic, CAST(floor(pos) AS INTEGER) + 1, pos - floor(pos) FROM p),
b AS (SELECT is_sarcastic, j, sum(c) AS c FROM b0 GROUP BY ALL),
g AS (SELECT is_sarcastic, n, bw, lo, delta, unnest(generate_series(0, 199)) AS k FROM sd2)
SELECT g.is_sarcastic, CAST(k AS INTEGER) AS k, round(lo + k * delta, 6) AS x,
  round(sum(b.c * exp(-0.5 * pow((k - b.j) * delta / bw, 2))) / (n * bw * sqrt(2 * pi())), 6) AS density
FROM g JOIN b ON b.is_sarcastic = g.is_sarcastic GROUP BY g.is_sarcastic, k, n, bw, lo, delta""")
def word_length_density(spark, sf):
    from ..functions.features import avg_word_length
    from ..operators import distribution as D
    m = merged_table(spark, sf).select("row_id", "is_sarcastic", avg_word_length("headline").alias("value")) \
        .filter(F.col("value").isNotNull())
    k = D.kde(m, ["is_sarcastic"])
    return k.select("is_sarcastic", F.col("k").cast("int").alias("k"), F.round("x", 6).alias("x"),
                    F.round("density", 6).alias("density"))
