"""Lexicon queries: T-08, T-10, F-11, F-12, A-13, A-14."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as FT
from ..functions import text as T
from ..functions.regex import WORD
from ..functions.wordlists import ENGLISH_STOPWORDS
from ..operators import lexicon as LX
from ..operators import profile as P
from ..operators.encode import TERM_PATTERN, tfidf_long
from ..operators.reconcile import merge_versions
from ..sources.tables import versions
from . import sqltext as S
from .catalog import register


def _merged(spark, sf):
    v1, v2 = versions(spark, sf)
    return merge_versions(v1, v2)


def _lemma_frame(spark, sf):
    m = _merged(spark, sf).withColumn("cleaned", T.clean("headline")).withColumn("toks", T.ws_tokens("cleaned"))
    return m, LX.lemmatize(m, "row_id", "toks", "lemmatized_headline")


def _vals(rows, cols: str) -> str:
    body = ", ".join("(" + ", ".join(S.q(v) if isinstance(v, str) else f"CAST({v!r} AS DOUBLE)" for v in r) + ")"
                     for r in rows)
    return f"(SELECT * FROM (VALUES {body}) v({cols}))"


def _tag_sql(w: str) -> str:
    return (f"CASE WHEN suffix({w}, 'ly') THEN 'r' WHEN suffix({w}, 'ing') OR suffix({w}, 'ed') THEN 'v' "
            f"WHEN suffix({w}, 'ous') OR suffix({w}, 'ful') OR suffix({w}, 'ive') THEN 'a' ELSE 'n' END")


# Words of the four languages that stand before a noun, and before a verb.
BEFORE_NOUN = ["the", "a", "an", "der", "die", "das", "le", "la", "les", "el", "los"]
BEFORE_VERB = ["to", "will", "zu", "que", "ne"]

_CONTEXT = f"""cx AS (SELECT lower(word) AS word, lower(lag(word) OVER (PARTITION BY row_id ORDER BY pos)) AS prior FROM e),
ct AS (SELECT word, CASE WHEN 2 * count(*) FILTER (WHERE prior IN ({', '.join(map(S.q, BEFORE_NOUN))})) >= count(*) THEN 'n' ELSE 'v' END AS tag
  FROM cx WHERE prior IN ({', '.join(map(S.q, BEFORE_NOUN + BEFORE_VERB))}) GROUP BY word),
"""


def _lemma_sql(noun: bool = False, tags: bool = False) -> str:
    rules = []
    tag_of = (lambda w: "'n'") if noun else (lambda w: f"coalesce(ct.tag, {_tag_sql(w)})") if tags else _tag_sql
    for tag, rs in LX.RULES.items():
        for s, r in rs:
            rules.append(f"SELECT word, tag, left(word, length(word) - {len(s)}) || {S.q(r)} AS form FROM w "
                         f"WHERE tag = '{tag}' AND suffix(word, {S.q(s)}) AND length(word) > {len(s)}")
    return f"""{S.HEADLINES},
t AS (SELECT row_id, {S.ws_tokens(S.clean('headline'))} AS toks FROM merged),
e AS (SELECT row_id, unnest(toks) AS word, unnest(generate_series(0, len(toks) - 1)) AS pos FROM t),
{_CONTEXT if tags else ""}tg AS (SELECT e.*, {tag_of('e.word')} AS tag FROM e {"LEFT JOIN ct ON ct.word = e.word" if tags else ""}),
vocab AS (SELECT DISTINCT word FROM e),
w AS (SELECT DISTINCT word, tag FROM tg),
c AS (SELECT word, tag, word AS form FROM w UNION ALL {' UNION ALL '.join(rules)}),
exc AS {_vals(LX.DEFAULT_EXCEPTIONS, 'word, tag, lemma')},
allc AS (SELECT word, tag, form FROM c WHERE form IN (SELECT word FROM vocab)
  UNION ALL SELECT w.word, w.tag, exc.lemma FROM w JOIN exc ON exc.word = w.word AND exc.tag = w.tag),
lem AS (SELECT word, tag, (min({{'n': length(form), 'f': form}})).f AS lemma FROM allc GROUP BY word, tag),
tl AS (SELECT tg.row_id, tg.pos, coalesce(lem.lemma, tg.word) AS lemma FROM tg LEFT JOIN lem
  ON lem.word = tg.word AND lem.tag = tg.tag),
lt AS (SELECT m.row_id, m.is_sarcastic, coalesce((SELECT string_agg(lemma, ' ' ORDER BY pos) FROM tl
  WHERE tl.row_id = m.row_id), '') AS lemmatized_headline FROM merged m)"""


@register("lemmatized_text", "T-08 T-10 T-01 J-05",
          f"WITH {_lemma_sql()} SELECT row_id, lemmatized_headline FROM lt")
def lemmatized_text(spark, sf):
    _, lem = _lemma_frame(spark, sf)
    return lem


@register("lemmatized_text_noun", "T-08",
          f"WITH {_lemma_sql(noun=True)} SELECT row_id, lemmatized_headline FROM lt")
def lemmatized_text_noun(spark, sf):
    """Every word taken as a noun."""
    m = _merged(spark, sf).withColumn("toks", T.ws_tokens(T.clean("headline")))
    return LX.lemmatize(m, "row_id", "toks", "lemmatized_headline", pos_mode=False)


@register("context_tagged_lemmas", "T-10 T-08",
          f"WITH {_lemma_sql(tags=True)} SELECT row_id, lemmatized_headline FROM lt")
def context_tagged_lemmas(spark, sf):
    """Lemmas by a tag table made from the words' company in the same texts;
    the suffix rule has the words that the table lacks."""
    m = _merged(spark, sf).withColumn("toks", T.ws_tokens(T.clean("headline")))
    tags = LX.context_tags(m, "toks", BEFORE_NOUN, BEFORE_VERB)
    return LX.lemmatize(m, "row_id", "toks", "lemmatized_headline", tags=tags)


@register("tfidf_lemmatised", "E-01 T-08", f"""WITH {_lemma_sql()},
tt AS (SELECT row_id, term, count(*) AS tf FROM (SELECT row_id,
  unnest(regexp_extract_all(lower(lemmatized_headline), {S.q(TERM_PATTERN)})) AS term FROM lt) GROUP BY ALL),
n AS (SELECT count(*) AS n FROM lt),
d AS (SELECT term, count(*) AS df FROM tt GROUP BY term),
x AS (SELECT row_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM tt JOIN d USING (term), n)
SELECT row_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY row_id)), 6) AS weight FROM x""")
def tfidf_lemmatised(spark, sf):
    """The uncapped weights of the lemmatised text, as the models take it."""
    _, lem = _lemma_frame(spark, sf)
    t = tfidf_long(lem, "lemmatized_headline")
    return t.select("row_id", "term", F.round("weight", 6).alias("weight"))


def _polarity_sql(table: str, id_col: str, text_col: str) -> str:
    negs = ", ".join(S.q(n) for n in LX.NEGATIONS)
    return f"""lex AS {_vals(LX.DEFAULT_POLARITY, 'word, polarity, intensity')},
pe AS (SELECT {id_col} AS id, unnest(tk) AS word, unnest(generate_series(0, len(tk) - 1)) AS pos
  FROM (SELECT {id_col}, regexp_extract_all(lower({text_col}), {S.q(WORD + '+')}) AS tk FROM {table})),
pj AS (SELECT pe.*, lex.polarity, lex.intensity FROM pe LEFT JOIN lex USING (word)),
pw AS (SELECT *, lag(word, 1) OVER win AS w1, lag(word, 2) OVER win AS w2, lag(intensity, 1) OVER win AS i1,
  lag(polarity, 1) OVER win AS p1 FROM pj WINDOW win AS (PARTITION BY id ORDER BY pos)),
pf AS (SELECT *, (i1 IS NOT NULL AND i1 <> 1.0 AND coalesce(p1, 0.0) = 0.0) AS int1 FROM pw),
pv AS (SELECT id, greatest(least(polarity * CASE WHEN int1 THEN i1 ELSE 1.0 END *
  CASE WHEN w1 IN ({negs}) OR (int1 AND w2 IN ({negs})) THEN {LX.NEGATION_FACTOR} ELSE 1.0 END, 1.0), -1.0) AS v
  FROM pf WHERE polarity IS NOT NULL AND polarity <> 0.0),
pol AS (SELECT d.{id_col} AS id, coalesce((SELECT avg(v) FROM pv WHERE pv.id = d.{id_col}), 0.0) AS sentiment_polarity
  FROM {table} d)"""


@register("sentiment_polarity", "F-11",
          f"WITH {S.HEADLINES}, {_polarity_sql('merged', 'row_id', 'headline')} "
          "SELECT id AS row_id, round(sentiment_polarity, 6) AS sentiment_polarity FROM pol")
def sentiment_polarity(spark, sf):
    p = LX.polarity(_merged(spark, sf), "row_id", "headline")
    return p.select("row_id", F.round("sentiment_polarity", 6).alias("sentiment_polarity"))


@register("document_polarity", "F-11",
          f"WITH {_polarity_sql('documents', 'doc_id', 'text')} "
          "SELECT id AS doc_id, round(sentiment_polarity, 6) AS sentiment_polarity FROM pol")
def document_polarity(spark, sf):
    from ..sources.tables import documents
    p = LX.polarity(documents(spark, sf), "doc_id", "text")
    return p.select("doc_id", F.round("sentiment_polarity", 6).alias("sentiment_polarity"))


_ENRICH_FEATS = ["word_count", "char_count", "headline_length", "exclamation_mark", "question_mark",
                 "multiple_punct_count", "large_number_flag", "all_caps_count", "punctuation_count"]


def _enriched_sql() -> str:
    feats = ", ".join(f"{S.FEATURES[n]('m.headline')} AS {n}" for n in _ENRICH_FEATS)
    return f"""WITH {_lemma_sql()}, {_polarity_sql('merged', 'row_id', 'headline')}
SELECT m.row_id, m.headline, m.is_sarcastic, m.version, {S.clean('m.headline')} AS cleaned_headline, {feats},
  {S.filtered_tokens('m.headline')} AS filtered_tokens, lt.lemmatized_headline,
  round(pol.sentiment_polarity, 6) AS sentiment_polarity
FROM merged m JOIN lt ON lt.row_id = m.row_id JOIN pol ON pol.id = m.row_id"""


@register("enriched_headlines", "F-12 T-01 T-07 T-08 F-11 S-05", _enriched_sql())
def enriched_headlines(spark, sf):
    """The enhanced table: every feature, the cleaned, lemmatised and
    filtered forms and the polarity, keyed by row."""
    m, lem = _lemma_frame(spark, sf)
    feats = FT.with_features(m.drop("toks"), "headline", _ENRICH_FEATS) \
        .withColumn("filtered_tokens", T.filtered_tokens("headline")).withColumnRenamed("cleaned", "cleaned_headline")
    pol = LX.polarity(m, "row_id", "headline").withColumn("sentiment_polarity", F.round("sentiment_polarity", 6))
    return feats.join(lem, "row_id").join(pol, "row_id")


_CLOUD = f"""ct AS (SELECT is_sarcastic, unnest(list_filter({S.ws_tokens('lemmatized_headline')},
  lambda x: NOT list_contains({S.STOP}, x))) AS word FROM lt),
cc AS (SELECT word, count(*) AS count FROM ct GROUP BY word)"""


def _cloud_tokens(spark, sf):
    m, lem = _lemma_frame(spark, sf)
    toks = T.remove_stopwords(T.ws_tokens("lemmatized_headline"), case_sensitive=True)
    return lem.join(m.select("row_id", "version"), "row_id").withColumn("toks", toks)


@register("word_cloud_weights", "A-13 T-08 T-12",
          f"""WITH {_lemma_sql()}, {_CLOUD}
SELECT word, count, round(count / max(count) OVER (), 6) AS weight FROM cc ORDER BY count DESC, word LIMIT 200""")
def word_cloud_weights(spark, sf):
    t = _cloud_tokens(spark, sf)
    c = P.explode_tokens(t, "toks", ["row_id"]).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    top = c.orderBy(F.col("count").desc(), "word").limit(200)
    return top.withColumn("weight", F.round(F.col("count") / c.agg(F.max("count")).scalar(), 6))


@register("collocations", "A-14",
          f"""WITH {_lemma_sql()},
st AS (SELECT word, lead(word) OVER (ORDER BY version, row_id, pos) AS nxt FROM (
  SELECT version, row_id, unnest(toks) AS word, unnest(generate_series(1, len(toks))) AS pos FROM (
    SELECT m.version, m.row_id, {S.ws_tokens('lemmatized_headline')} AS toks FROM lt JOIN merged m USING (row_id)))),
uni AS (SELECT word, count(*) AS c FROM st WHERE NOT list_contains({S.STOP}, word) GROUP BY word),
nn AS (SELECT sum(c) AS n FROM uni),
bi AS (SELECT word AS a, nxt AS b, count(*) AS cab FROM st WHERE nxt IS NOT NULL AND NOT list_contains({S.STOP}, word)
  AND NOT list_contains({S.STOP}, nxt) GROUP BY ALL),
o AS (SELECT a, b, cab, ua.c AS ca, ub.c AS cb, n FROM bi JOIN uni ua ON ua.word = a JOIN uni ub ON ub.word = b, nn),
g AS (SELECT a || ' ' || b AS bigram, cab AS count, 2 * (
  CASE WHEN cab > 0 THEN cab * ln(cab / (ca * cb / n)) ELSE 0 END +
  CASE WHEN ca - cab > 0 THEN (ca - cab) * ln((ca - cab) / (ca * (n - cb) / n)) ELSE 0 END +
  CASE WHEN cb - cab > 0 THEN (cb - cab) * ln((cb - cab) / ((n - ca) * cb / n)) ELSE 0 END +
  CASE WHEN n - ca - cb + cab > 0 THEN (n - ca - cb + cab) * ln((n - ca - cb + cab) / ((n - ca) * (n - cb) / n)) ELSE 0 END)
  AS score FROM o)
SELECT bigram, count, round(score, 6) AS score FROM g WHERE score > 30""")
def collocations(spark, sf):
    """All rows are one text: words are paired first, across rows as well,
    then pairs with a stopword go."""
    m, lem = _lemma_frame(spark, sf)
    t = lem.join(m.select("row_id", "version"), "row_id").withColumn("toks", T.ws_tokens("lemmatized_headline"))
    stop = list(ENGLISH_STOPWORDS)
    uni = P.explode_tokens(t, "toks", ["row_id"]).filter(~F.col("word").isin(stop)) \
        .groupBy("word").agg(F.count(F.lit(1)).alias("c"))
    n = uni.agg(F.sum("c")).scalar()
    g = P.stream_ngrams(t, "toks", [], 2)
    bi = g.groupBy("ngram").agg(F.count(F.lit(1)).alias("cab")) \
        .withColumn("a", F.split("ngram", " ")[0]).withColumn("b", F.split("ngram", " ")[1]) \
        .filter(~F.col("a").isin(stop) & ~F.col("b").isin(stop))
    o = (bi.join(uni.select(F.col("word").alias("a"), F.col("c").alias("ca")), "a")
         .join(uni.select(F.col("word").alias("b"), F.col("c").alias("cb")), "b"))

    def cell(obs, exp):
        return F.when(obs > 0, obs * F.log(obs / exp)).otherwise(F.lit(0.0))
    ca, cb, cab = F.col("ca"), F.col("cb"), F.col("cab")
    score = 2 * (cell(cab, ca * cb / n) + cell(ca - cab, ca * (n - cb) / n)
                 + cell(cb - cab, (n - ca) * cb / n) + cell(n - ca - cb + cab, (n - ca) * (n - cb) / n))
    return o.select(F.col("ngram").alias("bigram"), cab.alias("count"), score.alias("score")) \
        .filter(F.col("score") > 30).withColumn("score", F.round("score", 6))
