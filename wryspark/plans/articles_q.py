"""Article branch queries: J-03, T-09, T-11, T-13, R-01..R-08, A-15, P-04."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.features import word_count
from ..operators import articles as AR
from ..operators import reconcile as R
from ..operators import rouge as RG
from ..operators import sentences as SE
from ..operators import split as SP
from ..functions import markup as MK
from ..functions import regex as rx
from ..functions.wordlists import BODY_ALLOWED_PARENTS, BODY_BLOCKLIST, LINK_PREFIX_LEN
from ..operators.encode import TERM_PATTERN, tfidf_long
from ..session import cut_lineage
from ..sources.tables import documents, pages, read_table
from . import sqltext as S
from .catalog import register

# The five basic character references of page titles.
_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
_TITLE = r"<title>(.*?)</title>"


def _title_col(html: str = "html"):
    t = F.regexp_extract(F.col(html), _TITLE, 1)
    for a, b in _ENTITIES:
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


def _title_sql(html: str = "html") -> str:
    t = f"regexp_extract({html}, {S.q(_TITLE)}, 1)"
    for a, b in _ENTITIES:
        t = f"replace({t}, {S.q(a)}, {S.q(b)})"
    return t


@register("page_titles", "T-13 S-06", f"SELECT page_id, {_title_sql()} AS title FROM pages")
def page_titles(spark, sf):
    return pages(spark, sf).select("page_id", _title_col().alias("title"))


def _articles_sql() -> str:
    """``articles(page_id, url, title, body)``: the state machine of
    ``functions.markup`` as a fold over a list of its states. References are
    replaced as far as the stored pages hold them; the unit tests have all."""
    low = "lower(regexp_extract(t, {}, 1))"
    start, end = low.format(S.q(MK.START_NAME)), low.format(S.q(MK.END_NAME))
    closed = S.str_list([*MK.VOID_TAGS, "script", "style"])
    state = "struct_pack(k := {}, name := {}, text := {}, stack := {}, nodes := {})"
    none, no_nodes = "CAST([] AS VARCHAR[])", "CAST([] AS STRUCT(parent VARCHAR, text VARCHAR)[])"
    token = f"""CASE WHEN length(t) < 2 OR NOT starts_with(t, '<') THEN {state.format("'text'", "''", "t", none, no_nodes)}
  WHEN {end} <> '' THEN {state.format("'close'", end, "''", none, no_nodes)} WHEN t = '</>' THEN {state.format("'none'", "''", "''", none, no_nodes)}
  WHEN {start} <> '' AND NOT list_contains({closed}, {start}) AND NOT ends_with(t, '/>') THEN {state.format("'open'", start, "''", none, no_nodes)}
  ELSE {state.format("'cut'", "''", "''", none, no_nodes)} END"""
    ends = "t.k IN ('open', 'close', 'cut') AND s.text <> ''"
    base = """CASE WHEN (t.k = 'close' OR (t.k = 'open' AND t.name = 'p')) AND list_contains(s.stack, t.name)
    THEN list_slice(s.stack, 1, len(s.stack) - list_position(list_reverse(s.stack), t.name)) ELSE s.stack END"""
    step = state.format("''", "''", f"CASE WHEN t.k = 'text' THEN s.text || t.text WHEN {ends} THEN '' ELSE s.text END",
                        f"CASE WHEN t.k = 'open' THEN list_append({base}, t.name) ELSE {base} END",
                        f"CASE WHEN {ends} AND len(s.stack) > 0 THEN list_append(s.nodes, struct_pack(parent := s.stack[-1], text := s.text)) "
                        "ELSE s.nodes END")
    first = state.format("''", "''", "''", none, no_nodes)
    last = state.format("'cut'", "''", "''", none, no_nodes)
    text = "n.text"
    for a, b in [("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'")]:
        text = f"replace({text}, {S.q(a)}, {S.q(b)})"
    text = S.rr(text, "&amp;?", "&")
    blocked = " AND ".join(f"NOT contains(x, {S.q(b)})" for b in BODY_BLOCKLIST)
    return f"""tokens AS (SELECT page_id, url, list_transform(regexp_extract_all(coalesce(html, ''), {S.q(MK.token_pattern(possessive=False))}),
  lambda t: {token}) AS l FROM pages),
walked AS (SELECT page_id, url, list_reduce(list_append(list_prepend({first}, l), {last}), lambda s, t: {step}).nodes AS nodes FROM tokens),
articles AS (SELECT page_id, url, {S.strip(f"array_to_string(list_transform(list_filter(nodes, lambda n: n.parent = 'title'), lambda n: {text}), '')")} AS title,
  array_to_string(list_filter(list_transform(list_filter(nodes, lambda n: list_contains({S.str_list(BODY_ALLOWED_PARENTS)}, n.parent)),
    lambda n: {text}), lambda x: {blocked}), ' ') AS body FROM walked)"""


ARTICLES = _articles_sql()


@register("article_bodies", "T-13 V-02 E-06",
          f"WITH {ARTICLES} SELECT page_id, title, body, {S.word_count('body')} AS body_words FROM articles")
def article_bodies(spark, sf):
    a = AR.extract_articles(pages(spark, sf))
    return a.select("page_id", "title", "body", word_count("body").alias("body_words"))


@register("link_bodies", "J-03 T-14 Q-10", f"""WITH {ARTICLES}, one AS (SELECT url, arg_min(body, page_id) AS body FROM articles
  WHERE url IS NOT NULL GROUP BY url)
SELECT p.page_id, p.url AS article_link, coalesce(a.body, b.body, '') AS body FROM pages p LEFT JOIN one a ON a.url = p.url
LEFT JOIN one b ON b.url = substr(p.url, {LINK_PREFIX_LEN + 1}) AND substr(p.url, {LINK_PREFIX_LEN + 1}) <> ''""")
def link_bodies(spark, sf):
    """Each stored link resolved to its body with the two-step fallback."""
    p = pages(spark, sf)
    links = p.select("page_id", F.col("url").alias("article_link"))
    out = AR.lookup_bodies(links, "article_link", AR.extract_articles(p), order_col="page_id")
    return out.select("page_id", "article_link", "body")


_STORED = f"""stored AS (SELECT page_id, url, {_title_sql()} AS body FROM pages
  UNION ALL SELECT page_id + 1000000000, url, 'later copy' FROM pages WHERE page_id % 2 = 0),
one AS (SELECT url, arg_min(body, page_id) AS body FROM stored WHERE url IS NOT NULL GROUP BY url),
links AS (SELECT page_id, 0 AS kind, url AS article_link FROM pages
  UNION ALL SELECT page_id, 1, repeat('x', {LINK_PREFIX_LEN}) || url FROM pages
  UNION ALL SELECT page_id, 2, url || '#none' FROM pages
  UNION ALL SELECT page_id, 3, left(url, 8) FROM pages)"""


@register("stored_link_lookup", "J-03 T-14",
          f"""WITH {_STORED} SELECT l.page_id, l.kind, l.article_link, coalesce(a.body, b.body, '') AS body FROM links l
LEFT JOIN one a ON a.url = l.article_link LEFT JOIN one b ON b.url = substr(l.article_link, {LINK_PREFIX_LEN + 1})
  AND substr(l.article_link, {LINK_PREFIX_LEN + 1}) <> ''""")
def stored_link_lookup(spark, sf):
    """Links to stored pages as they are, behind a prefix, unknown and cut
    short, against a store that holds half of the urls twice."""
    p = pages(spark, sf)
    stored = p.select("page_id", "url", _title_col().alias("body"))
    stored = stored.unionByName(stored.filter("page_id % 2 = 0").select(
        (F.col("page_id") + 1000000000).alias("page_id"), "url", F.lit("later copy").alias("body")))
    url = F.col("url")
    kinds = [url, F.concat(F.lit("x" * LINK_PREFIX_LEN), url), F.concat(url, F.lit("#none")), F.substring(url, 1, 8)]
    links = p.select("page_id", F.posexplode(F.array(*kinds)).alias("kind", "article_link"))
    return AR.lookup_bodies(links, "article_link", stored, order_col="page_id").select("page_id", "kind", "article_link", "body")


def _pairs(spark, sf):
    """Summarisation pairs: body = extracted text, headline = page title.

    The parsed pairs feed several branches (filters, slices, TF-IDF); they
    are checkpointed once so the pages are parsed once."""
    a = AR.extract_articles(pages(spark, sf))
    return cut_lineage(a.select(F.col("page_id").alias("row_id"), "body", F.col("title").alias("headline")))


_SLICES = f"""{ARTICLES},
o AS (SELECT page_id AS row_id, body, title AS headline, row_number() OVER (ORDER BY md5(CAST(page_id AS VARCHAR) || '-42'), page_id) - 1 AS i,
  count(*) OVER () AS n FROM articles WHERE {S.word_count('body')} > 30),
sl AS (SELECT *, CASE WHEN i < floor({0.8!r}e0 * n) THEN 'train' WHEN i < floor({0.8 + 0.1!r}e0 * n) THEN 'val'
  WHEN i < floor({0.8 + 0.1 + 0.1!r}e0 * n) THEN 'test' END AS split FROM o)"""


@register("article_splits", "Q-05 A-15 P-04 W-03", f"""WITH {_SLICES}
SELECT split, count(*) AS n, CAST(floor(quantile_cont({S.word_count('body')}, 0.995)) AS BIGINT) AS body_cap,
  CAST(floor(quantile_cont({S.word_count('headline')}, 0.995)) AS BIGINT) AS headline_cap FROM sl WHERE split IS NOT NULL GROUP BY split""")
def article_splits(spark, sf):
    """Long bodies (> 30 words) shuffled and cut 80/10/10; per split the
    row count and the 99.5th-percentile word caps of body and headline."""
    long = R.word_count_filter(_pairs(spark, sf), "body", 30, keep_long=True)
    sl = SP.ordered_slices(long, {"train": 0.8, "val": 0.1, "test": 0.1}, "row_id")
    wc = sl.select("split", word_count("body").alias("bw"), word_count("headline").alias("hw"))
    return wc.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.floor(F.percentile("bw", F.lit(0.995))).cast("bigint").alias("body_cap"),
        F.floor(F.percentile("hw", F.lit(0.995))).cast("bigint").alias("headline_cap"))


@register("article_lead_rouge", "R-01 R-02 R-03 R-04 R-05 R-06 T-11")
def article_lead_rouge(spark, sf):
    """Lead-1 baseline on the validation slice against the headline."""
    long = R.word_count_filter(_pairs(spark, sf), "body", 30, keep_long=True)
    val = SP.ordered_slices(long, {"train": 0.8, "val": 0.1, "test": 0.1}, "row_id") \
        .filter(F.col("split") == "val")
    pairs = val.select("row_id", T.newline_sentences(AR.lead_sentence("body")).alias("pred"),
                       T.newline_sentences("headline").alias("ref"))
    return RG.corpus_scores(pairs, "row_id", "pred", "ref")


@register("summary_predictions", "R-07 R-08 E-01")
def summary_predictions(spark, sf):
    """Test slice: Body, Headline, extractive Summary (TF-IDF over bodies)."""
    pairs = _pairs(spark, sf)
    long = R.word_count_filter(pairs, "body", 30, keep_long=True)
    test = SP.ordered_slices(long, {"train": 0.8, "val": 0.1, "test": 0.1}, "row_id") \
        .filter(F.col("split") == "test")
    weights = tfidf_long(long, "body", "row_id")
    summ = AR.extractive_summary(test, "row_id", "body", weights)
    return test.join(summ, "row_id").select("row_id", F.col("body").alias("Body"),
                                            F.col("headline").alias("Headline"), F.col("summary").alias("Summary"))


@register("lead_sentences", "T-09 T-11 R-01 K-03",
          f"SELECT doc_id, {S.lead_sentence('text')} AS lead, CAST(len({S.sentences('text')}) AS BIGINT) AS n_sentences "
          "FROM documents")
def lead_sentences(spark, sf):
    d = documents(spark, sf)
    return d.select("doc_id", AR.lead_sentence("text").alias("lead"),
                    F.size(T.sentences("text")).cast("bigint").alias("n_sentences"))


@register("sentence_lines", "T-11 T-09",
          f"SELECT doc_id, array_to_string({S.sentences('text')}, chr(10)) AS lines FROM documents")
def sentence_lines(spark, sf):
    return documents(spark, sf).select("doc_id", T.newline_sentences("text").alias("lines"))


SUMMARIES = f"""long AS (SELECT doc_id, text FROM documents WHERE {S.word_count('text')} > 30),
tt AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id,
  unnest(regexp_extract_all(lower(text), {S.q(TERM_PATTERN)})) AS term FROM long) GROUP BY ALL),
n AS (SELECT count(*) AS n FROM long),
df AS (SELECT term, ln((1 + any_value(n)) / (1 + count(*))) + 1 AS idf FROM tt, n GROUP BY term),
w0 AS (SELECT doc_id, term, tf * idf AS w FROM tt JOIN df USING (term)),
w AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w0),
s AS (SELECT doc_id, {S.sentences('text')} AS sents FROM long),
se AS (SELECT doc_id, unnest(sents) AS sentence, unnest(generate_series(0, len(sents) - 1)) AS s_idx FROM s),
st AS (SELECT doc_id, s_idx, unnest(regexp_extract_all(lower(sentence), {S.q(TERM_PATTERN)})) AS term FROM se),
sc AS (SELECT st.doc_id, s_idx, round(avg(coalesce(weight, 0)), 9) AS score FROM st LEFT JOIN w
  ON w.doc_id = st.doc_id AND w.term = st.term GROUP BY ALL),
best AS (SELECT doc_id, s_idx AS best FROM sc QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, s_idx) = 1),
d AS (SELECT s.doc_id, sents, coalesce(best, 0) AS best FROM s LEFT JOIN best USING (doc_id)),
x AS (SELECT doc_id, {S.ws_tokens("array_to_string(list_slice(sents, best + 1, len(sents)), ' ')")} AS words,
  len({S.ws_tokens("coalesce(sents[best + 1], '')")}) AS first_len FROM d),
summ AS (SELECT doc_id, array_to_string(list_slice(words, 1, least(30, greatest(10, first_len))), ' ') AS summary FROM x)"""


@register("document_summaries", "R-07 R-08 E-01",
          f"""WITH {SUMMARIES} SELECT doc_id, text AS "Body", {S.lead_sentence('text')} AS "Headline", summary AS "Summary"
FROM long JOIN summ USING (doc_id)""")
def document_summaries(spark, sf):
    """Prediction table over all long documents: body, lead sentence as the
    headline, extractive summary."""
    long = R.word_count_filter(documents(spark, sf), "text", 30, keep_long=True)
    summ = AR.extractive_summary(long, "doc_id", "text")
    return long.join(summ, "doc_id").select("doc_id", F.col("text").alias("Body"),
                                            AR.lead_sentence("text").alias("Headline"),
                                            F.col("summary").alias("Summary"))


_CONV_PAIRS = f"""p AS (SELECT CAST(u.conv_id AS VARCHAR) || '-' || CAST(u.turn AS VARCHAR) AS pair_id, {S.lead_sentence('a.text')} AS pred, u.text AS ref
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""


def _conv_pairs(spark, sf):
    c = read_table(spark, sf, "conversations", ["conv_id", "turn", "role", "text"])
    u = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("ref"))
    a = c.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), AR.lead_sentence("text").alias("pred"))
    return u.join(a, ["conv_id", "turn"]).select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("pair_id"), "pred", "ref")


def _rouge_n_sql(n: int) -> str:
    def grams(x):
        toks = S.rouge_tokens(x)
        if n == 1:
            return toks
        return (f"list_transform(generate_series(1, greatest(len({toks}) - {n - 1}, 0)), "
                f"lambda i: array_to_string(list_slice({toks}, i, i + {n - 1}), ' '))")
    return f"""g AS (SELECT pair_id, 0 AS side, unnest({grams('pred')}) AS gram FROM p
  UNION ALL SELECT pair_id, 1, unnest({grams('ref')}) FROM p),
pg AS (SELECT pair_id, gram, count(*) FILTER (WHERE side = 0) AS cp, count(*) FILTER (WHERE side = 1) AS cr
  FROM g GROUP BY ALL),
t AS (SELECT pair_id, sum(least(cp, cr)) AS hit, sum(cp) AS np, sum(cr) AS nr FROM pg GROUP BY pair_id),
s AS (SELECT p.pair_id, coalesce(hit, 0) AS hit, coalesce(np, 0) AS np, coalesce(nr, 0) AS nr FROM p LEFT JOIN t USING (pair_id)),
f AS (SELECT pair_id, CASE WHEN np > 0 THEN hit / np ELSE 0 END AS precision,
  CASE WHEN nr > 0 THEN hit / nr ELSE 0 END AS recall FROM s)"""


def _rouge_rows_sql(n: int) -> str:
    return (f"WITH {_CONV_PAIRS}, {_rouge_n_sql(n)} SELECT pair_id, round(precision, 6) AS precision, "
            "round(recall, 6) AS recall, round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / "
            "(precision + recall) ELSE 0 END, 6) AS fmeasure FROM f")


def _rouge_rows(spark, sf, n):
    r = RG.rouge_n(_conv_pairs(spark, sf), "pair_id", "pred", "ref", n)
    return r.select("pair_id", *[F.round(c, 6).alias(c) for c in ["precision", "recall", "fmeasure"]])


@register("conversation_rouge1", "R-01 R-02", _rouge_rows_sql(1))
def conversation_rouge1(spark, sf):
    return _rouge_rows(spark, sf, 1)


@register("conversation_rouge2", "R-03", _rouge_rows_sql(2))
def conversation_rouge2(spark, sf):
    return _rouge_rows(spark, sf, 2)


def _rouge_corpus_sql(n: int) -> str:
    return f"""WITH {_CONV_PAIRS}, {_rouge_n_sql(n)}
SELECT 'rouge{n}' AS metric, round(avg(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
  ELSE 0 END), 4) AS score FROM f"""


@register("conversation_rouge_corpus", "R-06",
          f"SELECT * FROM ({_rouge_corpus_sql(1)}) UNION ALL SELECT * FROM ({_rouge_corpus_sql(2)})")
def conversation_rouge_corpus(spark, sf):
    return RG.corpus_scores(_conv_pairs(spark, sf), "pair_id", "pred", "ref", with_lcs=False)


def _lcs_sql() -> str:
    """The table of prefix lengths for every pair of texts (kind 0) and of
    their lines (kind 1), a word of the reference a round; then the way back."""
    def lines(x: str) -> str:
        text = f"array_to_string({S.sentences(x)}, chr(10))"
        return f"list_filter(list_transform(string_split({text}, chr(10)), lambda s: {S.rouge_tokens('s')}), lambda s: len(s) > 0)"
    return f"""WITH RECURSIVE {_CONV_PAIRS.replace("AS (SELECT", "AS MATERIALIZED (SELECT", 1)},
s AS MATERIALIZED (SELECT pair_id, {lines('pred')} AS cands, {lines('ref')} AS refs FROM p),
u AS MATERIALIZED (SELECT pair_id, 0 AS kind, 0 AS r, 0 AS c, flatten(refs) AS ref, flatten(cands) AS cand FROM s
  UNION ALL SELECT pair_id, 1, r, c, refs[r], cands[c] FROM s, unnest(generate_series(1, len(refs))) a(r), unnest(generate_series(1, len(cands))) b(c)),
t(pair_id, kind, r, c, i, j, v) AS (
  SELECT pair_id, kind, r, c, 0, j, 0 FROM u, unnest(generate_series(0, len(cand))) x(j)
  UNION ALL
  SELECT pair_id, kind, r, c, i + 1, j, CAST(max(best) OVER (PARTITION BY pair_id, kind, r, c ORDER BY j) AS INTEGER) FROM (
    SELECT t.pair_id, t.kind, t.r, t.c, t.i, t.j, greatest(t.v, CASE WHEN t.j > 0 AND u.ref[t.i + 1] = u.cand[t.j] THEN
      lag(t.v) OVER (PARTITION BY t.pair_id, t.kind, t.r, t.c ORDER BY t.j) + 1 ELSE 0 END) AS best
    FROM t JOIN u USING (pair_id, kind, r, c) WHERE t.i < len(u.ref))),
lens AS MATERIALIZED (SELECT * FROM t),
way(pair_id, r, c, i, j, hit) AS (
  SELECT pair_id, r, c, len(ref), len(cand), 0 FROM u WHERE kind = 1
  UNION ALL
  SELECT w.pair_id, w.r, w.c, CASE WHEN same OR NOT shorter THEN w.i - 1 ELSE w.i END, CASE WHEN same OR shorter THEN w.j - 1 ELSE w.j END,
    CASE WHEN same THEN w.i ELSE 0 END FROM (
    SELECT w.*, u.ref[w.i] = u.cand[w.j] AS same, x.v > y.v AS shorter FROM way w JOIN u ON u.pair_id = w.pair_id AND u.kind = 1 AND u.r = w.r AND u.c = w.c
    JOIN lens x ON x.pair_id = w.pair_id AND x.kind = 1 AND x.r = w.r AND x.c = w.c AND x.i = w.i AND x.j = w.j - 1
    JOIN lens y ON y.pair_id = w.pair_id AND y.kind = 1 AND y.r = w.r AND y.c = w.c AND y.i = w.i - 1 AND y.j = w.j) w),
found AS (SELECT pair_id, refs[r][hit] AS word FROM (SELECT DISTINCT pair_id, r, hit FROM way WHERE hit > 0) JOIN s USING (pair_id)),
held AS (SELECT pair_id, word, count(*) AS n FROM (SELECT pair_id, unnest(flatten(cands)) AS word FROM s) GROUP BY ALL),
hits AS (SELECT pair_id, sum(least(f.n, h.n)) AS hit FROM (SELECT pair_id, word, count(*) AS n FROM found GROUP BY ALL) f
  JOIN held h USING (pair_id, word) GROUP BY pair_id),
both_scores AS (SELECT s.pair_id, len(flatten(cands)) AS np, len(flatten(refs)) AS nr, coalesce(l.v, 0) AS hit_l, coalesce(h.hit, 0) AS hit_s
  FROM s JOIN u ON u.pair_id = s.pair_id AND u.kind = 0
  JOIN lens l ON l.pair_id = s.pair_id AND l.kind = 0 AND l.i = len(u.ref) AND l.j = len(u.cand) LEFT JOIN hits h ON h.pair_id = s.pair_id)
SELECT pair_id, {_f_sql('hit_l')} AS "rougeL", {_f_sql('hit_s')} AS "rougeLsum" FROM both_scores"""


def _f_sql(hit: str) -> str:
    p, r = f"{hit} / np", f"{hit} / nr"
    return f"round(CASE WHEN np > 0 AND nr > 0 AND {hit} > 0 THEN 2 * ({p}) * ({r}) / ({p} + {r}) ELSE 0 END, 6)"


@register("conversation_rouge_lcs", "R-04 R-05 T-11", _lcs_sql())
def conversation_rouge_lcs(spark, sf):
    """ROUGE-L and ROUGE-Lsum of every pair, sentences on lines of their own."""
    p = _conv_pairs(spark, sf).select("pair_id", T.newline_sentences("pred").alias("pred"),
                                      T.newline_sentences("ref").alias("ref"))
    l1 = RG.rouge_l(p, "pair_id", "pred", "ref").select("pair_id", F.round("fmeasure", 6).alias("rougeL"))
    l2 = RG.rouge_lsum(p, "pair_id", "pred", "ref").select("pair_id", F.round("fmeasure", 6).alias("rougeLsum"))
    return l1.join(l2, "pair_id")


def _bootstrap_sql(replicates: int = 1000) -> str:
    def f(n: int) -> str:
        return (f"SELECT pair_id, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS rouge{n} "
                f"FROM (WITH {_rouge_n_sql(n)} SELECT * FROM f)")
    value = "CAST('0x' || substr(h, 4 * j + 1, 4) AS INTEGER)"
    times = " + ".join(f"CAST({value} >= {s} AS INTEGER)" for s in RG.POISSON_STEPS)
    cut = ", ".join(f"round(quantile_cont(s / n, {x}), 4) AS {name}" for x, name in ((0.025, "low"), (0.5, "mid"), (0.975, "high")))
    return f"""WITH {_CONV_PAIRS}, sc AS MATERIALIZED (SELECT * FROM ({f(1)}) JOIN ({f(2)}) USING (pair_id)),
hh AS (SELECT rouge1, rouge2, b, j, md5(pair_id || '-' || CAST(b AS VARCHAR)) AS h FROM sc, unnest(range({-(-replicates // 8)})) x(b), unnest(range(8)) y(j)),
dr AS (SELECT 8 * b + j AS rep, {times} AS times, rouge1, rouge2 FROM hh),
me AS (SELECT rep, metric, sum(v * times) AS s, sum(times) AS n FROM (SELECT rep, times, 'rouge1' AS metric, rouge1 AS v FROM dr
  UNION ALL SELECT rep, times, 'rouge2', rouge2 FROM dr) WHERE rep < {replicates} AND times > 0 GROUP BY ALL)
SELECT metric, {cut} FROM me GROUP BY metric"""


@register("conversation_rouge_bootstrap", "R-06", _bootstrap_sql())
def conversation_rouge_bootstrap(spark, sf):
    """Low, middle and high of the mean F over 1,000 resamples of the pairs."""
    pairs = cut_lineage(_conv_pairs(spark, sf))
    one, two = (RG.rouge_n(pairs, "pair_id", "pred", "ref", n).select("pair_id", F.col("fmeasure").alias(f"rouge{n}")) for n in (1, 2))
    return RG.bootstrap_scores(one.join(two, "pair_id"), "pair_id", ["rouge1", "rouge2"])


def _types_sql(x: str) -> str:
    bare = f"list_transform({S.ws_tokens(x)}, lambda t: lower({S.rr('t', SE.AROUND, '')}))"
    pairs = f"list_transform({bare}, lambda t: struct_pack(word := regexp_replace(t, '\\.$', ''), period := ends_with(t, '.')))"
    return f"list_filter({pairs}, lambda p: regexp_matches(p.word, {S.q(SE.TYPE)}))"


_ABBREVIATIONS = f"""ty AS (SELECT unnest({_types_sql('text')}) AS p FROM documents),
ct AS (SELECT p.word AS word, count(*) AS n, sum(CAST(p.period AS BIGINT)) AS dots FROM ty GROUP BY ALL),
tt AS (SELECT sum(dots) / sum(n) AS rate FROM ct),
lr AS (SELECT word, n - dots AS without, length(word) - length(replace(word, '.', '')) + 1 AS periods, length(replace(word, '.', '')) AS letters,
  -2 * ((dots * ln(rate) + CASE WHEN n > dots THEN (n - dots) * ln(1 - rate) ELSE 0 END) - (dots * ln(0.99) + (n - dots) * ln(0.01))) AS ll
  FROM ct, tt WHERE dots > 0),
ab AS (SELECT word, round(ll * exp(-letters) * periods * pow(CAST(letters AS DOUBLE), -without), 9) AS score FROM lr),
abbr AS MATERIALIZED (SELECT * FROM ab WHERE score >= {SE.THRESHOLD})"""


@register("learned_abbreviations", "T-09", f"WITH {_ABBREVIATIONS} SELECT word, round(score, 6) AS score FROM abbr")
def learned_abbreviations(spark, sf):
    found = SE.learn_abbreviations(documents(spark, sf), "text")
    return found.select("word", F.round("score", 6).alias("score"))


def _learned_sql() -> str:
    marked = f"regexp_replace({S.strip('text')}, '([.!?][\"'')\\]]*)' || {S.q(rx.SPACE + '+')}, '\\1' || chr(1), 'g')"
    pieces = f"list_filter(list_transform(string_split(coalesce({marked}, ''), chr(1)), lambda s: {S.strip('s')}), lambda s: s <> '')"
    last = f"""lower({S.rr("regexp_extract(piece, '([^ \\t\\n\\x0B\\f\\r]*)$', 1)", SE.AROUND, '')})"""
    return f"""WITH {_ABBREVIATIONS},
pc AS (SELECT doc_id, unnest(l) AS piece, unnest(generate_series(1, len(l))) AS i FROM (SELECT doc_id, {pieces} AS l FROM documents)),
op AS (SELECT doc_id, piece, i, ends_with({last}, '.') AND regexp_replace({last}, '\\.$', '') IN (SELECT word FROM abbr) AS open FROM pc),
gr AS (SELECT *, coalesce(sum(CAST(NOT open AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM op),
se AS (SELECT doc_id, g, string_agg(piece, ' ' ORDER BY i) AS sentence FROM gr GROUP BY ALL),
li AS (SELECT doc_id, count(*) AS n, string_agg(sentence, chr(10) ORDER BY g) AS lines FROM se GROUP BY ALL)
SELECT doc_id, coalesce(n, 0) AS n_sentences, coalesce(lines, '') AS lines FROM documents LEFT JOIN li USING (doc_id)"""


@register("learned_sentences", "T-09 T-11", _learned_sql())
def learned_sentences(spark, sf):
    """Sentences by the abbreviations learnt from the same documents."""
    docs = documents(spark, sf)
    s = SE.split_sentences(docs, "doc_id", "text", SE.learn_abbreviations(docs, "text"))
    return s.select("doc_id", F.size("sentences").cast("bigint").alias("n_sentences"), F.array_join("sentences", "\n").alias("lines"))
