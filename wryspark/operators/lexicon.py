"""Lexicon-driven operators (T-08, T-10, F-11, F-12).

The reference calls per-row libraries with their own word lists; here the
word lists are tables and the work is joins:

* word class (T-10): a tag table when given, else a suffix rule;
* lemma (T-08): the published WordNet detachment rules generate
  candidates for each *distinct* (word, class); a candidate is kept when
  it occurs in a vocabulary table (default: the corpus's own words) or an
  exception table says so; the shortest wins. Only the distinct-word table
  runs the rules; tokens join the result back;
* polarity (F-11): tokens join a polarity lexicon; a per-document window
  looks one or two tokens back for intensifiers and negations.

Lexicons may have any size: rows of words behind a large share of the tokens
(a bounded number) are broadcast, the others joined as AQE picks from their
size. Lemmas are put into whole texts (``replace_words``), so that tokens are
not shuffled for them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# WordNet morphological detachment rules (suffix, replacement).
NOUN_RULES = [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"),
              ("shes", "sh"), ("men", "man"), ("ies", "y")]
VERB_RULES = [("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""), ("ing", "e"),
              ("ing", "")]
ADJ_RULES = [("er", ""), ("est", ""), ("er", "e"), ("est", "e")]
RULES = {"n": NOUN_RULES, "v": VERB_RULES, "a": ADJ_RULES, "r": []}

# A small default exception table (irregular form, class, lemma).
DEFAULT_EXCEPTIONS = [
    ("children", "n", "child"), ("men", "n", "man"), ("women", "n", "woman"), ("people", "n", "person"),
    ("mice", "n", "mouse"), ("geese", "n", "goose"), ("feet", "n", "foot"), ("teeth", "n", "tooth"),
    ("was", "v", "be"), ("were", "v", "be"), ("is", "v", "be"), ("are", "v", "be"), ("been", "v", "be"),
    ("went", "v", "go"), ("gone", "v", "go"), ("did", "v", "do"), ("done", "v", "do"), ("had", "v", "have"),
    ("has", "v", "have"), ("said", "v", "say"), ("made", "v", "make"), ("took", "v", "take"),
    ("better", "a", "good"), ("best", "a", "good"), ("worse", "a", "bad"), ("worst", "a", "bad"),
]

# A small default polarity lexicon (word, polarity, intensity).
# Words with polarity 0 and intensity != 1 are intensifiers.
DEFAULT_POLARITY = [
    ("good", 0.7, 1.0), ("great", 0.8, 1.0), ("best", 1.0, 1.0), ("better", 0.5, 1.0), ("love", 0.5, 1.0),
    ("happy", 0.8, 1.0), ("nice", 0.6, 1.0), ("excellent", 1.0, 1.0), ("amazing", 0.6, 1.0),
    ("wonderful", 1.0, 1.0), ("fun", 0.3, 1.0), ("new", 0.14, 1.0), ("true", 0.35, 1.0),
    ("bad", -0.7, 1.0), ("worst", -1.0, 1.0), ("worse", -0.4, 1.0), ("terrible", -1.0, 1.0),
    ("awful", -1.0, 1.0), ("sad", -0.5, 1.0), ("hate", -0.8, 1.0), ("poor", -0.4, 1.0),
    ("wrong", -0.5, 1.0), ("stupid", -0.8, 1.0), ("horrible", -1.0, 1.0), ("old", 0.1, 1.0),
    ("very", 0.0, 1.3), ("really", 0.0, 1.3), ("extremely", 0.0, 1.5), ("so", 0.0, 1.3),
    ("too", 0.0, 1.2), ("quite", 0.0, 1.1), ("totally", 0.0, 1.3),
]
NEGATIONS = ["not", "never", "no"]
NEGATION_FACTOR = -0.5


def word_class(c) -> Column:
    """T-10 suffix rule: ``ly`` adverb, ``ing``/``ed`` verb, ``ous``/``ful``/``ive``
    adjective, else noun (WordNet letters r, v, a, n)."""
    w = F.col(c) if isinstance(c, str) else c
    return (F.when(w.endswith("ly"), "r").when(w.endswith("ing") | w.endswith("ed"), "v")
            .when(w.endswith("ous") | w.endswith("ful") | w.endswith("ive"), "a").otherwise("n"))


def _candidates(word: Column, tag: Column) -> Column:
    """The word itself plus every rule form of its class (suffix replaced)."""
    def forms(rules):
        return [F.when(word.endswith(s) & (F.length(word) > len(s)),
                       F.concat(word.substr(F.lit(1), F.length(word) - len(s)), F.lit(r)))
                for s, r in rules]
    expr = F.array(word)
    for t, rules in RULES.items():
        if rules:
            expr = F.when(tag == t, F.array(word, *forms(rules))).otherwise(expr)
    return F.filter(expr, lambda x: x.isNotNull())


def lemma_table(words: DataFrame, vocab: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Lemma of each distinct ``(word, tag)``: the shortest accepted
    candidate (ties alphabetical); accepted = in ``vocab`` or listed in
    ``exceptions (word, tag, lemma)``."""
    cands = words.select("word", "tag", F.explode(_candidates(F.col("word"), F.col("tag"))).alias("form"))
    # A semi-join needs no distinct(); leaving it out lets the default
    # vocabulary reuse the distinct-word aggregate's shuffle.
    ok = cands.join(vocab.select(F.col("word").alias("form")), "form", "left_semi")
    exc = words.join(exceptions, ["word", "tag"]).select("word", "tag", F.col("lemma").alias("form"))
    allc = ok.select("word", "tag", "form").unionByName(exc)
    best = allc.groupBy("word", "tag").agg(F.min(F.struct(F.length("form").alias("n"), F.col("form").alias("f")))
                                            .alias("_m"))
    return best.select("word", "tag", F.col("_m.f").alias("lemma"))


def lemmatize(df: DataFrame, id_col: str, tokens_col: str, out_col: str = "lemmatized",
              vocab: DataFrame | None = None, exceptions: DataFrame | None = None,
              pos_mode: bool = True, tags: DataFrame | None = None) -> DataFrame:
    """T-08: ``(id, out_col)`` with every token replaced by its lemma and the
    tokens re-joined by one space. ``pos_mode=False`` treats every word as
    a noun (the reference's plain lemmatizer). ``tags (word, tag)`` gives the
    class of the words it lists, one row each; the suffix rule the others'."""
    spark = df.sparkSession
    # One map-side-combined aggregate gives both the distinct words, whose
    # class and lemma are worked out once, and, by default, the vocabulary.
    ex = df.select(F.posexplode_outer(tokens_col).alias("pos", "word")).filter(F.col("word").isNotNull())
    counted = cut_lineage(ex.groupBy("word").agg(F.count(F.lit(1)).alias("_n")))
    rule = word_class("word") if pos_mode else F.lit("n")
    if tags is None:
        words = counted.select("word", rule.alias("tag"), "_n")
    else:
        given = tags.select("word", F.col("tag").alias("_given"))
        words = counted.join(given, "word", "left").select("word", F.coalesce("_given", rule).alias("tag"), "_n")
    if vocab is None:
        vocab = counted.select("word")
    if exceptions is None:
        exceptions = spark.createDataFrame(DEFAULT_EXCEPTIONS, "word string, tag string, lemma string")
    # A word that no rule and no exception names stays as it is.
    ruled = F.size(_candidates(F.col("word"), F.col("tag"))) > 1
    open_words = words.filter(ruled).unionByName(
        words.filter(~ruled).join(exceptions.select("word").distinct(), "word", "left_semi"))
    lemmas = lemma_table(open_words, vocab, exceptions).join(open_words, ["word", "tag"]).filter(F.col("lemma") != F.col("word"))
    changed = cut_lineage(lemmas.select("word", "lemma", "_n"))
    # Rows that repeat an id are one text, its tokens ordered by place.
    per = replace_words(df.select(id_col, F.col(tokens_col).alias("_t")), id_col, "_t", changed) \
        .groupBy(id_col).agg(F.collect_list(F.coalesce("_t", F.array().cast("array<string>"))).alias("_ts"))
    places = F.flatten(F.transform("_ts", lambda t: F.transform(t, lambda w, i: F.struct(i.alias("pos"), w.alias("word")))))
    merged = F.transform(F.sort_array(F.filter(places, lambda p: p["word"].isNotNull())), lambda p: p["word"])
    return per.select(id_col, F.array_join(F.when(F.size("_ts") == 1, F.element_at("_ts", 1)).otherwise(merged), " ").alias(out_col))


#: Words replaced inside the tasks from one broadcast table, about 10 MB; the most frequent ones, if more are replaced.
REPLACED_WORDS = 200_000


def replace_words(df: DataFrame, id_col: str, tokens_col: str, changed: DataFrame, limit: int = REPLACED_WORDS) -> DataFrame:
    """``df`` with the words in ``tokens_col`` replaced that ``changed (word,
    lemma, _n)`` lists, one row a word; the others stay. ``_n`` is the word's count.

    Texts stay whole: the ``limit`` most frequent of these words are broadcast
    and looked up batch by batch. The others are rare; they are joined to the
    different words of each text, which gets back its own few replacements."""
    rows = changed.orderBy(F.col("_n").desc(), "word").limit(limit).collect()
    table = df.sparkSession.sparkContext.broadcast(([r.word for r in rows], [r.lemma for r in rows]))
    if len(rows) < limit:
        return df.withColumn(tokens_col, _replacer(table)(F.col(tokens_col)))
    n, word = rows[-1]._n, rows[-1].word
    rare = changed.filter((F.col("_n") < n) | ((F.col("_n") == n) & (F.col("word") > word))).select("word", "lemma")
    own = df.select(id_col, F.explode_outer(F.array_distinct(tokens_col)).alias("word")).join(rare, "word") \
        .groupBy(id_col).agg(F.collect_list("word").alias("_words"), F.collect_list("lemma").alias("_lemmas")) \
        .withColumnRenamed(id_col, "_own_id")
    out = df.join(own, F.col(id_col).eqNullSafe(F.col("_own_id")), "left")
    replaced = _replacer(table, own=True)(F.col(tokens_col), F.col("_words"), F.col("_lemmas"))
    return out.withColumn(tokens_col, replaced).drop("_own_id", "_words", "_lemmas")


def _replacer(table, own: bool = False):
    """Arrow function over token lists: the broadcast words and, with ``own``,
    the replacements that stand in the row itself."""
    def replaced(tokens, words=None, lemmas=None):
        near, new = (pa.array(x, pa.string()) for x in table.value)
        flat = tokens.flatten().cast(pa.string())
        sizes = np.asarray(pc.fill_null(pc.list_value_length(tokens), 0))
        ends = np.cumsum(sizes)
        out = pc.coalesce(new.take(pc.index_in(flat, value_set=near, skip_nulls=True)), flat)
        patched = {}
        for row in np.flatnonzero(words.is_valid()) if own else ():
            named, start = dict(zip(words[row].as_py(), lemmas[row].as_py())), ends[row] - sizes[row]
            patched |= {start + k: named[t] for k, t in enumerate(flat.slice(start, sizes[row]).to_pylist()) if t in named}
        if patched:
            at = np.full(len(flat), -1)
            at[list(patched)] = np.arange(len(patched))
            out = pc.coalesce(pa.array(list(patched.values()), pa.string()).take(pa.array(at, mask=at < 0)), out)
        return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), out, mask=tokens.is_null())

    def one(tokens: pa.Array) -> pa.Array:
        return replaced(tokens)

    def three(tokens: pa.Array, words: pa.Array, lemmas: pa.Array) -> pa.Array:
        return replaced(tokens, words, lemmas)
    return F.arrow_udf(three if own else one, "array<string>")


#: A word that has more than this share of all tokens is a hot one; there are fewer than 1 / share of them.
HOT_SHARE = 1e-4


def join_words(tokens: DataFrame, counted: DataFrame, table: DataFrame, place: list[str]) -> DataFrame:
    """``tokens`` left-joined with ``table`` on ``word`` (one row a word).
    ``counted (word, _n)`` holds the tokens' counts, ``place`` columns that
    tell tokens of one word apart.

    Words behind a large share of the tokens would all meet in one task. They
    are fewer than 1 / HOT_SHARE, so their rows are broadcast; their tokens
    then need no key and are dealt out evenly, like tokens without a word."""
    total = counted.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    hot = counted.filter(F.col("_n") > max(1.0, total * HOT_SHARE)).select(F.col("word").alias("_hot"))
    values = [c for c in table.columns if c != "word"]
    hot_rows = table.join(F.broadcast(hot), F.col("word") == F.col("_hot")).select(
        "_hot", *[F.col(c).alias(f"_h_{c}") for c in values])
    near = tokens.join(F.broadcast(hot_rows), F.col("word") == F.col("_hot"), "left")
    # A word never holds this character first, so the even keys match nothing.
    even = F.concat(F.lit("\u0000"), F.xxhash64(*place).cast("string"))
    keyed = near.withColumn("_key", F.when(F.col("word").isNull() | F.col("_hot").isNotNull(), even).otherwise(F.col("word")))
    rest = table.select(F.col("word").alias("_key"), *[F.col(c).alias(f"_r_{c}") for c in values])
    joined = keyed.join(rest, "_key", "left")
    return joined.select(*tokens.columns, *[F.when(F.col("_hot").isNotNull(), F.col(f"_h_{c}")).otherwise(F.col(f"_r_{c}")).alias(c)
                                            for c in values])


def context_tags(df: DataFrame, tokens_col: str, before_noun: list[str], before_verb: list[str]) -> DataFrame:
    """T-10: a tag table ``(word, tag)`` from the words' company: a word that
    stands after one of ``before_noun`` at least as often as after one of
    ``before_verb`` is a noun, the other way round a verb. Words that follow
    neither are not in the table. Tokens are compared lower-cased; the two
    counts are partial sums, and only following words are shuffled."""
    toks = F.transform(tokens_col, lambda t: F.lower(t))
    pairs = F.transform(F.filter(F.arrays_zip(F.slice("_t", F.lit(1), F.greatest(F.size("_t") - 1, F.lit(0))).alias("a"),
                                              F.slice("_t", F.lit(2), F.greatest(F.size("_t") - 1, F.lit(0))).alias("b")),
                                 lambda p: p["a"].isin(before_noun + before_verb)),
                        lambda p: F.struct(p["b"].alias("word"), p["a"].isin(before_noun).alias("noun")))
    said = df.select(toks.alias("_t")).filter(F.size("_t") > 1).select(F.explode(pairs).alias("_p")).select("_p.*")
    counts = said.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum(F.col("noun").cast("long")).alias("n"), F.count(F.lit(1)).alias("both"))
    return counts.select("word", F.when(2 * F.col("n") >= F.col("both"), "n").otherwise("v").alias("tag"))


def polarity(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame | None = None,
             negations=None) -> DataFrame:
    """F-11: ``(id, sentiment_polarity)`` in [-1, 1]: the mean over lexicon
    hits of ``polarity * intensity(previous word) * (-0.5 if negated)``,
    each clamped; 0 without hits. Word tokens are lower-cased runs of word
    characters."""
    from ..functions.regex import WORD
    spark = df.sparkSession
    negations = list(negations or NEGATIONS)
    if lexicon is None:
        lexicon = spark.createDataFrame(DEFAULT_POLARITY, "word string, polarity double, intensity double")
    toks = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(WORD + "+"), 0)
    ex = df.select(id_col, F.posexplode_outer(toks).alias("pos", "word")).filter(F.col("word").isNotNull())
    counted = cut_lineage(ex.groupBy("word").agg(F.count(F.lit(1)).alias("_n")))
    j = join_words(ex, counted, lexicon.select("word", "polarity", "intensity"), [id_col, "pos"])
    w = Window.partitionBy(id_col).orderBy("pos")
    j = (j.withColumn("_w1", F.lag("word", 1).over(w)).withColumn("_w2", F.lag("word", 2).over(w))
         .withColumn("_i1", F.lag("intensity", 1).over(w)).withColumn("_p1", F.lag("polarity", 1).over(w)))
    is_int1 = F.col("_i1").isNotNull() & (F.col("_i1") != 1.0) & (F.coalesce(F.col("_p1"), F.lit(0.0)) == 0.0)
    neg = F.col("_w1").isin(negations) | (is_int1 & F.col("_w2").isin(negations))
    val = (F.col("polarity") * F.when(is_int1, F.col("_i1")).otherwise(1.0)
           * F.when(neg, F.lit(NEGATION_FACTOR)).otherwise(1.0))
    hits = j.filter(F.col("polarity").isNotNull() & (F.col("polarity") != 0.0)) \
        .select(id_col, F.least(F.greatest(val, F.lit(-1.0)), F.lit(1.0)).alias("v"))
    per = hits.groupBy(id_col).agg(F.avg("v").alias("sentiment_polarity"))
    return df.select(id_col).join(per, id_col, "left").fillna(0.0, ["sentiment_polarity"])
