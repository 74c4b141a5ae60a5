"""Lexicons of real size, a word that half of the tokens are, and tags."""

from pyspark.sql import functions as F

from wryspark.operators import lexicon as LX
from wryspark.sources import files as FS

N = 100_000


def test_stored_lexicons_of_100_000_words_and_a_hot_word(spark):
    path = FS.scratch_path(spark, "lexicon")
    words = spark.range(N).select(F.concat(F.lit("w"), F.col("id")).alias("word"), F.col("id"))
    words.select("word", ((F.col("id") % 21 - 10) / 10.0).alias("polarity"), F.lit(1.0).alias("intensity")) \
        .union(spark.createDataFrame([("hot", 1.0, 1.0)], "word string, polarity double, intensity double")).write.parquet(f"{path}/polarity")
    words.select(F.concat("word", F.lit("s")).alias("word"), F.lit("n").alias("tag"), F.concat(F.lit("l"), "id").alias("lemma")) \
        .union(spark.createDataFrame([("hot", "n", "cool")], "word string, tag string, lemma string")).write.parquet(f"{path}/lemmas")
    # Half of all tokens are one word; the others are spread over the lexicon.
    docs = spark.range(20_000).select(F.col("id").alias("row_id"), F.array(
        F.lit("hot"), F.concat(F.lit("w"), (F.col("id") * 7) % N, F.lit("s")), F.lit("hot"), F.concat(F.lit("w"), F.col("id") * 3)).alias("toks")) \
        .withColumn("text", F.array_join("toks", " ")).repartition(4)
    lem = LX.lemmatize(docs, "row_id", "toks", "out", vocab=spark.createDataFrame([], "word string"), exceptions=spark.read.parquet(f"{path}/lemmas"), pos_mode=False)
    pol = LX.polarity(docs, "row_id", "text", spark.read.parquet(f"{path}/polarity"))
    got = lem.join(pol, "row_id").orderBy("row_id").collect()
    assert len(got) == 20_000
    for i in range(0, 20_000, 371):
        assert got[i].out == f"cool l{i * 7 % N} cool w{i * 3}"
        own = (i * 3 % 21 - 10) / 10
        hits = [1.0, 1.0] + ([own] if own else [])
        assert abs(got[i].sentiment_polarity - sum(hits) / len(hits)) < 1e-9


def test_the_tokens_of_a_hot_word_are_dealt_out(spark):
    tokens = spark.range(100_000).select(F.col("id"), F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.concat(F.lit("w"), F.col("id"))).alias("word"))
    counted = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("_n"))
    table = spark.createDataFrame([("hot", 1), ("w10", 2), ("other", 3)], "word string, v int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = LX.join_words(tokens, counted, table, ["id"]).withColumn("_task", F.spark_partition_id())
        sizes = [r["count"] for r in out.groupBy("_task").count().collect()]
        assert max(sizes) < 1.2 * 100_000 / len(sizes) and len(sizes) == 4
        got = {r.word: (r.n, r.v) for r in out.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("v")).filter("v is not null").collect()}
        assert got == {"hot": (90_000, 1), "w10": (1, 2)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_context_tags(spark):
    rows = [(1, "the run was long".split()), (2, "to run the race".split()), (3, "to run".split()), (4, None), (5, []), (6, ["the"]), (7, ["The", None])]
    df = spark.createDataFrame(rows, "row_id long, toks array<string>")
    tags = {r.word: r.tag for r in LX.context_tags(df, "toks", ["the"], ["to"]).collect()}
    assert tags == {"run": "v", "race": "n"}
    out = LX.lemmatize(spark.createDataFrame([(1, ["lies"])], "row_id long, toks array<string>"), "row_id", "toks",
                       vocab=spark.createDataFrame([("lie",), ("ly",)], "word string"), tags=spark.createDataFrame([("lies", "n")], "word string, tag string"))
    assert out.first().lemmatized == "ly"


def test_lemmas_are_put_into_whole_texts(spark):
    rows = [(1, "dogs ran home".split()), (2, None), (3, []), (None, ["dogs", None, "dog"]), (4, ["dogs", "b"]), (4, ["a", "cats", "c"]), (4, None)]
    df = spark.createDataFrame(rows, "row_id long, toks array<string>")
    vocab = spark.createDataFrame([("dog",), ("cat",)], "word string")
    lem = LX.lemmatize(df, "row_id", "toks", "out", vocab=vocab)
    assert {r.row_id: r.out for r in lem.collect()} == {1: "dog ran home", 2: "", 3: "", None: "dog dog", 4: "a dog b cat c"}
    assert "Generate" not in lem._jdf.queryExecution().optimizedPlan().toString()


def test_rare_words_are_replaced_beyond_the_broadcast_ones(spark):
    rows = [(i, [f"w{i % 7}", "kept", f"w{i % 5}", None]) for i in range(40)] + [(None, ["w6", "w0"]), (50, None), (50, ["w1"])]
    df = spark.createDataFrame(rows, "row_id long, toks array<string>")
    changed = spark.createDataFrame([(f"w{k}", f"l{k}", 40 - k) for k in range(7)], "word string, lemma string, _n long")

    def got(limit):
        return sorted(map(str, LX.replace_words(df, "row_id", "toks", changed, limit).collect()))
    want = sorted(str(r) for r in spark.createDataFrame(
        [(i, t and [w and w.replace("w", "l") for w in t]) for i, t in rows], "row_id long, toks array<string>").collect())
    assert got(100) == want and got(3) == want and got(7) == want
