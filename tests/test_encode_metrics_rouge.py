"""Padding, sequences, metrics, ROUGE and the HTML body rule."""

from pyspark.sql import functions as F

from tests import plain_lcs as plain
from tests.plain_html import extract_body
from wryspark.functions import lcs as LC
from wryspark.operators import encode as EN
from wryspark.operators import metrics as M
from wryspark.operators import rouge as RG


def test_pad(spark):
    df = spark.createDataFrame([([5, 6, 7],)], "ids array<int>")
    r = df.select(EN.pad("ids", 5).alias("a"), EN.pad("ids", 2).alias("b")).first()
    assert r.a == [5, 6, 7, 0, 0] and r.b == [5, 6]
    ids, mask = EN.with_markers("ids", 6, 100, 101)
    r = df.select(ids.alias("i"), mask.alias("m")).first()
    assert r.i == [100, 5, 6, 7, 101, 0] and r.m == [1, 1, 1, 1, 1, 0]


def test_word_ids_rank_and_oov(spark):
    df = spark.createDataFrame([(1, "b a b"), (2, "a c d")], "row_id long, t string") \
        .withColumn("toks", EN.sequence_tokens("t"))
    vocab = EN.word_index(df, "toks", num_words=4)
    assert {r.word: r.id for r in vocab.collect()} == {"b": 2, "a": 3}
    seq = {r.row_id: r.ids for r in EN.to_sequences(df, "toks", vocab).collect()}
    assert seq == {1: [2, 3, 2], 2: [3, 1, 1]}


def test_tfidf_rows_unit_norm(spark):
    df = spark.createDataFrame([(1, "the cat sat"), (2, "the dog"), (3, "a b")], "row_id long, t string")
    w = EN.tfidf_long(df, "t")
    norms = w.groupBy("row_id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(abs(r.n - 1) < 1e-12 for r in norms)


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 1), (1, 1)], "label int, prediction int")
    s = M.binary_scores(df).first()
    assert abs(s.accuracy - 0.6) < 1e-12
    assert abs(s.precision - 2 / 3) < 1e-12 and abs(s.recall - 2 / 3) < 1e-12 and abs(s.f1 - 2 / 3) < 1e-12
    cm = {r.label: (r.pred_0, r.pred_1) for r in M.confusion_matrix(df).collect()}
    assert cm == {0: (1, 1), 1: (1, 2)}
    rep = {r.row_name: r for r in M.classification_report(df).collect()}
    assert rep["accuracy"].support == 5 and abs(rep["1"].f1 - 2 / 3) < 1e-12


def test_rouge_fixture(spark):
    pairs = spark.createDataFrame([(1, "the cat sat", "the cat was sat"), (2, "same words", "same words")],
                                  "id long, p string, r string")
    r1 = {r.id: r.fmeasure for r in RG.rouge_n(pairs, "id", "p", "r", 1).collect()}
    r2 = {r.id: r.fmeasure for r in RG.rouge_n(pairs, "id", "p", "r", 2).collect()}
    rl = {r.id: r.fmeasure for r in RG.rouge_l(pairs, "id", "p", "r").collect()}
    ls = {r.id: r.fmeasure for r in RG.rouge_lsum(pairs, "id", "p", "r").collect()}
    assert abs(r1[1] - 6 / 7) < 1e-12 and abs(r2[1] - 2 / 5) < 1e-12 and abs(rl[1] - 6 / 7) < 1e-12
    assert abs(ls[1] - 6 / 7) < 1e-12
    assert r1[2] == r2[2] == rl[2] == ls[2] == 1.0


def test_lcs_bit_parallel_matches_table():
    import random
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.choice("abcd") for _ in range(rng.randint(0, 12))]
        b = [rng.choice("abcd") for _ in range(rng.randint(0, 12))]
        assert plain.lcs_length(a, b) == plain.lcs_table(a, b)[len(a)][len(b)]


def test_lcs_columns_match_plain_python(spark):
    import random
    rng = random.Random(2)
    def words(n, letters):
        return [rng.choice(letters) for _ in range(n)]
    rows = []
    for i in range(120):
        letters = rng.choice(["ab", "abcd", "abcdefghij"])
        a, b = words(rng.choice([0, 1, 5, 61, 62, 63, 130]), letters), words(rng.choice([0, 1, 7, 62, 90]), letters)
        refs = [words(rng.randint(1, 14), letters) for _ in range(rng.randint(0, 4))]
        cands = [words(rng.choice([1, 3, 12, 70]), letters) for _ in range(rng.randint(0, 3))]
        rows.append((i, a, b, refs, cands))
    df = spark.createDataFrame(rows, "id int, a array<string>, b array<string>, refs array<array<string>>, cands array<array<string>>")
    got = {r.id: r for r in df.select("id", LC.lcs_length(F.col("a"), F.col("b")).alias("n"),
                                      LC.union_hits(F.col("refs"), F.col("cands")).alias("hits")).collect()}
    for i, a, b, refs, cands in rows:
        assert got[i].n == plain.lcs_length(a, b)
        assert got[i].hits == plain.summary_lcs_hits(refs, cands)[0]


def test_html_body_rule():
    html = "<p>Hi <b>x</b> tail</p><div>no</div><p>Sign Up now</p><i>z</i>"
    title, body = extract_body(html)
    assert body == "Hi  x  tail z"
    malformed = ("<html><head><title>T &amp; U</title><script>var t='</p>';</script></head>"
                 "<body><p><b>Head<br><p>Para one.<!-- c --></p><p>HuffPost ad</p></body></html>")
    title, body = extract_body(malformed)
    assert title == "T & U" and body == "Head Para one."
