"""The n-gram model against a plain-Python version of the formulas."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from wryspark.llm import lm
from wryspark.llm.common import shared_path


def tokens(text):
    return (text or "").encode().lower().split() + ["</s>"]


class Reference:
    def __init__(self, texts, order):
        self.order = order
        raw = [Counter() for _ in range(order + 1)]
        for text in texts:
            seq = ["<s>", *tokens(text)]
            for i in range(1, len(seq)):
                for k in range(1, order + 1):
                    if i - k + 1 >= 0:
                        raw[k][tuple(seq[i - k + 1:i + 1])] += 1
        self.unigrams = raw[1]
        self.adjusted = [None] * (order + 1)
        for k in range(1, order + 1):
            if k == order:
                self.adjusted[k] = dict(raw[k])
                continue
            types = Counter(g[1:] for g in raw[k + 1])
            self.adjusted[k] = {g: raw[k][g] if g[0] == "<s>" else types[g] for g in raw[k]}
        self.discounts, self.context = [None], [None]
        for k in range(1, order + 1):
            n = [0] + [sum(v == j for v in self.adjusted[k].values()) for j in (1, 2, 3, 4)]
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
            d = [1 - 2 * y * n[2] / n[1] if n[1] else 0.0, 2 - 3 * y * n[3] / n[2] if n[2] else 0.0,
                 3 - 4 * y * n[4] / n[3] if n[3] else 0.0]
            self.discounts.append([min(max(x, 0.1 * j), j - 0.1 * j) for j, x in zip((1, 2, 3), d)])
            ctx = defaultdict(lambda: [0, 0, 0, 0])
            for g, v in self.adjusted[k].items():
                ctx[g[:-1]][0] += v
                ctx[g[:-1]][min(v, 3)] += 1
            self.context.append(ctx)
        self.n, self.v = sum(self.unigrams.values()), len(self.unigrams)

    def p(self, context, w):
        k = len(context) + 1
        d, c = self.discounts[k], self.context[k].get(context)
        lower = self.p(context[1:], w) if context else 1 / (self.v + 1)
        if c is None:
            return lower
        a = self.adjusted[k].get((*context, w), 0)
        return ((a - d[min(a, 3) - 1] if a else 0) + sum(x * y for x, y in zip(d, c[1:])) * lower) / c[0]

    def score(self, text):
        seq, s, b = ["<s>", *tokens(text)], 0.0, 0.0
        for i in range(1, len(seq)):
            s += math.log10(self.p(tuple(seq[max(0, i - self.order + 1):i]), seq[i]))
            b += math.log10((self.unigrams[seq[i],] + 0.1) / (self.n + 0.1 * (self.v + 1)))
        return len(seq) - 1, sum(self.unigrams[w,] > 0 for w in seq[1:]), b, s


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(40)]
    return [" ".join(rng.choices(words, [1 / (i + 1) for i in range(40)], k=rng.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_the_formulas(spark, order):
    train = corpus(80, 1) + ["zz " * 600, "", None, "one", "a\tb\x0bc  d\n", "é É x y z"] + ["copied text of five words"] * 7
    other = corpus(20, 2) + [None, "", "never seen words", "copied text of five words", "x " * 3000, "zz zz"]
    df = spark.createDataFrame([(t, 0) for t in train], "text string, score int").repartition(3)
    model = lm.fit(df, shared_path(spark, "lm"), order=order, shard_bytes=500, flush=200)
    ref = Reference(train, order)
    assert (model.tokens, model.vocabulary) == (ref.n, ref.v) and model.shards >= 8
    rows = [(i, t) for i, t in enumerate(other)] + [(None, "w1"), (0, other[0])]
    got = lm.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, text in enumerate(other):
        n, known, base, score = ref.score(text)
        assert (by[i].n_tokens, by[i].n_known) == (n, known)
        assert abs(by[i].base_score - base) < 1e-9 * abs(base) and abs(by[i].score - score) < 1e-9 * abs(score)


def test_probabilities_add_up_to_one(spark):
    train = corpus(30, 3)
    ref = Reference(train, 3)
    for context in [(), ("<s>",), (b"w0", b"w1"), (b"w39", b"w39"), (b"nowhere",)]:
        total = sum(ref.p(context, g[0]) for g in ref.unigrams) + ref.p(context, "<unknown>")
        assert abs(total - 1) < 1e-9


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    model = lm.fit(empty, shared_path(spark, "lm"))
    assert model.tokens == 0
    r = lm.score(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), model).first()
    assert (r.n_tokens, r.n_known, r.score) == (3, 0, 0.0)
    some = lm.fit(spark.createDataFrame([(1, None)], "doc_id long, text string"), shared_path(spark, "lm"))
    assert some.tokens == 1 and lm.score(empty, some).count() == 0


def test_the_query_has_two_words_of_context(spark, tmp_path):
    from wryspark.llm.queries import QUERIES
    from wryspark.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    texts = ["a b c", "x b d"] * 20
    spark.createDataFrame(list(enumerate([*texts, "a b c", "a b d"])), "doc_id long, text string") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    by = {r.doc_id: r.score for r in QUERIES["op1_kneser_ney"](spark, str(tmp_path)).collect()}
    assert by[40] > by[41] + 0.5


def test_order_four_equals_the_formulas(spark):
    train = corpus(60, 4) + ["zz " * 400, "", "one two"] + ["copied text of five words"] * 5
    other = corpus(10, 5) + ["", "never seen words at all", "copied text of five words", "w0"]
    model = lm.fit(spark.createDataFrame([(t,) for t in train], "text string").repartition(3),
                   shared_path(spark, "lm"), order=4, shard_bytes=500, flush=200)
    ref = Reference(train, 4)
    for r in lm.score(spark.createDataFrame(list(enumerate(other)), "doc_id long, text string"), model).collect():
        assert abs(r.score - ref.score(other[r.doc_id])[3]) < 1e-9 * abs(r.score)


def test_bytes_a_gram(spark):
    """The model takes under 16 bytes of disk a token, and a trigram under 9 on its way through the shuffle."""
    from urllib.parse import urlparse
    from pathlib import Path
    rng = random.Random(6)
    words = [f"w{i}" for i in range(20000)]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(20000)], k=300)) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model = lm.fit(df, shared_path(spark, "lm"), order=3)
    size = sum(f.stat().st_size for f in Path(urlparse(model.uri).path).iterdir())
    assert model.tokens == 150_500 and size < 16 * model.tokens
    runs = [["<s>", *tokens(t)] for t in texts]
    trigrams = len({g for r in runs for g in zip(r, r[1:], r[2:])})
    dealt = df.selectExpr("text as _text").coalesce(1).mapInArrow(lm._count_task(model, 2_000_000), lm._DEALT)
    assert sum(len(r.blob) for r in dealt.collect()) < 9 * trigrams


@pytest.mark.parametrize("ids", [7, 1 << 21, 1 << 23, 1 << 40])
def test_rows_are_grouped_packed_and_unpacked(ids):
    rng = np.random.default_rng(7)
    some = rng.integers(0, ids, 6, dtype=np.uint64)
    keys = [rng.choice(some, 5000) for _ in range(4)]
    keys[3][:2] = ids
    counts = rng.integers(1, 1 << 33, 5000, dtype=np.uint64)
    want = Counter()
    for *key, n in zip(*(k.tolist() for k in keys), counts.tolist()):
        want[tuple(key)] += n
    got, (sums,) = lm._grouped(keys, [counts], ids)
    assert list(zip(zip(*(k.tolist() for k in got)), sums.tolist())) == sorted(want.items())
    back, values = lm._unpack(lm._pack(got, [sums, sums % np.uint64(3)]))
    assert all((a == b).all() for a, b in zip([*got, sums, sums % np.uint64(3)], [*back, *values], strict=True))


@pytest.mark.parametrize("n", [0, 1, 5, 40, 5000])
def test_hashes_are_found_in_their_buckets(n):
    rng = np.random.default_rng(8)
    have = rng.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1)
    if n:
        # Many that differ only in the lowest bits that are kept.
        have = np.unique(np.r_[have, have[0] ^ (np.arange(200, dtype=np.uint64) << np.uint64(25))])
    wanted = np.r_[have, rng.integers(0, 1 << 63, 500, dtype=np.uint64) << np.uint64(1), have ^ np.uint64(1 << 40)]
    row = {h: i for i, h in enumerate(have.tolist())}
    assert lm._places(wanted, *lm._bucketed(have)).tolist() == [row.get(h, -1) for h in wanted.tolist()]
