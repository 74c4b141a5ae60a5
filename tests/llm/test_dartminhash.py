"""Near-duplicate classes against all pairs, and the signatures' estimate."""

import random
from collections import Counter

import numpy as np

from wryspark.llm import dartminhash as D


def shingles(text):
    w = (text or "").encode().lower().split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similar(a, b):
    return sum((a & b).values()) >= 0.8 * sum((a | b).values()) - 1e-9


def reference(docs):
    sets, parent = {d: shingles(t) for d, t in docs if d is not None}, {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        root(a)
        for b in ids[:i]:
            if sets[a] and sets[b] and similar(sets[a], sets[b]):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {d: root(d) for d in ids}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.random():.6f}"
    return " ".join(words)


def cases():
    rng = random.Random(8)
    docs = []
    for g in range(25):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(40, 300))]
        for _ in range(rng.randint(1, 9)):
            docs.append((len(docs) * 2, edited(rng, base, rng.randint(0, len(base) // 30))))
    docs += [(3001, docs[3][1].upper()), (3003, docs[3][1].replace(" ", "\n ")), (3005, None), (3007, ""), (3009, " \t"),
             (3011, "one two"), (3013, "ONE two"), (3015, "one"), (3017, "same " * 5000), (3019, "same " * 4900), (3021, "same " * 10)]
    return docs


def run(spark, docs, **more):
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, class_id int").repartition(3)
    return D.near_duplicates(df, **more).collect()


def test_against_all_pairs(spark):
    docs = cases()
    want = reference(docs)
    for more in ({}, {"block_texts": 3, "block_words": 4000}):
        got = run(spark, docs, **more)
        assert {r.doc_id: r.class_id for r in got} == want
        assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_repeated_rows_and_null_ids(spark):
    docs = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (4, "other words here"),
            (4, "a b c d e f"), (None, None)]
    got = Counter((r.doc_id, r.class_id, r.kept) for r in run(spark, docs))
    assert got == Counter({(1, 1, True): 2, (2, 1, False): 1, (None, None, True): 2, (4, 4, True): 1, (4, 1, False): 1})
    df = spark.createDataFrame([(d, t, "s") for d, t in docs], "doc_id long, text string, _hash string")
    left = Counter((r.doc_id, r.text) for r in D.without_duplicates(df).collect())
    assert left == Counter({(1, "a b c d e f"): 1, (None, "a b c d e f"): 1, (4, "other words here"): 1, (None, None): 1})
    assert D.without_duplicates(df).columns == df.columns


def test_empty(spark):
    assert run(spark, []) == []


def test_signatures_estimate_the_weighted_similarity():
    rng = random.Random(9)
    a = " ".join(f"w{rng.randint(0, 60)}" for _ in range(400))
    texts = [a, edited(rng, a.split(), 12), "x " * 300, "x " * 240, "y"]
    k = 4000
    unit, first, *_ = D.elements([t.encode() for t in texts])
    sig = D.signatures(unit, first, k)
    assert (sig != 0).all()
    for i in range(len(texts)):
        for j in range(i):
            x, y = shingles(texts[i]), shingles(texts[j])
            true = sum((x & y).values()) / sum((x | y).values())
            assert abs((sig[i] == sig[j]).mean() - true) < 5 * np.sqrt(0.25 / k)
