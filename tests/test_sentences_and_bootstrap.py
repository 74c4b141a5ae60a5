"""Learned abbreviations, the splitting by them, and the bootstrapped mean."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from wryspark.operators import rouge as RG
from wryspark.operators import sentences as SE

PLAIN = ["cat", "house", "walked", "blue", "a", "the", "over", "tree", "said", "went", "old", "town"]


def corpus(rng, n=400):
    out = []
    for _ in range(n):
        text = []
        for _ in range(rng.randint(1, 6)):
            words = [rng.choice(PLAIN) for _ in range(rng.randint(3, 9))]
            if rng.random() < 0.5:
                words.insert(rng.randint(1, len(words) - 1), rng.choice(["dr. Smith", "(e.g. this)", "Mr. Jones", "u.s. made"]))
            text.append(" ".join(words) + rng.choice([".", "!", "?", '."', ".)"]))
        out.append("  ".join(text))
    return out


def plain_scores(texts):
    n, dots = Counter(), Counter()
    for t in texts:
        for token in (t or "").split():
            w = re.sub(r"^[\"'(\[]+|[\"')\],;:!?]+$", "", token).lower()
            word = w[:-1] if w.endswith(".") else w
            if re.fullmatch(r"[^\W\d_](?:[^\W\d_]|\.)*", word):
                n[word] += 1
                dots[word] += w.endswith(".")
    rate = sum(dots.values()) / sum(n.values())
    found = {}
    for w, d in dots.items():
        if d:
            rest, periods = n[w] - d, w.count(".") + 1
            letters = len(w) - w.count(".")
            ll = -2 * (d * math.log(rate) + (rest * math.log(1 - rate) if rest else 0) - d * math.log(0.99) - rest * math.log(0.01))
            found[w] = ll * math.exp(-letters) * periods * letters ** -rest
    return {w: s for w, s in found.items() if s >= 0.3}


def test_planted_abbreviations_are_learnt_and_end_no_sentence(spark):
    texts = corpus(random.Random(3)) + [None, "", " . ", "no end", "Ends with dr."]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, t string").repartition(3)
    abbr = SE.learn_abbreviations(docs, "t").checkpoint()
    got = {r.word: r.score for r in abbr.collect()}
    want = plain_scores(texts)
    assert set(got) == set(want) == {"dr", "e.g", "mr", "u.s"} and all(abs(got[w] - want[w]) < 1e-6 for w in want)
    cut = {r.id: r.sentences for r in SE.split_sentences(docs, "id", "t", abbr).collect()}
    assert len(cut) == len(texts)
    for i, t in enumerate(texts[:400]):
        ends = [m for m in re.finditer(r"[.!?][\"')\]]*(?=\s|$)", t) if not re.search(r"(?i)(dr|e\.g|mr|u\.s)\.$", t[:m.end()])]
        assert len(cut[i]) == len(ends), t
        assert " ".join(cut[i]).split() == t.split()
    assert cut[400] == cut[401] == [] and cut[402] == ["."] and cut[403] == ["no end"] and cut[404] == ["Ends with dr."]
    none = SE.split_sentences(docs, "id", "t", abbr.limit(0)).filter("id = 404").first()
    assert none.sentences == ["Ends with dr."]


def test_pieces_are_joined_without_a_fold(spark):
    docs = spark.createDataFrame([(1, "Ask (Dr. No) or\tdr. Who. Then\u2028dr. go dr."), (2, "It's a dr.\u2028 No end")], "id long, t string")
    cut = SE.split_sentences(docs, "id", "t", spark.createDataFrame([("dr",)], "word string"))
    assert "aggregate(" not in cut._jdf.queryExecution().optimizedPlan().toString()
    got = {r.id: r.sentences for r in cut.collect()}
    assert got[1] == ["Ask (Dr. No) or\tdr. Who.", "Then\u2028dr.", "go dr."] and got[2] == ["It's a dr.\u2028 No end"]


def test_abbreviations_of_nothing(spark):
    docs = spark.createDataFrame([(1, "no period here"), (2, None)], "id long, t string")
    assert SE.learn_abbreviations(docs, "t").count() == 0
    assert SE.learn_abbreviations(docs.limit(0), "t").count() == 0


def test_poisson_steps_follow_the_distribution():
    share = np.diff([0, *RG.POISSON_STEPS, 65536]) / 65536
    for k, p in enumerate(share[:6]):
        assert abs(p - math.exp(-1) / math.factorial(k)) < 2e-5


def test_bootstrap_brackets_the_mean(spark):
    rng = np.random.default_rng(1)
    values = rng.uniform(0, 1, 400)
    df = spark.createDataFrame([(i, float(v), 0.25) for i, v in enumerate(values)], "id long, a double, b double").repartition(4)
    r = {x.metric: x for x in RG.bootstrap_scores(df, "id", ["a", "b"], replicates=500).collect()}
    assert (r["b"].low, r["b"].mid, r["b"].high) == (0.25, 0.25, 0.25)
    se = values.std() / 20
    assert abs(r["a"].mid - values.mean()) < 0.5 * se
    assert abs((r["a"].high - r["a"].low) / (2 * 1.96 * se) - 1) < 0.2
    again = {x.metric: x for x in RG.bootstrap_scores(df.repartition(2), "id", ["a", "b"], replicates=500).collect()}
    assert again == r
