"""Classifiers by held-out accuracy and on rows without signal."""

import random

from wryspark.llm import langid, quality

SYLLABLES = {"aa": "the ing tion and wh sh".split(), "bb": "ung sch ein ße ä ö".split(), "cc": "eau qu é è ois ment".split()}


def text_in(lang, rng, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def test_languages(spark):
    rng = random.Random(1)
    rows = [(i, text_in(lang, rng, rng.randint(3, 60)), lang, 0.5) for i in range(600) for lang in [rng.choice("abc") * 2]]
    train, held = rows[:400] + [(None, "no language", None, 0.0), (1, None, "aa", 0.0), (2, "123", "aa", 0.0)], rows[400:]
    schema = "doc_id long, text string, lang string, score double"
    model = langid.fit(spark.createDataFrame(train, schema), rows_per_language=50, clusters=3)
    assert sorted(set(model.languages)) == ["aa", "bb", "cc"] and len(model.languages) <= 9
    odd = [(1000, None, None, 0.0), (1001, "", None, 0.0), (1002, "12 .,! \n", None, 0.0), (None, "ung sch", None, 0.0),
           (1003, "the " * 200_000, None, 0.0), (1004, "The ING", None, 0.0), (1004, "The ING", None, 0.0)]
    got = langid.predict(spark.createDataFrame(held + odd, schema).repartition(3), model).collect()
    assert len(got) == len(held) + len(odd)
    by = {r.doc_id: r for r in got}
    assert sum(by[i].lang_pred == lang for i, _, lang, _ in held) >= 0.98 * len(held)
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) and by[i].rejected for i in (1000, 1001, 1002))
    assert by[None].lang_pred == "bb" and by[1003].lang_pred == by[1004].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in got)


def test_no_languages_to_learn(spark):
    schema = "doc_id long, text string, lang string"
    for rows in ([], [(1, "text", None)], [(1, None, "aa")], [(1, "123", "aa")]):
        model = langid.fit(spark.createDataFrame(rows, schema))
        r = langid.predict(spark.createDataFrame([(1, "text", "x")], schema), model).first()
        assert (r.lang_pred, r.score) == ("und", 0.0)
        assert langid.predict(spark.createDataFrame([], schema), model).count() == 0


def good(rng):
    return text_in("aa", rng, rng.randint(20, 200))


def bad(rng):
    if rng.random() < 0.5:
        return " ".join(w + rng.choice(["###", "%%%", "$$$"]) for w in text_in("aa", rng, rng.randint(20, 100)).split())
    return (text_in("aa", rng, 1) + " ") * rng.randint(30, 200)


def test_quality(spark):
    rng = random.Random(2)
    rows = [(i, bad(rng) if i % 4 == 0 else good(rng)) for i in range(1200)]
    labels = [(i, int(i % 4 != 0)) for i in range(800)] + [(5, None), (None, 1), (6, 7), (99_999, 0)]
    docs = spark.createDataFrame([(a, b, "s") for a, b in rows], "doc_id long, text string, score string").repartition(3)
    model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"), rows_per_class=300)
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert len(got) == 1200
    held = range(800, 1200)
    assert sum((got[i] >= 0.5) == (i % 4 != 0) for i in held) >= 0.97 * len(held)
    assert all(got[i] >= 0.5 for i in held if i % 4)
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "x" * 3_000_000), (2, "x" * 3_000_000)], "doc_id long, text string")
    out = quality.score(odd, model).collect()
    assert len(out) == 4 and all(0 <= r.score <= 1 for r in out)
    kept = {r.doc_id for r in quality.accepted(docs, model).collect()}
    assert kept == {i for i, s in got.items() if s >= 0.5}
    assert quality.accepted(docs, model).columns == docs.columns


def plain_scores(texts, learn, order, half, piece=200, level=3, size=112 * 1024):
    """Texts' scores from ``learn`` [(id, text, label)] in plain Python; the
    ids' hashes come from outside."""
    import numpy as np
    import zstandard
    learn = sorted({(order[i], t.encode(), y, half[i]) for i, t, y in learn}, key=lambda r: r[0])
    packs = []
    for y in (1, 0):
        samples = [t[k:k + 1000] for _, t, label, h in learn if (label, h) == (y, 0) for k in range(0, len(t), 1000)]
        made = zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 8)), samples, k=64, d=8, level=level)
        packs.append(zstandard.ZstdCompressor(level=level, dict_data=made, write_content_size=False, write_checksum=False, write_dict_id=False))

    def difference(t):
        if not t:
            return 0.0
        g, b = (sum(len(p.compress(t[k:k + piece])) for k in range(0, len(t), piece)) for p in packs)
        return (b - g) / min(b, g)

    seen = {}
    for _, t, y, h in learn:
        if h == 1:
            seen.setdefault(difference(t), []).append(y)
    # The isotonic curve by its min-max formula.
    xs = sorted(seen)
    n, s = [len(seen[x]) for x in xs], [sum(seen[x]) for x in xs]
    value = [max(min(sum(s[a:b + 1]) / sum(n[a:b + 1]) for b in range(i, len(xs))) for a in range(i + 1)) for i in range(len(xs))]
    steps = []
    for v in sorted(set(value)):
        at = [i for i, u in enumerate(value) if abs(u - v) < 1e-12]
        step = [xs[at[0]], xs[at[-1]], sum(s[i] for i in at), sum(n[i] for i in at)]
        if steps and (steps[-1][3] < 10 or steps[-1][0] == step[0]):
            old = steps.pop()
            step = step if old[0] == step[0] else [old[0], step[1], old[2] + step[2], old[3] + step[3]]
        steps.append(step)
    if len(steps) > 1 and steps[-1][3] < 10:
        last = steps.pop()
        steps[-1] = [steps[-1][0], last[1], steps[-1][2] + last[2], steps[-1][3] + last[3]]
    top = np.maximum.accumulate([(c + 1) / (m + 2) for _, _, c, m in steps]).tolist()
    curve = []
    for i, (lo, hi, _, _) in enumerate(steps):
        lo = np.nextafter(steps[i - 1][1], np.inf) if i else lo
        curve += [(lo, top[i] - 0.1 * (top[i] - (top[i - 1] if i else 0))), (hi, top[i] + 0.1 * ((top + [1])[i + 1] - top[i]))]
    return [float(np.interp(difference(t.encode()), *map(list, zip(*curve)))) for t in texts]


def test_quality_against_plain_python(spark):
    from pyspark.sql import functions as F
    rng = random.Random(6)
    rows = [(i, bad(rng) if i % 3 == 0 else good(rng) if i % 5 else good(rng) + " " + bad(rng)) for i in range(160)]
    learn = [(i, t, int(i % 3 != 0)) for i, t in rows[:120]]
    rows += [(200, ""), (201, "x"), (202, good(rng) * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ids = docs.select("doc_id", F.xxhash64(F.lit(9), "doc_id").alias("o"), F.pmod(F.xxhash64(F.lit(10), "doc_id"), F.lit(2)).alias("h")).collect()
    want = plain_scores([t for _, t in rows], learn, {r.doc_id: r.o for r in ids}, {r.doc_id: r.h for r in ids})
    model = quality.fit(docs, spark.createDataFrame([(i, y) for i, _, y in learn], "doc_id long, quality int"))
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert all(abs(got[i] - w) < 1e-9 for (i, _), w in zip(rows, want))


def test_a_repeated_id_does_not_crowd_out_the_others(spark):
    rng = random.Random(7)
    rows = [(i, bad(rng) if i % 4 == 0 else good(rng)) for i in range(400)]
    labels = [(i, int(i % 4 != 0)) for i in range(400)] + [(1000, 0), (1001, 0)]
    many = [(1000, f"{good(rng)} {k}") for k in range(6000)] + [(1001, "the same text")] * 7000
    docs = spark.createDataFrame(rows + many, "doc_id long, text string").repartition(4)
    model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"), rows_per_class=300)
    got = {r.doc_id: r.score for r in quality.score(docs.filter("doc_id < 400"), model).collect()}
    assert sum((got[i] >= 0.5) == (i % 4 != 0) for i in range(400)) >= 0.95 * 400


def test_the_byte_bound_takes_whole_texts(spark):
    rows = [{"_size": n} for n in (5, 100, 3, 7, 1)]
    assert quality._chosen(rows, 9) == [{"_size": 5}, {"_size": 3}, {"_size": 1}]


def test_quality_with_one_class_or_none(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    for labels in ([], [(1, 1), (2, 1)], [(77, 0), (78, 1)], [(1, 0), (2, 1)]):
        model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        scores = [r.score for r in quality.score(docs, model).collect()]
        assert len(scores) == 20 and all(0 <= s <= 1 for s in scores)
    assert quality.score(docs.limit(0), model).count() == 0


def test_dictionaries_see_what_stands_late_in_long_texts(spark):
    rng = random.Random(3)
    marks = [["".join(rng.choices("abcdefghij", k=60)) for _ in range(10)] for _ in range(2)]
    rows = [(i, "".join(chr(rng.randint(48, 122)) for _ in range(4500)) + " ".join(rng.choices(marks[i % 2], k=80)))
            for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(160)], "doc_id long, quality int"))
    assert sum(m.encode()[10:50] in model.good for m in marks[1]) >= 8
    assert sum(m.encode()[10:50] in model.bad for m in marks[0]) >= 8


def test_languages_of_copied_texts_and_small_ones_are_learnt(spark):
    rng = random.Random(4)
    # Rows of "aa" hold one text 4,000 times: by rows, it would be drawn with a share of 1.5 * 10 / 4,000.
    rows = [("the wing " * 5, "aa")] * 4000 + [(text_in("bb", rng, 9), "bb") for _ in range(30)] + [("eau qu", "cc")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    for most in (1000, 1):
        model = langid.fit(docs, rows_per_language=10, clusters=2, max_languages=most)
        assert sorted(set(model.languages)) == ["aa", "bb", "cc"]
