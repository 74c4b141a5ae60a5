"""Winnowing against all windows, and rows without hits."""

import random
import re

from wryspark.llm import winnow

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def reference(docs, items, window=10):
    spans = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            spans.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for d, text in docs:
        w, hit, ids = words(text), set(), set()
        for n in {len(s) for s in spans}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in spans:
                    ids |= spans[tuple(w[i:i + n])]
                    hit.update(range(i, i + n))
        out.append((d, len(w), len(hit), sorted(str(i) for i in ids if i is not None)))
    return out


def run(spark, docs, items, **more):
    d = spark.createDataFrame([(a, t, 0) for a, t in docs], "doc_id long, text string, n_hit int").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in winnow.contaminated_words(d, b, **more).collect()),
                  key=str)


def cases():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)] + ["Ünï", "9x"]
    text = lambda n: rng.choice([" ", ", ", "-"]).join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.randint(1, 40))) for i in range(25)]
    items += [(30, None), (31, ""), (32, "..."), (33, "same " * 30), (33, "second text of one id, " * 3), (None, items[9][1]),
              (34, items[9][1]), (35, "two words")]
    docs = [(i, text(rng.randint(0, 80))) for i in range(40)]
    docs += [(50 + i, text(20) + " " + (t or "").upper() + "! " + text(15)) for i, (_, t) in enumerate(items)]
    docs += [(90, None), (91, ""), (92, "?!"), (93, "same " * 3000), (None, docs[45][1]), (45, docs[45][1]), (45, docs[50][1]),
             (94, "a two words b"), (95, items[1][1]), (96, "\x00Two\x7fWORDS"), (97, "twoéwords")]
    return docs, items


def test_against_all_windows(spark):
    docs, items = cases()
    assert run(spark, docs, items) == sorted(reference(docs, items), key=str)


def test_other_window_and_no_broadcast(spark):
    docs, items = cases()
    assert run(spark, docs, items, window=7, k=3, broadcast_rows=0) == sorted(reference(docs, items, 7), key=str)


def test_empty_tables(spark):
    docs, items = cases()
    assert run(spark, [], items) == []
    assert run(spark, docs[:3], []) == [(i, len(words(t)), 0, []) for i, t in docs[:3]]


def test_rows_without_hits_keep_their_columns(spark):
    docs, items = cases()
    d = spark.createDataFrame([(a, t, "kept") for a, t in docs], "doc_id long, text string, _k1 string")
    got = sorted(((r.doc_id, r.text) for r in winnow.uncontaminated(
        d, spark.createDataFrame(items, "item_id long, text string")).collect()), key=str)
    assert got == sorted(((d, t) for (d, t), r in zip(docs, reference(docs, items)) if not r[2]), key=str)
