"""Sentence spans against a plain-Python version."""

import random
import re

from wryspark.llm import spans

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def units_of(text, unit_words):
    """[(byte start, words)] of each unit."""
    data, out, last, size = text.encode(), [], None, 0
    for m in WORD.finditer(data):
        new = last is None or data[last - 1:last] in (b".", b"!", b"?") or b"\n" in data[last:m.start()]
        size = 0 if new else size + 1
        if size % unit_words == 0:
            out.append([m.start(), []])
        out[-1][1].append(m[0].lower())
        last = m.end()
    return out


def reference(docs, unit_words=12, min_units=3, min_words=20):
    seen, marks = {}, {}
    for key in sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0)):
        units = units_of(key[1] or "", unit_words)
        for i in range(len(units)):
            words, j = [], i
            while j < len(units) and (j - i < min_units or len(words) < min_words):
                words += units[j][1]
                j += 1
            if j - i >= min_units and len(words) >= min_words:
                if seen.setdefault(tuple(words), (key, i)) != (key, i):
                    marks.setdefault(key, set()).update(range(i, j))
    out = {}
    for key in set(docs):
        units, text = units_of(key[1] or "", unit_words), (key[1] or "").encode()
        edges = [0, *(u[0] for u in units[1:]), len(text)] if units else [0, len(text)]
        kept = b"".join(text[a:b] for k, (a, b) in enumerate(zip(edges, edges[1:])) if k not in marks.get(key, ()))
        out[key] = (None if key[1] is None else kept.decode(), len(units), len(marks.get(key, ())))
    return out


def run(spark, docs, **more):
    df = spark.createDataFrame([(d, t, "n") for d, t in docs], "doc_id long, text string, n_units string").repartition(3)
    return spans.remove_repeats(df, **more).collect()


def sentences(rng, n):
    return [" ".join(rng.choices("alpha beta gamma delta eps zeta eta theta".split(), k=rng.randint(1, 30))) + rng.choice(".!?\n")
            for _ in range(n)]


def test_against_the_plain_version(spark):
    rng = random.Random(5)
    passage = " ".join(sentences(rng, 6))
    docs = []
    for i in range(60):
        s = sentences(rng, rng.randint(0, 12))
        if i % 4 == 0:
            s.insert(rng.randint(0, len(s)), "\n" + passage.upper() + "\n")
        docs.append((i, " ".join(s)))
    docs += [(70, docs[8][1]), (71, None), (72, ""), (73, " \n\t "), (74, "x. " * 4000), (None, docs[12][1]),
             (8, docs[8][1]), (9, "another text of the same id. " + passage)]
    want = reference(docs)
    got = run(spark, docs)
    assert len(got) == len(docs)
    texts = {}
    for d, t in docs:
        texts.setdefault(d, []).append(want[d, t])
    for r in got:
        assert (r.text, r.n_units, r.n_removed) in texts[r.doc_id]
    assert sum(r.n_removed > 0 for r in got) >= 15


def test_a_passage_of_over_fifty_words_goes_and_clean_text_stays(spark):
    rng = random.Random(6)
    line = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    passage = line(53) + "."
    docs = [(i, f"{line(40)}.\n{passage if i % 2 else line(53)}\n{line(30)}.\nA short line for all.") for i in range(20)]
    by = {r.doc_id: r for r in run(spark, docs)}
    assert by[1].n_removed == 0 and all(by[i].n_removed == 0 for i in range(0, 20, 2))
    assert all(by[i].removed_words >= 40 for i in range(3, 20, 2))
    assert all(by[i].text.startswith(docs[i][1].split("\n")[0]) for i in range(20))


def test_empty_table_and_carried_columns(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "t", "src", 5)], "doc_id long, text string, n_removed string, carried int")
    r = spans.remove_repeats(df, carry=("n_removed", "carried")).first()
    assert r.text == "t" and r.n_removed == 0 and tuple(r.carried) == ("src", 5)


def test_a_passage_between_random_words_goes_wherever_it_stands(spark):
    rng = random.Random(7)
    line = lambda n: ["".join(rng.choices("abcdefgh", k=6)) for _ in range(n)]
    docs, least = [], []
    for i in range(120):
        passage = line(rng.choice([51, 60, 100]))
        if i % 2:
            for at in range(rng.randint(0, 8), len(passage), rng.randint(4, 25)):
                passage[at] += rng.choice(".!?")
        for _ in range(2):
            docs.append((len(docs), " ".join([*line(rng.randint(0, 40)), *passage, *line(rng.randint(0, 40))])))
        least.append(len(passage))
    by = {r.doc_id: r for r in run(spark, docs, by_words=True)}
    assert all(by[2 * i].n_removed == 0 for i in range(120))
    gone = [by[2 * i + 1].removed_words for i in range(120)]
    assert all(0 < g <= n for g, n in zip(gone, least))
    assert sum(gone) >= 0.6 * sum(least)


def units_by_words(text, unit_words):
    """Byte starts of the units that depend on words, window by window."""
    words = spans.Words([text.encode()])
    h = [int(x) for x in words.hashes()]
    whole = [start for start, _ in units_of(text, 10 ** 9)]
    starts = [int(x) for x in words.start]
    out, edges = set(whole), [*(starts.index(s) for s in whole), len(starts)]
    for a, b in zip(edges, edges[1:]):
        key = [int(spans.mix(spans.np.array([(h[i] * int(spans._PAIR) + (h[i + 1] if i + 1 < b else 0)) % 2 ** 64],
                                            spans.np.uint64))[0]) for i in range(a, b)]
        if b - a > unit_words:
            for at in range(b - a - unit_words + 1):
                out.add(starts[a + min(range(at, at + unit_words), key=lambda k: (key[k], -k))])
    return sorted(out)


def test_units_by_words_against_windows(spark):
    rng = random.Random(8)
    texts = [" ".join(sentences(rng, rng.randint(0, 12))) for _ in range(40)] + ["a " * 50, "x. " * 30, ""]
    for text in texts:
        words = spans.Words([text.encode()])
        unit, _ = spans._units(words, 12, True)
        assert words.start[unit].tolist() == units_by_words(text, 12)
        assert (spans.np.diff(spans.np.r_[unit, len(words.start)]) <= 12).all()
    together = spans.Words([t.encode() for t in texts])
    unit, first = spans._units(together, 12, True)
    assert spans.np.diff(first).tolist() == [len(units_by_words(t, 12)) for t in texts]
