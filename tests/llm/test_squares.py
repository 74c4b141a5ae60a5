"""Runs of repeated words against every period at every place."""

import random

import numpy as np
import pytest

from wryspark.llm import squares
from wryspark.llm.squares import SquareCatchers, repeated_runs, runs_of


def brute(words, least=6, exponent=4):
    """Maximal stretches for each period; of equal ones the smallest period."""
    found = {}
    for p in range(1, len(words) // exponent + 1):
        i = 0
        while i + p < len(words):
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            if i + p - start >= max(least, exponent * p):
                found.setdefault((start, i + p - start), p)
    return sorted((s, n, p) for (s, n), p in found.items())


def cut(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def cases():
    rng = random.Random(5)
    for n in list(range(0, 40)) + [60, 100, 200, 333]:
        for letters in "a", "ab", "abc", "abcdefghij":
            yield [rng.choice(letters) for _ in range(n)]
    for _ in range(150):
        words = []
        for _ in range(rng.randint(1, 6)):
            unit = [rng.choice("ab" if rng.random() < 0.5 else "abcdefgh") for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 16, 17, 31, 33]))]
            n = rng.randint(1, 7) * len(unit) + rng.randint(0, len(unit))
            words += [unit[i % len(unit)] for i in range(n)] + [rng.choice("abxyz") for _ in range(rng.randint(0, 4))]
        yield words
    a, b = "a", "ab"
    while len(b) < 400:
        a, b = b, b + a
    yield list(b)
    yield list("a" * 50 + "b" + "a" * 50 + "b" + "a" * 50 + "b" + "a" * 50 + "b" + "a" * 7)


def test_all_at_once_and_word_by_word():
    for words in cases():
        want = brute(words)
        assert runs_of([w.encode() for w in words]) == want, words
        numbers = np.array([ord(w) for w in words], np.int64)
        online = SquareCatchers()
        for i in range(len(numbers)):
            online.append(numbers[i:i + 1])
            if i % 90 == 7:
                assert online.runs() == brute(words[:i + 1])
        assert online.runs() == want, words


def test_chunks_of_a_long_text(monkeypatch):
    rng = random.Random(6)
    words = []
    while len(words) < 6000:
        unit = [rng.choice("abcdefgh") for _ in range(rng.choice([1, 3, 40, 200]))]
        words += unit * rng.choice([1, 1, 5])
    want = brute(words)
    for chunk in 1 << 16, 1000, 333:
        monkeypatch.setattr(squares, "_CHUNK", chunk)
        assert runs_of([w.encode() for w in words]) == want
    assert any(n > 500 for _, n, _ in want)


def test_a_very_long_run():
    words = [b"x", b"y", b"z"] * 300_000
    assert runs_of([b"q"] + words + [b"q"]) == [(1, 900_000, 3)]


def test_rows(spark):
    texts = [None, "", "  ", "one", "a a a a a a", "\ta\x0ba\x0ca\ra\na  a b", "x " * 5, "a b " * 4 + "c", "no runs here",
             " a a a a a a ", "     ", "\x1c" * 9, "A a A a A a A a", "é ß " * 20]
    rows = [(i, t, 7) for i, t in enumerate(texts)] + [(None, "b " * 9, 7), (4, texts[4], 7), (4, texts[4], 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int").repartition(3)
    got = repeated_runs(df, carry=("runs", "text")).collect()
    assert len(got) == len(rows)
    for r in got:
        words = [w.decode() for w in (r.carried.text or "").encode().split()]
        want = brute(words)
        assert r.n_words == len(words) and r.carried.runs == 7
        assert [(x.start, x.length, x.period) for x in r.runs] == want and r.collapsed == cut(words, want)
    assert repeated_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        repeated_runs(df, exponent=3)
