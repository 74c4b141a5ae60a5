"""Vector codes against plain k-means in Python integers."""

import hashlib
import math

import numpy as np

from wryspark.llm.vectorcodes import CellMemo, exhaustive, vector_codes


def reference(rows, entries, parts, rounds):
    ok = [(k, [0 if x == 0 else math.floor(1024 * x) for x in v], lab) for k, v, lab in rows
          if v and all(x is not None and math.isfinite(x) for x in v)]
    ok.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    if not ok:
        return [], ""
    length = len(ok[0][1])
    width = -(-length // parts)
    ok = [(k, v + [0] * (width * parts - length), lab) for k, v, lab in ok if len(v) == length]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in ok]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), e) for e, y in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for c in cut:
                own.setdefault(nearest(p, c[p])[1], []).append(c[p])
            books[p] = [[sum(col) // len(own[e]) for col in zip(*own[e])] if e in own else y for e, y in enumerate(books[p])]
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    top = (1 << 63) - 1
    error = [min(sum(d for d, _ in f), top) for f in found]
    whole = {}
    for (_, _, lab), n in zip(ok, error):
        whole[lab] = min(whole.get(lab, 0) + n, top)
    text = ",".join(str(v) for p in books for y in p for v in y)
    return sorted(((r[0], [e for _, e in f], n, whole[r[2]]) for r, f, n in zip(ok, found, error)), key=str), \
        hashlib.sha256(text.encode()).hexdigest()


def run(spark, rows, entries=8, parts=4, rounds=3, **more):
    df = spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<float>, label int, codes int").repartition(3)
    got, books = vector_codes(df, entries=entries, parts=parts, rounds=rounds, **more)
    return sorted(((r.vec_id, list(r.codes), r.error, r.label_error) for r in got.collect()), key=str), books.sha256()


def rounded(v):
    return [float(x) for x in np.asarray(v, np.float32)]


def rows(n, length=8, scale=0.2):
    rng = np.random.default_rng(n)
    centres = rng.standard_normal((5, length)) * scale
    return [(i * 2, rounded(centres[i % 5] + rng.standard_normal(length) * scale / 4), [0, 1, None][i % 3]) for i in range(n)]


def test_against_plain_python(spark):
    odd = [(1, None, 1), (3, [], 1), (5, [None] + [0.1] * 7, 1), (7, [float("nan")] + [0.1] * 7, 1), (9, [float("inf")] + [0.1] * 7, 1),
           (11, [0.25] * 8, 1), (11, [0.25] * 8, 1), (11, [-0.25] * 8, 1), (None, [0.1] * 8, None), (13, [0.5] * 3, 1), (15, [0.0] * 8, 2),
           (17, [-0.0001] * 8, 2)]
    data = rows(120) + odd
    assert run(spark, data) == reference(data, 8, 4, 3)
    assert run(spark, data, broadcast_rows=0, spread=3) == reference(data, 8, 4, 3)


def test_lengths_parts_and_few_rows(spark):
    data = rows(30, length=7)
    assert run(spark, data, entries=50, parts=3) == reference(data, 50, 3, 3)
    assert run(spark, rows(40, 8), entries=4, parts=1, rounds=0) == reference(rows(40, 8), 4, 1, 0)


def test_ties_go_to_the_lower_entry(spark):
    data = [(i, [float(i % 4) / 1024] * 4, 1) for i in range(40)]
    assert run(spark, data, entries=6) == reference(data, 6, 4, 3)


def test_large_components(spark):
    data = rows(40, 4, 50.0) + [(200 + i, rounded([3e5 * (i + 1), -2e7, 1.0, 4.0]), 5) for i in range(6)]
    assert run(spark, data) == reference(data, 8, 4, 3)
    data += [(300, rounded([3e38, -3e38, 1.0, 0.0]), 5), (301, rounded([2e38, 3e38, 1e30, 0.0]), 6)]
    assert run(spark, data) == reference(data, 8, 4, 3)
    # A codebook that starts with large entries.
    data = [(-1, rounded([1e9, 1.0, 2.0, 3.0]), 1), (-2, rounded([3e38, 1.0, 2.0, 3.0]), 1)] + rows(20, 4)
    assert run(spark, data) == reference(data, 8, 4, 3)


def test_nothing_usable(spark):
    assert run(spark, []) == ([], hashlib.sha256(b"").hexdigest())
    assert run(spark, [(1, None, 1)])[0] == []


def test_memo():
    rng = np.random.default_rng(9)
    book = rng.integers(-400, 400, (100, 6)).astype(float)
    x = np.concatenate([rng.integers(-500, 500, (3000, 6)), rng.integers(-40, 40, (3000, 6)).repeat(2, 0)]).astype(float)
    want = exhaustive(x, book)
    for cell, limit in (1, 1 << 24), (32, 1 << 24), (100, 1 << 10), (4000, 1 << 24):
        memo = CellMemo(book, cell, limit)
        for _ in range(2):
            entry, d = memo.nearest(x)
            assert (entry == want[0]).all() and (d == want[1]).all()
    memo = CellMemo(book, 64)
    memo.nearest(x)
    assert memo.evaluated < 0.6 * len(book) * len(x)
    memo.factors = np.zeros(6, np.int64)  # every cell has the same hash
    entry, d = memo.nearest(x)
    assert (entry == want[0]).all() and (d == want[1]).all()


def test_a_memo_is_reused():
    x = np.tile(np.arange(24.0).reshape(4, 6), (50, 1))
    memo = CellMemo(np.arange(60.0).reshape(10, 6) * 7, 16)
    memo.nearest(x)
    made = memo.cells_made
    memo.nearest(x)
    assert memo.cells_made == made <= 4
