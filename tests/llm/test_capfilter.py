"""Near vectors against all pairs."""

import numpy as np

from wryspark.llm import capfilter
from wryspark.llm.components import components


def reference(rows, threshold=0.98):
    ok = [i for i, (k, v, label) in enumerate(rows) if k is not None and label is not None and v
          and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, parent = {i: 0 for i in range(len(rows))}, {r[0]: r[0] for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, i in enumerate(ok):
        for j in ok[:a]:
            (k, v, label), (m, w, other) = rows[i], rows[j]
            if label == other and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    p, q = sorted((root(k), root(m)))
                    parent[q] = p
    return sorted(((r[0], links[i], None if r[0] is None else root(r[0])) for i, r in enumerate(rows)), key=str)


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<float>, label int, n_links int").repartition(3)
    out = capfilter.near_vectors(df, **more).collect()
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in out)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=str)


def rounded(v):
    return [float(x) for x in np.asarray(v, np.float32)]


def test_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g in range(60):
        centre = rng.standard_normal(64)
        for _ in range(rng.integers(1, 12)):
            x = centre + rng.standard_normal(64) * rng.choice([0.02, 0.1, 0.14])
            rows.append((len(rows) * 3, rounded(x * rng.uniform(0.1, 9)), int(g % 3)))
    rows += [(5001 + i, rows[4][1], rows[4][2]) for i in range(5)]
    rows += [(6000, None, 1), (6001, [], 1), (6002, [0.0] * 64, 1), (6003, [float("nan")] + [1.0] * 63, 1),
             (6004, rows[0][1], None), (6005, [None] + [1.0] * 63, 1), (6006, [float("inf")] + [1.0] * 63, 1),
             (None, rows[0][1], 0), (6007, rows[0][1][:10], 0), (6008, [1.0, 2.0], 0), (6009, [2.0, 4.0], 0), (6010, [3.0], 0),
             (6011, [7.0], 0), (6012, [-7.0], 0), (9, rows[3][1], rows[3][2])]
    assert run(spark, rows) == reference(rows)


def test_a_crowded_direction_is_split(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(32)
    rows = [(i, rounded(centre + rng.standard_normal(32) * 0.07), 1) for i in range(300)]
    want = reference(rows)
    got = run(spark, rows, block_rows=32)
    pairs = sum(w[1] for w in want)
    assert sum(g[1] for g in got) >= 0.999 * pairs and [g[2] for g in got] == [w[2] for w in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))


def test_empty(spark):
    assert run(spark, []) == []


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(40)]
    edges += [(2000, 2000 + i) for i in range(200)] + [(7, 7), (None, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            p, q = sorted((root(a), root(b)))
            parent[q] = p
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.component for r in components(df, "a", "b").collect()} == {x: root(x) for x in parent}
    assert components(df.limit(0), "a", "b").count() == 0
