"""Exact duplicates against a plain grouping."""

import hashlib
import random
import re

from wryspark.llm.contentsort import exact_duplicates


def reference(rows):
    groups = {}
    for k, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), k is None, k))
    out = []
    for text, members in groups.items():
        members.sort()
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(k, members[0][2], len(members), i == 0, sha) for i, (_, _, k) in enumerate(members)]
    return sorted(out, key=str)


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, _hash string, kept int").repartition(5)
    got = exact_duplicates(df, **more).collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got), key=str)


def texts():
    rng = random.Random(8)
    base = [" ".join(rng.choices(["ab", "c", "é", "😀", "　"], k=rng.randint(0, 6))) for _ in range(200)]
    return [None, "", " ", "\t\x0b\x0c\r\n", "a b", "ab", " a  b ", "a b", "A b"] + base + [t.replace(" ", rng.choice(["", "  ", "\n"])) for t in base]


def rows():
    return [(i * 3, t) for i, t in enumerate(texts())] + [(None, "null id"), (None, "null  id"), (7, "twice"), (7, "twice"), (7, "other"),
                                                          (None, "only null"), (-(1 << 63), "least id"), (1, "least id")]


def test_against_a_grouping(spark):
    assert run(spark, rows()) == reference(rows())


def test_hot_texts_are_split(spark):
    data = rows() + [(1000 + i, "a common  text" if i % 3 else "a common text") for i in range(400)] + [(5, "same row")] * 90 \
        + [(None, "hot null")] * 60
    want = reference(data)
    assert run(spark, data, hot_rows=10) == want
    assert run(spark, data, hot_rows=1) == want
    assert run(spark, data, hot_bytes=40) == want
    # No more than two hashes may be hot, whatever the bounds say.
    assert run(spark, data, hot_rows=1, max_hot=1) == want


def test_long_common_prefixes(spark):
    long = "x" * 300_000
    data = [(i, long + str(i % 4) * (i % 3)) for i in range(24)] + [(100, "x " * 300_000)]
    assert run(spark, data) == reference(data)


def test_carry_and_empty(spark):
    df = spark.createDataFrame([(1, "a", "p"), (2, " a", "q")], "doc_id long, text string, kept string")
    got = {r.doc_id: r for r in exact_duplicates(df, carry=("kept", "text")).collect()}
    assert got[1].carried.kept == "p" and got[2].carried.text == " a" and got[1].keep_id == 2 and got[2].kept is True
    assert exact_duplicates(df.limit(0)).count() == 0
