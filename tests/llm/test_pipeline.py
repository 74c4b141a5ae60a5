"""The pipeline on a small folder with planted cases, and on odd tables."""

import random

import pytest

import corpus_pipeline as C

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def folder(spark, tmp_path, docs, labels, items):
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def stages(spark, sf, tmp_path):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in C.STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/out-{name}")
        docs = out[name] = spark.read.parquet(f"{tmp_path}/out-{name}")
    return out


def test_planted_cases(spark, tmp_path):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices(["tha", "er", "ing", "on", "st", "ble"], k=rng.randint(1, 3))) for _ in range(900)]
    prose = lambda n: " ".join(" ".join(rng.choices(vocabulary, k=rng.randint(4, 12))) + "." for _ in range(n))
    junk = lambda: " ".join(w + rng.choice(["###", "%%%"]) for w in rng.choices(vocabulary, k=120))
    items = [(i, " ".join(rng.choices(vocabulary, k=25))) for i in range(5)]
    passage = " ".join(rng.choices(vocabulary, k=60)) + "."
    docs = {i: prose(25) for i in range(300)} | {i: junk() for i in range(300, 400)}
    docs[401], docs[402] = docs[10], docs[11].replace(". ", " , ", 1)  # an exact and a near copy
    docs[403] = prose(10) + "\n" + items[2][1] + "\n" + prose(10)
    for i in (404, 405, 406):
        docs[i] = prose(12) + "\n" + passage + "\n" + prose(12)
    rows = [(i, t, "en", "s", len(t)) for i, t in docs.items()]
    labels = [(i, int(i < 300), 0) for i in range(0, 400, 2)]
    sf = folder(spark, tmp_path, rows, labels, items)
    out = stages(spark, sf, tmp_path)
    ids = {name: {r.doc_id for r in out[name].select("doc_id").collect()} for name in out}
    clean = set(range(300))
    assert clean | {401, 402, 403, 404, 405, 406} <= ids["quality"] and len(ids["quality"] & set(range(300, 400))) <= 3
    assert ids["near_dedup"] == ids["quality"] - {401, 402}
    assert ids["substring_dedup"] == ids["near_dedup"]
    text = {r.doc_id: r for r in out["substring_dedup"].collect()}
    assert passage in text[404].text and all(passage not in text[i].text for i in (405, 406))
    assert all(text[i].text == docs[i] for i in clean) and all(r.n_chars == len(r.text) for r in text.values())
    assert ids["decontaminate"] == ids["near_dedup"] - {403}
    assert ids["pack"] == ids["decontaminate"]
    assert out["decontaminate"].dtypes == out["quality"].dtypes == [(c.split()[0], c.split()[1].replace("long", "bigint"))
                                                                    for c in COLUMNS.split(", ")]
    assert C.run(spark, sf).count() == out["pack"].count()


@pytest.mark.parametrize("docs", [
    [],
    [(None, None, None, None, None), (1, "", None, "s", 0), (2, "word", "en", None, None), (2, "word", "en", None, None)]])
def test_odd_tables(spark, tmp_path, docs):
    out = stages(spark, folder(spark, tmp_path, docs, [], []), tmp_path)
    assert out["decontaminate"].count() == (3 if docs else 0)
    assert out["pack"].count() == (3 if docs else 0)
