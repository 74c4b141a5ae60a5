"""Packing and token tables: ids as the library gives them, whole round trips."""

import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wryspark.llm import packing, tokenfile
from wryspark.llm.common import shared_path
from wryspark.llm.queries import vocabulary
from wryspark.llm.tokenise import WordEncoder

ODD = [None, "", " ", "a  b", " lead", "trail ", "a\n b", "a \nb", "x\ty z", "Don't 's ' s", "1 22 ²½ Ⅷ", "é ÀÉ Σς ΑΣ İ I ǅ ﬁ.",
       "a<|endoftext|> b <|startoftext|>c", "A. B, C; d: e! f? .", "\x1c a b\x1c c", "😀 zwj 👩‍👩‍👧", "word " * 3000, "　 a", "a one.\nTwo three\nfour,,\nÉté!\n five\n\nsix.\n7 x\n\ty end.\n", "a que&&& *** x_y_ __ a- -b it's, 'tis' don't.\nIt's",
       "a b<|endoftext|>.\nc b|. d>.\nE ﬁn.\nFin x.\n'y"]


def texts():
    rng = random.Random(1)
    return ODD + [" ".join("".join(rng.choices(["th", "er", "Qu", "é", "ß", "on", "."], k=rng.randint(1, 5)))
                           for _ in range(rng.choice([3, 40, 400, 3000]))) for _ in range(120)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_the_librarys(name):
    plain = Tokenizer.from_file(vocabulary(name))
    encode = WordEncoder(vocabulary(name), cache_words=200)
    for t in texts():
        want = plain.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(encode([t or ""])[0], "<u4").tolist() == want


def test_the_library_is_asked_once_for_a_word():
    encode, asked = WordEncoder(vocabulary("byte_bpe_50k.json")), []
    merge, whole = encode.words.merge, encode.whole
    encode.words.merge = lambda w: asked.append(w) or merge(w)
    encode.whole = encode.words.whole = lambda t: asked.append(t) or whole(t)
    encode([f"First word{c}.\nThen last." for c in "abcdefgh"])
    assert len(asked) == len(set(asked))


def test_packing(spark):
    rows = [(i * 7, t, 1) for i, t in enumerate(texts())] + [(None, "null id", 1), (7, "a second row", 1), (7, "a second row", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece int").repartition(4)
    got = packing.pack(df, vocabulary("byte_bpe_50k.json"), shared_path(spark, "packed"), capacity=512, open_bins=16).collect()
    plain = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    want = sorted((str(d), plain.encode(t or "", add_special_tokens=False).ids + [0]) for d, t, _ in rows)
    docs, open_doc = [], {}
    for r in sorted(got, key=lambda r: (str(r.doc_id), r.piece)):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length <= 512 and (r.piece == 0 or r.length == 512)
        open_doc.setdefault(str(r.doc_id), []).append((r.piece, r.start, ids))
    for key, pieces in open_doc.items():
        if key != "7":
            assert [p for p, *_ in pieces] == list(range(len(pieces)))
            assert [s for _, s, _ in pieces] == np.cumsum([0] + [len(i) for *_, i in pieces])[:-1].tolist()
            docs.append((key, sum((i for *_, i in pieces), [])))
        else:
            docs += [(key, i) for _, _, i in pieces]
    assert sorted(docs) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        places.sort()
        assert [o for o, _ in places] == np.cumsum([0] + [n for _, n in places])[:-1].tolist()
        assert sum(n for _, n in places) <= 512
    total = sum(r.length for r in got)
    assert len(bins) <= total / 512 * 1.05 + 2
    none = packing.pack(df.limit(0), vocabulary("byte_bpe_50k.json"), shared_path(spark, "packed"))
    assert none.count() == 0 and none.columns[:2] == ["doc_id", "piece"]


def test_open_bins_close_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 4, 9, 1)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0), (2, 9)]
    bins = packing.OpenBins(10, 2)
    # 8 and 5 stay open; 6 fits neither, so the fuller one (8) closes, and 2 can't join it any more.
    assert [bins.place(n) for n in (8, 5, 6, 2)] == [(0, 0), (1, 0), (2, 0), (2, 6)]


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_table(spark, encoding):
    rows = [(i * 3 % 401, t, 9) for i, t in enumerate(texts())] + [(None, "z", 9), (None, None, 9), (3, "b", 9), (3, "b", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(5)
    path = shared_path(spark, "tokens")
    tokenfile.write_tokens(df, vocabulary("word_bpe_49k.json"), path, encoding=encoding, row_group_bytes=4096, page_rows=16)
    got = tokenfile.with_crc32(tokenfile.read_tokens(spark, path)).collect()
    plain = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    at, want = 0, []
    for d, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array(plain.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    files = [f.path for f in pq.ParquetDataset(path.removeprefix("file:")).fragments]
    seen = set()
    for f in files:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            column = meta.row_group(g).column(meta.num_columns - 1)
            assert column.has_offset_index and column.has_column_index
            seen |= set(column.encodings)
    assert ("DELTA_BINARY_PACKED" in seen) == (encoding == "delta")
    assert any("DICTIONARY" in e for e in seen) == (encoding == "dictionary")
    only = spark.read.parquet(path).select("n_tokens")
    assert only.agg(F.sum("n_tokens")).first()[0] == at
    assert "ids" not in only._jdf.queryExecution().executedPlan().toString()


def test_empty_token_table(spark):
    path = shared_path(spark, "tokens")
    df = spark.createDataFrame([], "doc_id long, text string")
    tokenfile.write_tokens(df, vocabulary("word_bpe_49k.json"), path)
    assert tokenfile.with_crc32(tokenfile.read_tokens(spark, path)).count() == 0
    with pytest.raises(ValueError, match="encoding"):
        tokenfile.write_tokens(df, "", path, encoding="other")
