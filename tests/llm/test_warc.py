"""Archives: digests, records as members of their own, the index, damage."""

import base64
import gzip
import hashlib
import zlib

import pytest

from wryspark.llm import warc
from wryspark.llm.common import shared_path

PAGES = "page_id long, url string, html string, record_type string, payload_digest int"


def local(uri):
    return uri.removeprefix("file:")


def test_round_trip(spark):
    rows = [(i, f"http://h/{i} a\n", f"<p>täxt {i % 4}</p>" * (1 + i % 3), "x", 1) for i in range(40)]
    rows += [(100, None, None, None, None), (101, "", "", "", 0), (102, "u", "y" * 700_000, "", 0),
             (7, "again", rows[7][2], "", 0), (None, "u", "no id", "", 0)]
    df = spark.createDataFrame(rows, PAGES).repartition(3)
    marked = warc.mark_revisits(df.select("page_id", "url", "html"), "page_id", "html")
    raw, normal = shared_path(spark, "raw"), shared_path(spark, "warc")
    written = warc.write(marked, raw, archive_bytes=3000)
    archives = warc.normalise(spark, written, raw, normal)
    assert archives.agg({"n_records": "sum"}).first()[0] == len(rows)
    got = warc.read(spark, normal, archives, run_bytes=2000).withColumn("page_id", warc.page_of("record_id")) \
        .withColumn("target", warc.page_of("refers_to")).collect()
    assert len(got) == len(rows)
    smallest = {}
    for page, _, html, *_ in rows:
        if page is not None:
            smallest[html or ""] = min(page, smallest.get(html or "", page))
    text = {page: html or "" for page, _, html, *_ in rows}
    for r in got:
        payload = text[r.page_id].encode()
        first = smallest.get(text[r.page_id], r.page_id)
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (r.record_type, r.target) == (("response", None) if first == r.page_id else ("revisit", first))
        assert (bytes(r.payload) if r.payload is not None else None) == (payload if first == r.page_id else None)
    # Every member can be read alone, and they fill the file.
    for a in archives.collect():
        data = open(f"{local(normal)}/{a.archive}", "rb").read()
        lines = open(f"{local(normal)}/{a.archive}.idx", encoding="utf-8").read().splitlines()
        at = 0
        for line in lines:
            name, offset, length, kind, _ = line.split("\t")
            assert (name, int(offset)) == (a.archive, at)
            assert zlib.decompress(data[at:at + int(length)], 31).startswith(b"WARC/1.1\r\nWARC-Type: " + kind.encode())
            at += int(length)
        assert at == len(data) and len(lines) == a.n_records


def test_streams_members_and_damage(spark, tmp_path):
    records = [warc._record("resource", [("WARC-Record-ID", f"<urn:page:{i}>")], b"b" * (i * 100_000)) for i in range(5)]
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(b"".join(records)))
    (tmp_path / "each.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "none.warc.gz").write_bytes(gzip.compress(b""))
    target = shared_path(spark, "warc")
    names = spark.createDataFrame([("one.warc.gz",), ("each.warc.gz",), ("none.warc.gz",)], "archive string")
    out = {r.archive: r.n_records for r in warc.normalise(spark, names, f"file://{tmp_path}", target).collect()}
    assert out == {"one.warc.gz": 5, "each.warc.gz": 5, "none.warc.gz": 0}
    same = [open(f"{local(target)}/{n}", "rb").read() for n in ("one.warc.gz", "each.warc.gz")]
    assert same[0] == same[1] and gzip.decompress(same[0]) == b"".join(records)
    whole = gzip.compress(b"".join(records))
    for k, (data, word) in enumerate([(whole[:-20], "ends early"), (gzip.compress(b"".join(records)[:-50_000]), "block"),
                                      (gzip.compress(records[0][:20]), "header"), (gzip.compress(b"junk\r\n\r\n"), "no WARC")]):
        (tmp_path / f"bad{k}.warc.gz").write_bytes(data)
        bad = spark.createDataFrame([(f"bad{k}.warc.gz",)], "archive string")
        with pytest.raises(Exception, match=word):
            warc.normalise(spark, bad, f"file://{tmp_path}", target).collect()


def test_no_pages(spark):
    marked = warc.mark_revisits(spark.createDataFrame([], "page_id long, url string, html string"), "page_id", "html")
    raw, normal = shared_path(spark, "raw"), shared_path(spark, "warc")
    assert warc.read(spark, normal, warc.normalise(spark, warc.write(marked, raw), raw, normal)).count() == 0


@pytest.mark.parametrize("broadcast_rows", [0, 100])
def test_least_size_of_revisits(spark, broadcast_rows):
    df = spark.createDataFrame([(1, "short"), (2, "short"), (3, "longer text"), (4, "longer text")], "page_id long, html string")
    got = {r.page_id: r.refers_to for r in warc.mark_revisits(df, "page_id", "html", min_bytes=6,
                                                                   broadcast_rows=broadcast_rows).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}
