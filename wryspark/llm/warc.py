"""WARC archives, and a normaliser for archives gzipped as one stream.

A .warc.gz whose records were compressed as one gzip stream can only be read
from its start. ``normalise`` inflates such a file once, front to back, writes
every record as a gzip member of its own and, beside the new file, a sidecar
index with each member's offset and length, so that any record can then be
read alone. Files are independent: one task streams one file, holding a buffer
of one chunk plus one record's header. Files that have members per record, or
several streams, are read just the same.

``write`` makes one-stream archives from rows, and ``read`` reads records back
through the index, dealt out evenly however large their archives are.

All files go below a folder that the driver and all executors see. A task
writes under a name of its own attempt and then renames the file, so a task
that is run again replaces its file by an equal one. Whatever a lost task
leaves behind ends in ``.part`` and is never read.

Defined results: a null payload counts as empty; a null or empty url becomes
``urn:page:<id>``; control characters and spaces in urls are percent-encoded;
an archive that ends inside a record or a stream raises ValueError, naming the
file; an empty table makes archives without records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import texts_of

_CHUNK = 1 << 18
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column: 32 digits of 5 bits."""
    hexed = F.sha1(payload)
    # conv() works on 64 bits, so 40 bits (8 digits) at a time.
    groups = [F.conv(F.substring(hexed, 10 * g + 1, 10), 16, 10).cast("bigint") for g in range(4)]
    alphabet = F.lit(_BASE32)
    return F.concat(*[F.substring(alphabet, (F.shiftright(v, 35 - 5 * i).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1))
                      for v in groups for i in range(8)])


def mark_revisits(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int = 0,
                  broadcast_rows: int = 200_000) -> DataFrame:
    """The rows with ``payload_digest``, ``payload_bytes``, ``record_type``
    and ``refers_to``: of records with equal payloads of at least
    ``min_bytes`` bytes, those with the smallest id are responses (the null id
    is the largest), the others revisit it. Rows that repeat the smallest id
    are all responses.

    Payloads that occur more than once are counted; up to ``broadcast_rows``
    of their digests are broadcast, so that no payload is shuffled, and more
    are joined by shuffle."""
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    rows = pages.withColumn("payload_digest", base32_sha1(payload)).withColumn(
        "payload_bytes", F.octet_length(payload).cast("bigint"))
    firsts = (rows.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
              .agg(F.min(id_col).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n").checkpoint())
    if firsts.count() <= broadcast_rows:
        firsts = F.broadcast(firsts)
    rows = rows.join(firsts, ["payload_digest", "payload_bytes"], "left")
    again = F.col("_first").isNotNull() & ~F.col(id_col).eqNullSafe(F.col("_first"))
    return rows.select(*pages.columns, "payload_digest", "payload_bytes",
                       F.when(again, "revisit").otherwise("response").alias("record_type"),
                       F.when(again, F.col("_first")).alias("refers_to"))


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def _uri(url: str | None, page: object) -> str:
    return re.sub(r"[\x00-\x20\x7F]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page}"


def _put(uri: str, name: str):
    """(file system, name of this attempt, final name) below ``uri``."""
    fs, path = pafs.FileSystem.from_uri(uri)
    fs.create_dir(path, recursive=True)
    return fs, f"{path}/{name}.{uuid.uuid4().hex}.part", f"{path}/{name}"


def write(marked: DataFrame, uri: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          archive_bytes: int = 256 << 20, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write rows of ``mark_revisits`` as one-stream .warc.gz archives of at
    most about ``archive_bytes`` of records each; ``(archive, n_records)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, out, done = TaskContext.get().partitionId(), 0, None, []
        size = records = 0

        def close():
            stream.write(packer.flush())
            stream.close()
            fs.move(temporary, final)
            done.append((final.rsplit("/", 1)[1], records))

        for batch in batches:
            ids, urls = batch.column("_id").to_pylist(), batch.column("_url").to_pylist()
            payloads = texts_of(batch, "_payload")
            kinds, refers = batch.column("record_type").to_pylist(), batch.column("refers_to").to_pylist()
            digests, sizes = batch.column("payload_digest").to_pylist(), batch.column("payload_bytes").to_pylist()
            for page, url, payload, kind, target, digest, n in zip(ids, urls, payloads, kinds, refers, digests, sizes):
                if out is None:
                    fs, temporary, final = _put(uri, f"pages-{part:05d}-{made:04d}.warc.gz")
                    stream, out = fs.open_output_stream(temporary, compression=None), True
                    packer, size, records, made = zlib.compressobj(3, zlib.DEFLATED, 31), 0, 0, made + 1
                headers = [("WARC-Record-ID", f"<urn:page:{page}>"), ("WARC-Date", date),
                           ("WARC-Target-URI", _uri(url, page)), ("WARC-Payload-Digest", f"sha1:{digest}"),
                           ("WARC-Payload-Length", str(n))]
                if kind == "revisit":
                    headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                                ("WARC-Refers-To", f"<urn:page:{target}>")]
                    http = b"HTTP/1.1 200 OK\r\n\r\n"
                else:
                    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                            b"Content-Length: %d\r\n\r\n" % len(payload)) + payload
                headers.append(("Content-Type", "application/http; msgtype=response"))
                record = _record(kind, headers, http)
                stream.write(packer.compress(record))
                size, records = size + len(record), records + 1
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()),
                                          pa.array([d[1] for d in done], pa.int64())], ["archive", "n_records"])

    rows = marked.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.when(
        F.col("record_type") == "response", F.col(payload_col)).alias("_payload"),
        "record_type", "refers_to", "payload_digest", "payload_bytes")
    return rows.mapInArrow(run, "archive string, n_records bigint").checkpoint()


def _inflated(stream, name: str) -> Iterator[bytes]:
    """The file's bytes after gunzip, over all its members, chunk by chunk."""
    packer, begun = None, False
    while chunk := stream.read(_CHUNK):
        while chunk:
            if packer is None:
                packer, begun = zlib.decompressobj(31), True
            data = packer.decompress(chunk, _CHUNK)
            if data:
                yield data
            chunk = packer.unconsumed_tail
            if packer.eof:
                chunk, packer = packer.unused_data, None
    if packer is not None:
        raise ValueError(f"{name}: the gzip stream ends early" if begun else f"{name}: not gzip")


class _Reader:
    """Records of an inflated stream, with their blocks as chunks."""

    def __init__(self, chunks: Iterator[bytes], name: str):
        self.chunks, self.name, self.buffer = chunks, name, bytearray()

    def _more(self) -> bool:
        chunk = next(self.chunks, None)
        if chunk is not None:
            self.buffer += chunk
        return chunk is not None

    def header(self) -> bytes | None:
        while self.buffer.startswith((b"\r", b"\n")) or not self.buffer:
            del self.buffer[:len(self.buffer) - len(self.buffer.lstrip(b"\r\n"))]
            if not self.buffer and not self._more():
                return None
        while (end := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self._more():
                raise ValueError(f"{self.name}: ends inside a record's header")
        head = bytes(self.buffer[:end + 4])
        if not head.startswith(b"WARC/"):
            raise ValueError(f"{self.name}: no WARC record where one should start")
        del self.buffer[:end + 4]
        return head

    def block(self, length: int) -> Iterator[bytes]:
        while length:
            if not self.buffer and not self._more():
                raise ValueError(f"{self.name}: ends inside a record's block")
            piece = bytes(self.buffer[:length])
            del self.buffer[:len(piece)]
            length -= len(piece)
            yield piece


def fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def normalise(spark: SparkSession, archives: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite every archive named in ``archives.archive`` below ``source`` to
    ``target`` with one member per record, and a sidecar ``<name>.idx`` of
    tab-separated (archive, offset, length, type, record id) lines; returns
    ``(archive, n_records)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = []
            for name in batch.column("archive").to_pylist():
                fs, path = pafs.FileSystem.from_uri(f"{source}/{name}")
                out_fs, temporary, final = _put(target, name)
                _, index_temporary, index_final = _put(target, f"{name}.idx")
                at = n = 0
                with (fs.open_input_stream(path, compression=None, buffer_size=_CHUNK) as stream,
                      out_fs.open_output_stream(temporary, compression=None) as out,
                      out_fs.open_output_stream(index_temporary, compression=None) as index):
                    reader = _Reader(_inflated(stream, name), name)
                    while (head := reader.header()) is not None:
                        named = fields(head)
                        packer, size = zlib.compressobj(3, zlib.DEFLATED, 31), 0
                        size += out.write(packer.compress(head))
                        for piece in reader.block(int(named["content-length"])):
                            size += out.write(packer.compress(piece))
                        size += out.write(packer.compress(b"\r\n\r\n") + packer.flush())
                        index.write(f"{name}\t{at}\t{size}\t{named.get('warc-type', '')}\t"
                                    f"{named.get('warc-record-id', '')}\n".encode())
                        at, n = at + size, n + 1
                out_fs.move(temporary, final)
                out_fs.move(index_temporary, index_final)
                counts.append(n)
            yield pa.RecordBatch.from_arrays([batch.column("archive"), pa.array(counts, pa.int64())],
                                             ["archive", "n_records"])

    names = archives.select("archive")
    # One file is one stream and so one task's work; as many tasks as files.
    dealt = names.repartition(max(1, names.count()))
    return dealt.mapInArrow(run, "archive string, n_records bigint").checkpoint()


_INDEX = "archive string, offset bigint, length bigint, type string, record_id string"


def read(spark: SparkSession, target: str, archives: DataFrame, run_bytes: int = 8 << 20,
         task_bytes: int = 16 << 20) -> DataFrame:
    """Every record of the normalised archives, read member by member at the
    index's offsets: ``(archive, record_id, record_type, refers_to,
    payload_digest, payload_bytes, payload)``. For a response the digest and
    the number of bytes are taken from the payload as read, for a revisit,
    which stores none, from its header. A task reads about ``task_bytes`` of the
    archives, or less if every core is to have one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_name = stream = None
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for row in batch.to_pylist():
                if row["archive"] != open_name:
                    fs, path = pafs.FileSystem.from_uri(f"{target}/{row['archive']}")
                    open_name, stream = row["archive"], fs.open_input_file(path)
                record = zlib.decompress(stream.read_at(row["length"], row["offset"]), 31)
                at = record.index(b"\r\n\r\n") + 4
                named = fields(record[:at])
                block = record[at:at + int(named["content-length"])]
                payload = block[block.index(b"\r\n\r\n") + 4:]
                if named["warc-type"] == "revisit":
                    digest, n = named["warc-payload-digest"].partition(":")[2], int(named["warc-payload-length"])
                    payload = None
                else:
                    digest, n = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
                rows.append((row["archive"], named["warc-record-id"], named["warc-type"],
                             named.get("warc-refers-to"), digest, n, payload))
                held += len(record)
                if held > run_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)

    out = pa.schema([("archive", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()),
                     ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                     ("payload", pa.binary())])
    if archives.isEmpty():
        return spark.createDataFrame([], "archive string, record_id string, record_type string, refers_to string, "
                                         "payload_digest string, payload_bytes bigint, payload binary")
    index = spark.read.schema(_INDEX).option("sep", "\t").option("quote", "").csv(f"{target}/*.idx")
    # Runs of neighbouring records go to one task; a large archive is many runs.
    run_no = F.floor(F.col("offset") / run_bytes)
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // task_bytes))
    dealt = (index.repartition(tasks, F.xxhash64("archive", run_no))
             .sortWithinPartitions("archive", "offset").select("archive", "offset", "length"))
    return dealt.mapInArrow(run, "archive string, record_id string, record_type string, refers_to string, "
                                 "payload_digest string, payload_bytes bigint, payload binary")


def page_of(record_id: str) -> Column:
    """The page id in ``<urn:page:ID>``."""
    text = F.regexp_extract(record_id, "^<urn:page:(.*)>$", 1)
    return F.when(text != "None", text).cast("bigint")
