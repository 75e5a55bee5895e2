"""WARC archives of pages, one Zstandard frame a record, with a dictionary of their own.

An archive begins with a skippable frame (magic number 0x184D2A5D) that holds a
dictionary built from the archive's own records; every record is a frame
compressed with it, so that a reader can seek to a record and read it alone.
Spark's text writer puts the frames into files: a row is a frame, the line
separator is an empty skippable frame, and the writer's commit protocol keeps
files of failed attempts out. Equal payloads are stored once: the one with the
largest page_id is a response record, the others revisit it.

An archive holds what one partition holds (``ARCHIVE_BYTES`` of html, or one longer page);
``SAMPLE_BYTES`` bounds what its dictionary is built from and
``DICTIONARY_BYTES`` the dictionary.

Defined results: a null html is an empty payload; payloads below
``least_bytes`` are always responses; where rows repeat the largest page_id of
a payload, each of them is a response; rows with a null page_id are responses,
written and read with a null page_id; null urls are written as ``urn:page:<page_id>``; an empty table
gives no archives and an empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.common import fresh_path, release, table, written

# --- Fixed values of the formats ---
DICTIONARY_MAGIC = 0x184D2A5D
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"  # skippable frame 0x184D2A50 of length 0
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_DATE = "2024-01-01T00:00:00Z"
# --- end of fixed values ---
ARCHIVE_BYTES = 32 << 20
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
LEAST_BYTES = 0
SLICE_BYTES = 4 << 10  # that a reader gives its decompressor at once
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit has no payload but the digest and length of the full one."""
    name = "null" if page_id is None else str(page_id)
    target = re.sub(r"[\r\n\s]+", "%20", url) if url else f"urn:page:{name}"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {WARC_DATE}",
              f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if revisit:
        fields += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    fields += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """Trained on the records; where they are too few for that, they are the dictionary themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records, level=3)
    except zstandard.ZstdError:
        raw = b"".join(records)[-DICTIONARY_BYTES:]
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if raw else None


def frames(records: Iterator[bytes]) -> Iterator[bytes]:
    """The archive's frames: the dictionary, then every record on its own."""
    head, size = [], 0
    for one in records:
        head.append(one)
        size += len(one)
        if size >= SAMPLE_BYTES:
            break
    if not head:
        return
    learnt = dictionary([x[:1 << 17] for x in head])  # the trainer uses at most 128 KiB of a sample
    content = learnt.as_bytes()
    yield struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content
    packer = zstandard.ZstdCompressor(level=3, dict_data=learnt, write_checksum=True)
    for one in head:
        yield packer.compress(one)
    del head
    for one in records:
        yield packer.compress(one)


def records_of(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, one at a time, by its own dictionary."""
    stream, unpacker = io.BytesIO(archive), zstandard.ZstdDecompressor()
    while len(head := stream.read(8)) == 8:
        magic, size = struct.unpack("<II", head)
        if magic == DICTIONARY_MAGIC:
            content = stream.read(size)
            kind = zstandard.DICT_TYPE_FULLDICT if content[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
            unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=kind))
        elif magic & 0xFFFFFFF0 == 0x184D2A50:
            stream.seek(size, io.SEEK_CUR)
        else:
            stream.seek(-8, io.SEEK_CUR)
            one, out = unpacker.decompressobj(), []
            while not one.eof:  # what a slice has beyond the frame is copied, so it is small
                if not (some := stream.read(SLICE_BYTES)):
                    raise ValueError("the archive ends within a frame")
                out.append(one.decompress(some))
            stream.seek(-len(one.unused_data), io.SEEK_CUR)
            yield b"".join(out)


def parsed(one: bytes) -> dict:
    head, _, rest = one.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda name: None if (x := re.search(r"urn:page:(-?\d+|null)>", fields.get(name, ""))) is None or x[1] == "null" else int(x[1])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if kind == "response" and (digest != base32_sha1(payload) or length != len(payload)):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not have its digest")
    return {"page_id": number("WARC-Record-ID"), "payload_bytes": length, "payload_digest": digest, "record_type": kind, "refers_to": number("WARC-Refers-To")}


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Archives of ``pages`` (page_id, url, html) under ``path``, ``*.txt`` by the writer's naming."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    # Who refers to whom is found on ids and digests; the payloads themselves move once, evenly, as pages are many.
    known = written(rows.select("page_id", "digest", F.octet_length("payload").alias("bytes")), "warc-digests")
    total = known.agg(F.sum("bytes")).first()[0] or 0
    shared = (known.where((F.col("bytes") >= least_bytes) & F.col("page_id").isNotNull()).groupBy("digest")
              .agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).where("least != refers_to").drop("least"))
    revisits = known.join(shared, "digest").where("page_id != refers_to").select("page_id", "digest", "refers_to").distinct()
    dealt = rows.repartition(max(1, -(-total // ARCHIVE_BYTES)), "page_id", "digest")
    placed = dealt.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "payload", "refers_to")

    def archived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[bytes]:
            for batch in batches:
                for page, url, body, to in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                    page, to = page.as_py(), to.as_py()
                    yield record(page, url.as_py(), body.as_py(), to, to is not None)

        pending, size = [], 0
        for frame in frames(each()):
            pending.append(frame)
            size += len(frame)
            if size > 1 << 20:
                yield pa.record_batch({"frame": pa.array(pending, pa.binary())})
                pending, size = [], 0
        if pending:
            yield pa.record_batch({"frame": pa.array(pending, pa.binary())})
        release()

    out = placed.mapInArrow(archived, "frame binary").select(F.col("frame").cast("string").alias("value"))
    out.write.option("lineSep", EMPTY_FRAME).option("compression", "none").text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``; an archive is read by one task."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            for archive in batch.column("content"):
                rows = []
                for one in records_of(archive.as_py()):
                    rows.append(parsed(one))
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("content")
    return files.mapInArrow(each, RECORD)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path)


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS n, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS last FROM p),
b AS (
  SELECT page_id, n, last, (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST('0b' || substr(bits, i * 5 + 1, 5) AS INT), 1), '' ORDER BY i) FROM range(32) r(i)) AS digest
  FROM (SELECT *, (SELECT string_agg(substr('0000000100100011010001010110011110001001101010111100110111101111', 1 + 4 * (strpos('0123456789abcdef', substr(hex, j + 1, 1)) - 1), 4), '' ORDER BY j) FROM range(40) q(j)) AS bits FROM d))
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= {LEAST_BYTES} AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {LEAST_BYTES} AND page_id <> last THEN last END AS refers_to
FROM b
"""
