from __future__ import annotations

import glob
import struct

import zstandard
from pyspark.sql import functions as F

from kpiloom.llm import warc

PAGES = "page_id long, url string, html string"


def written_and_read(spark, pages, tmp_path):
    path = f"{tmp_path}/warc"
    warc.write_archives(pages, path)
    return {r.page_id: r for r in warc.read_archives(spark, path).collect()}, sorted(glob.glob(f"{path}/*.txt"))


def test_round_trip_revisits_and_dictionary(spark, tmp_path):
    body = [f"<p>page {i % 40} é\r\n\r\n" + "<div class=x>the same words again</div>" * (i % 7) for i in range(200)]
    rows = [(i, f"http://h/{i}", body[i]) for i in range(200)] + [(500, None, None), (501, "u\r\nX: y", ""), (502, "u", "z" * 3_000_000)]
    got, files = written_and_read(spark, spark.createDataFrame(rows, PAGES).withColumns({"digest": F.lit(1), "payload": F.lit("p")}), tmp_path)
    assert len(got) == len(rows)
    last = {}
    for page, _, html in rows:
        last[html or ""] = max(page, last.get(html or "", -1))
    for page, _, html in rows:
        data, r = (html or "").encode(), got[page]
        assert (r.payload_bytes, r.payload_digest) == (len(data), warc.base32_sha1(data))
        assert (r.record_type, r.refers_to) == (("response", None) if last[html or ""] == page else ("revisit", last[html or ""]))
    for name in files:
        data = open(name, "rb").read()
        magic, size = struct.unpack("<II", data[:8])
        assert magic == warc.DICTIONARY_MAGIC and 0 < size <= warc.DICTIONARY_BYTES
        # Every record is a frame of its own: the first one can be read without the rest.
        first = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size])).decompressobj().decompress(data[16 + size:])
        assert first.startswith(b"WARC/1.1\r\n") and first.endswith(b"\r\n\r\n")


def test_few_records_repeated_rows_null_ids_and_no_rows(spark, tmp_path):
    got, _ = written_and_read(spark, spark.createDataFrame([(None, "u", "a"), (3, "u", "b"), (3, "u", "b")], PAGES), tmp_path / "few")
    assert got[None].record_type == "response" and got[3].record_type == "response"
    got, files = written_and_read(spark, spark.createDataFrame([], PAGES), tmp_path / "none")
    assert got == {} and all(open(f, "rb").read() == b"" for f in files)
    assert warc.dictionary([]) is None
