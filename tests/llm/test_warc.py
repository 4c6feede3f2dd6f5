"""Web archives: frames, headers, revisits, exact payloads."""

import base64
import glob
import hashlib
import io
import struct
from collections import Counter, defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from quotemill.llm import warc

SCHEMA = "page_id long, url string, html string, key string, hash string, payload string, frame string, salt string"
PLAIN = warc.Archive()


def pages(spark, rows):
    return spark.createDataFrame([(*r, *"abcde") for r in rows], SCHEMA).repartition(3)


def odd_pages():
    rows = [
        (i, f"http://example.org/{i}?q=a b", f"<html><body>{'the same words ' * 20}{i} {chr(200 + i)}</body></html>")
        for i in range(300)
    ]
    rows += [(1000 + i, None, "<p>copied</p>") for i in range(40)]
    rows += [
        (2000, "http://x/\r\nWARC-Type: evil", None), (2001, "", ""), (2002, "ü \U0001f600", "\r\n\r\nWARC/1.1\r\n"),
        (2003, "http://long", "x y z " * 200_000), (2004, "http://nul", "a\x00b"), (None, "http://null", "<p>copied</p>"),
        (None, "http://null", "only null ids"), (None, "http://null", "only null ids"), (2005, "http://twice", "repeated row"),
        (2005, "http://twice", "repeated row"), (2006, "http://later", "repeated row"), (-3, "http://least", "<p>copied</p>"),
    ]
    return rows


def expected(rows, least=0):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        refers = first.get(html or "") if len(payload) >= least else None
        refers = None if refers == page_id else refers
        out.append((page_id, len(payload), digest, "response" if refers is None else "revisit", refers, payload))
    return Counter(out)


def found(spark, path):
    rows = warc.with_payloads(warc.read(spark, path)).collect()
    number = lambda x: None if x is None else int(x)
    return Counter(
        (number(r["key"]), r["payload_bytes"], r["payload_digest"], r["record_type"], number(r["refers_to"]), bytes(r["payload"]))
        for r in rows
    )


@pytest.mark.parametrize("least, broadcast_bytes", [(0, warc.BROADCAST_BYTES), (0, 0), (13, 0), (14, 1 << 20)])
def test_pages_come_back(spark, tmp_path, least, broadcast_bytes):
    rows = odd_pages()
    path = f"file://{tmp_path}/files"
    warc.write(pages(spark, rows), path, warc.Archive(revisit_bytes=least), broadcast_bytes=broadcast_bytes)
    assert found(spark, path) == expected(rows, least)


def test_empty_table(spark, tmp_path):
    path = f"file://{tmp_path}/files"
    warc.write(pages(spark, []), path)
    assert warc.read(spark, path).count() == 0


def test_files_are_zstandard_with_a_leading_dictionary(spark, tmp_path):
    """Any reader of the format can go through a file: a dictionary first, then frames."""
    rows = odd_pages()
    warc.write(pages(spark, rows).repartition(2), f"file://{tmp_path}/files", warc.Archive(sample_records=64))
    ids, trained = [], 0
    for name in glob.glob(f"{tmp_path}/files/part-*"):
        data = open(name, "rb").read()
        magic, size = struct.unpack_from("<II", data)
        assert magic == 0x184D2A5D
        known = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        trained += known.dict_id() > 0
        assert size <= PLAIN.dictionary_bytes
        reader = zstandard.ZstdDecompressor(dict_data=known).stream_reader(io.BytesIO(data[8 + size :]), read_across_frames=True)
        text = reader.read()
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: ")
        single = list(warc.frames(data))
        assert b"".join(single) == text
        for record in single:
            headers, block, answer, payload = warc.parse(record)
            assert len(block) == int(headers["Content-Length"])
            assert ("WARC-Refers-To" in headers) == (headers["WARC-Type"] == "revisit")
            ids.append((headers["WARC-Type"], headers["WARC-Record-ID"], headers.get("WARC-Refers-To")))
    assert len(ids) == len(rows) and trained == 2
    responses = {i for kind, i, _ in ids if kind == "response"}
    assert all(refers in responses for kind, _, refers in ids if kind == "revisit")


def test_damage_is_noticed():
    how = warc.Archive()
    made = warc.record(1, "http://x", b"payload", "D" * 32, None, how)
    packer = warc.compressor(b"", how)
    data = warc.skippable(b"") + packer.compress(made) + warc.EMPTY_FRAME.encode() + packer.compress(made * 0 or made)
    assert list(warc.frames(data)) == [made, made]
    for damaged in (data[:-3], data + b"junk", data[:40] + bytes([data[40] ^ 1]) + data[41:]):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.frames(damaged))
    with pytest.raises(ValueError):
        warc.parse(made[:-1])


def test_large_records_have_many_blocks():
    how = warc.Archive()
    large = bytes(range(256)) * 5_000 + b"z" * 400_000
    frame = warc.compressor(b"", how).compress(large)
    assert warc.frame_end(memoryview(frame), 0) == len(frame)
    assert list(warc.frames(frame + frame)) == [large, large]


def test_pages_are_not_shuffled(spark):
    rows = warc._digested(pages(spark, odd_pages()), "page_id", "url", "html")
    plan = warc.referring(rows.filter("key >= 0"), PLAIN)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_hot_payloads_are_salted(spark):
    rows = warc._digested(pages(spark, odd_pages()), "page_id", "url", "html").filter(F.col("key").isNotNull())
    got = defaultdict(set)
    for r in warc.referring(rows, PLAIN, broadcast_bytes=0).collect():
        got[bytes(r["payload"])].add(r["refers_to"])
    assert got[b"<p>copied</p>"] == {None, -3} and got[b"repeated row"] == {None, 2005}
