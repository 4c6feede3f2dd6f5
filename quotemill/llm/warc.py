"""Web archive files, one Zstandard frame a record, with a dictionary at the head of each file.

A file is a skippable frame that holds a dictionary built from the file's own first records, then a
frame for each record, compressed with it. Any record can be read by itself, given the dictionary.
Spark's text writer commits the files, so retried and speculative tasks leave none behind; what it
puts between rows is an empty skippable frame, which readers pass over.

Records of equal payloads refer to the one with the smallest key. Payload digests are grouped, not
payloads; those that occur more than once are joined back, so no page is shuffled while they fit a
broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quotemill.llm.staging import deal, stage

# Magic numbers and names of the file formats.
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RESPONSE, REVISIT = "response", "revisit"
#: Bytes of repeated digests and their keys that are broadcast; beyond, they are joined over salts.
BROADCAST_BYTES = 16 << 20
SALTS = 32


@dataclass(frozen=True)
class Archive:
    """How to write: the least payload that may be a revisit, the date that records carry, and the
    bounds of the dictionary and of the records it is built from, per file."""

    revisit_bytes: int = 0
    date: str = "1970-01-01T00:00:00Z"
    level: int = 3
    dictionary_bytes: int = 65_536
    sample_bytes: int = 4 << 20
    sample_records: int = 1_024


# -- records --------------------------------------------------------------------


def record(key: object, url: str | None, payload: bytes, digest: str, refers_to: object, how: Archive) -> bytes:
    """One record: its headers, then a server's answer with the payload, or without it."""
    kind = RESPONSE if refers_to is None else REVISIT
    answer = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = answer + payload if kind == RESPONSE else answer
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(key, digest)}",
        f"WARC-Target-URI: {_uri(url, key)}",
        f"WARC-Date: {how.date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Page-Key: {_field(key)}",
    ]
    if kind == REVISIT:
        lines += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"Refers-To-Key: {_field(refers_to)}",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def record_id(key: object, digest: str) -> str:
    """The same for the same key and payload, so that a revisit knows whom it refers to."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{_field(key)}:{digest}')}>"


def _field(key: object) -> str:
    """A key as a header field; an empty field is null."""
    return "" if key is None else "=" + quote(str(key), safe=":/")


def _uri(url: str | None, key: object) -> str:
    """Characters that end or split a header line are escaped; a page without address has its key."""
    return quote(url, safe="%:/?#[]@!$&'()*+,;=~") if url else f"urn:page:{_field(key)[1:]}"


def parse(data: bytes) -> tuple[dict[str, str], bytes, dict[str, str], bytes]:
    """(headers, block, headers of the answer, payload) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = _headers(head)
    block = rest[: int(headers["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"record {headers.get('WARC-Record-ID')} does not end where it says")
    answer, _, payload = block.partition(b"\r\n\r\n")
    return headers, block, _headers(answer), payload


def _headers(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])


# -- files ----------------------------------------------------------------------


def build_dictionary(samples: list[bytes], how: Archive) -> bytes:
    """A dictionary of at most a sixteenth of the samples; empty where they are too few for one."""
    size = min(how.dictionary_bytes, sum(map(len, samples)) // 16)
    if len(samples) < 8 or size < 512:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # samples that have nothing in common
        return b""


def skippable(content: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content


def compressor(dictionary: bytes, how: Archive) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=how.level, dict_data=known, write_checksum=True)


def frames(content) -> Iterator[bytes]:
    """The records of a file, each from its own frame. The frames' own headers tell where they end."""
    content = memoryview(content).cast("B")
    at, reader = 0, zstandard.ZstdDecompressor()
    while at < len(content):
        magic, size = struct.unpack_from("<II", content, at) if at + 8 <= len(content) else (0, 0)
        if magic in SKIPPABLE:
            if magic == DICTIONARY_MAGIC and size:
                known = zstandard.ZstdCompressionDict(bytes(content[at + 8 : at + 8 + size]))
                reader = zstandard.ZstdDecompressor(dict_data=known)
            at += 8 + size
            continue
        if content[at : at + 4] != FRAME_MAGIC:
            raise ValueError(f"no frame begins at byte {at}")
        end = frame_end(content, at)
        yield reader.decompress(content[at:end])
        at = end


def frame_end(content: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends: after its blocks, each of which has its size."""
    head = bytes(content[at : at + 18])
    checksum = zstandard.get_frame_parameters(head).has_checksum
    at += zstandard.frame_header_size(head)
    last = False
    while not last:
        block = int.from_bytes(content[at : at + 3], "little")
        last, repeated = bool(block & 1), block >> 1 & 3 == 1
        at += 3 + (1 if repeated else block >> 3)
    return at + (4 if checksum else 0)


# -- tables ---------------------------------------------------------------------


def _digested(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(key, url, payload, hash); the payload is the text in UTF-8, null as empty."""
    payload = F.encode(F.coalesce(F.col(f"`{html}`"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"), payload.alias("payload"))
    return rows.withColumn("hash", F.sha1("payload"))


def referring(rows: DataFrame, how: Archive, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` with ``refers_to``: the smallest key of the rows with the same payload, where that is
    another. Groups are counted by digest in parts before they are shuffled."""
    large = F.length("payload") >= how.revisit_bytes
    firsts = rows.filter(large).groupBy("hash").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = stage(firsts.filter("n > 1").select("hash", "first"), "warc-firsts")
    size = firsts.agg(F.sum(F.lit(64) + F.length(F.col("first").cast("string")))).first()[0] or 0
    if size <= broadcast_bytes:
        joined = rows.join(F.broadcast(firsts), "hash", "left")
    else:
        # A payload that a third of all pages share is met in as many tasks as there are salts.
        salted = rows.withColumn("salt", deal(["key", "url"], SALTS))
        spread = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(spread, ["hash", "salt"], "left").drop("salt")
    refers = F.when(large & ~F.col("key").eqNullSafe(F.col("first")), F.col("first"))
    return joined.withColumn("refers_to", refers).drop("first")


def write(
    pages: DataFrame,
    path: str,
    how: Archive = Archive(),
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> None:
    """Write a record per row of ``pages`` to files in the folder ``path``, one file a task.

    Null html: an empty payload. Rows whose payload, of at least ``revisit_bytes``, is also that of
    a smaller key are revisits of the smallest; the rest are responses. Rows that repeat the
    smallest key are all responses, as are rows of a payload that only null keys have; other null
    keys are revisits. Null url: an address made of the key. Empty table: files without records.
    Other columns are ignored.
    """
    rows = referring(_digested(pages, key, url, html), how, broadcast_bytes)

    def files(tables: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample, held, packer = [], 0, None

        def flush():
            nonlocal packer
            dictionary = build_dictionary(sample, how)
            packer = compressor(dictionary, how)
            return [skippable(dictionary), *map(packer.compress, sample)]

        for table in tables:
            out = []
            for row in table.to_pylist():
                digest = base64.b32encode(bytes.fromhex(row["hash"])).decode()
                made = record(row["key"], row["url"], row["payload"], digest, row["refers_to"], how)
                if packer is not None:
                    out.append(packer.compress(made))
                    continue
                sample.append(made)
                held += len(made)
                if len(sample) >= how.sample_records or held >= how.sample_bytes:
                    out += flush()
                    sample.clear()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
        if sample:
            yield pa.RecordBatch.from_arrays([pa.array(flush(), pa.binary())], names=["frame"])

    columns = rows.select("key", "url", "payload", "hash", "refers_to")
    made = columns.mapInArrow(_small_batches(files), "frame binary").select(F.col("frame").cast("string"))
    made.write.option("lineSep", EMPTY_FRAME).text(path)


def _small_batches(step, rows: int = 256):
    """``step`` on parts of the batches, so that lists of Python objects stay small."""

    def parts(tables):
        for table in tables:
            for at in range(0, table.num_rows, rows):
                yield table.slice(at, rows)

    return lambda tables: step(parts(tables))


RECORDS = """file string, record_type string, key string, refers_to string, url string, payload_bytes long,
    payload_digest string, payload binary"""


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row per record: its file, type, key, the key it refers to (both as text), address, length
    and digest of the full payload, and the payload (null for a revisit).

    Of a response, length and digest are computed from the bytes read, and must agree with its
    headers; a revisit has those of its headers.
    """
    arrow = to_arrow_schema(StructType.fromDDL(RECORDS))

    def records(tables: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            for path, content in zip(table.column("path").to_pylist(), table.column("content")):
                made = []
                for data in frames(content.as_buffer()):
                    headers, _, answer, payload = parse(data)
                    said = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    length = int(answer["Content-Length"])
                    if headers["WARC-Type"] == RESPONSE:
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if (digest, len(payload)) != (said, length):
                            raise ValueError(f"payload of {headers['WARC-Record-ID']} in {path} is not what it says")
                    made.append(
                        {
                            "file": path,
                            "record_type": headers["WARC-Type"],
                            "key": _key(headers["Page-Key"]),
                            "refers_to": _key(headers.get("Refers-To-Key", "")),
                            "url": headers["WARC-Target-URI"],
                            "payload_bytes": length,
                            "payload_digest": said,
                            "payload": payload if headers["WARC-Type"] == RESPONSE else None,
                        }
                    )
                    if len(made) == 256:
                        yield pa.RecordBatch.from_pylist(made, schema=arrow)
                        made = []
                if made:
                    yield pa.RecordBatch.from_pylist(made, schema=arrow)

    stored = spark.read.format("binaryFile").load(path).select("path", "content")
    return stored.mapInArrow(records, RECORDS)


def _key(field: str) -> str | None:
    return unquote(field[1:]) if field else None


def with_payloads(records: DataFrame) -> DataFrame:
    """``records`` as ``read`` gives them, with the payload of the response in each revisit.

    The join is by equality, so adaptive execution splits the revisits of a hot response.
    """
    responses = records.filter(F.col("record_type") == RESPONSE).select(
        F.col("key").alias("refers_to"), "payload_digest", F.col("payload").alias("_payload")
    )
    found = records.join(responses.dropDuplicates(["refers_to", "payload_digest"]), ["refers_to", "payload_digest"], "left")
    return found.withColumn("payload", F.coalesce("payload", "_payload")).drop("_payload")
