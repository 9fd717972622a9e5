"""WARC archives whose records are compressed one by one with a dictionary of their own.

An archive begins with a skippable Zstandard frame that holds the dictionary; each record is a frame after
it. A record whose payload another one has already (in bytes, and long enough to matter) becomes a revisit.
"""

from __future__ import annotations

import hashlib
import struct
import urllib.parse
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text
from ._scratch import Scratch

#: Fixed values of the dictionary frame and of a trained dictionary, and the date that records carry.
DICTIONARY_MAGIC, TRAINED_MAGIC = 0x184D2A5D, 0xEC30A437
RECORD_DATE = "2024-01-01T00:00:00Z"
#: Payloads of fewer bytes are never revisits.
REVISIT_BYTES = 100
#: Raw bytes of an archive's records, the bytes of them that the dictionary is trained on, and its size.
ARCHIVE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES = 16 << 20, 2 << 20, 64 << 10
LEVEL = 6
#: A group of equal payloads is dealt out to so many tasks.
SALTS = 32
#: Bytes of an archive that are read at a time.
READ_BYTES = 32 << 10


def _head(lines: list[tuple[str, str]], first: str) -> bytes:
    return (first + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n").encode()


def _plain(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in value)


def record(page: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record; with ``refers_to`` a revisit, which keeps the HTTP head and leaves the payload out."""
    http = _head([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], "HTTP/1.1 200 OK")
    block = http if refers_to is not None else http + payload
    lines = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(page, url, digest)), ("WARC-Date", RECORD_DATE)]
    if url is not None:
        lines.append(("WARC-Target-URI", _plain(url)))
    if page is not None:
        lines.append(("X-Page", urllib.parse.quote(page)))
    if refers_to is not None:
        lines += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _record_id(refers_to)), ("X-Refers-To-Page", urllib.parse.quote(refers_to))]
    lines += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return _head(lines, "WARC/1.1") + block + b"\r\n\r\n"


def _record_id(page: str | None, url: str | None = None, digest: str = "") -> str:
    """From the page's key, or without one from what is known of it, so that a repeated task names records alike."""
    seed = f"page:{page}" if page is not None else f"no page:{url}:{digest}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, seed)}>"


def _info(name: str) -> bytes:
    block = b"software: strataflow\r\nformat: WARC File Format 1.1\r\n"
    return _head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"), ("WARC-Date", RECORD_DATE), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(block)))], "WARC/1.1") + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on records drawn evenly, SAMPLE_BYTES of them; where they are too few to train on, their ends."""
    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    samples = [r[: SAMPLE_BYTES // 8] for r in records[::step]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-DICTIONARY_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_archive(name: str, records: list[bytes]) -> Iterator[bytes]:
    """The parts of an archive's file."""
    dictionary = build_dictionary(records)
    packed = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary.as_bytes())
    yield struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed
    dictionary.precompute_compress(level=LEVEL)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
    for x in (_info(name), *records):
        yield compressor.compress(x)


def read_archive(file) -> Iterator[bytes]:
    """The records of an archive, one frame at a time."""
    magic, size = struct.unpack("<II", file.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive doesn't begin with a dictionary")
    data = zstandard.ZstdDecompressor().decompress(file.read(size))
    trained = len(data) >= 4 and struct.unpack("<I", data[:4])[0] == TRAINED_MAGIC
    dictionary = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    rest = file.read(READ_BYTES)
    while rest:
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if not rest:
                raise ValueError("the archive ends inside a record")
            parts.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else file.read(READ_BYTES)
        yield b"".join(parts)
        rest = rest or file.read(READ_BYTES)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) for x in lines)
    size = int(headers["Content-Length"])
    if not first.startswith("WARC/1.") or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return headers, rest[:size]


def _described(raw: bytes) -> tuple[str | None, int, str, str, str | None] | None:
    """page, payload bytes, digest, type, page referred to; None of a record that holds no page."""
    headers, block = parse(raw)
    kind = headers["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    head, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} isn't what was archived")
    page, refers = (None if x is None else urllib.parse.unquote(x) for x in (headers.get("X-Page"), headers.get("X-Refers-To-Page")))
    return page, size, digest, kind, refers


def _with_originals(pages: DataFrame, scratch: Scratch, key: str, url: str, html: str) -> DataFrame:
    """page, url, payload, digest, refers_to of each row. Groups of equal payloads are dealt out by a salt."""
    payload = F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(key).alias("page"), F.col(url).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    first = rows.filter(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("rows")).filter("rows > 1")
    first = scratch.table(first.select(F.col("digest").alias("d"), "first"), "first").withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page", "url"), F.lit(SALTS)).cast("int"))
    joined = rows.join(first, (F.col("digest") == F.col("d")) & (F.col("salt") == F.col("s")), "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page")), F.col("first"))
    return joined.select(F.col("page").cast("string").alias("page"), "url", "payload", "digest", refers.cast("string").alias("refers_to"))


def write_archives(pages: DataFrame, scratch: Scratch, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes a record for each row of ``pages`` under ``folder``; returns path, records, bytes of each archive.

    A null html is an empty payload; keys of any type come back as they were; texts may be as long as memory for
    one record allows, and other columns aren't read, whatever their names. Of rows with equal payloads of REVISIT_BYTES or more, the one with the
    least key is the response and the others revisit it; rows that tie for the least key are all responses,
    and where every key of a group is null all are. An archive is written by one task under a name of its
    own and counts only once its row is in the returned table, so a task that is lost or repeated leaves at
    most a file that nothing lists.
    """
    rows = _with_originals(pages, scratch, key, url, html)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = fs.FileSystem.from_uri(folder)
        target.create_dir(base, recursive=True)
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.zst"
            written = 0
            with target.open_output_stream(f"{base}/{name}", compression=None) as out:
                for part in write_archive(name, held):
                    written += len(part)
                    out.write(part)
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(held)], pa.int64()), pa.array([written], pa.int64())], ["path", "records", "bytes"])

        for batch in batches:
            for page, address, payload, digest, refers in zip(*(batch.column(i) for i in range(5)), strict=True):
                held.append(record(page.as_py(), address.as_py(), payload.as_py(), digest.as_py(), refers.as_py()))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return scratch.table(rows.mapInArrow(_text.lean(write), "path string, records long, bytes long"), "archives")


def read_archives(archives: DataFrame, key: str, key_type: str) -> DataFrame:
    """key, payload_bytes, payload_digest, record_type, refers_to of each page in the archives listed."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                source, at = fs.FileSystem.from_uri(path)
                with source.open_input_stream(at, compression=None) as file:
                    found = [x for x in map(_described, read_archive(file)) if x is not None]
                columns = list(zip(*found, strict=True)) or [()] * 5
                types = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["page", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    rows = archives.select("path").repartition(max(1, archives.count())).mapInArrow(_text.lean(read), "page string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return rows.select(F.col("page").cast(key_type).alias(key), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(key_type).alias("refers_to"))


def pages_archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    with Scratch(spark, "warc") as scratch:
        archives = write_archives(pages, scratch, scratch.path("files"))
        return scratch.publish(read_archives(archives, "page_id", pages.schema["page_id"].dataType.simpleString()))


ORACLE_SQL = """
SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
       CASE WHEN strlen(coalesce(html, '')) >= 100 AND page_id <> least_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(coalesce(html, '')) >= 100 AND page_id <> least_id THEN least_id END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS least_id FROM pages)
"""
