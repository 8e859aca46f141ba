"""WARC archives: one gzip member per record, and a reader that goes through them in order.

A payload that occurs more than once is stored once; the other records revisit it. The reader decompresses member by
member, takes header and block by their lengths, and checks both digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.files import attempt_name, located, new_folder
from touchline.session import stage

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122
MANIFEST = "archive string, n_records long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def http(self) -> dict[str, str]:
        return fields(self.block.partition(b"\r\n\r\n")[0].split(b"\r\n")[1:])

    @property
    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2]


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page_id}/{payload_digest}')}>"


def member(headers: dict[str, str], block: bytes) -> bytes:
    """One record as one gzip member."""
    headers = {**headers, "WARC-Block-Digest": digest(block), "Content-Length": str(len(block))}
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in headers.items())
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, revisits: bool, refers_to: int | None, date: str) -> bytes:
    """A response with its payload, or a revisit that has only the HTTP header of the response it refers to."""
    payload_digest = digest(payload)
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    headers = {
        "WARC-Type": "revisit" if revisits else "response", "WARC-Record-ID": record_id(page_id, payload_digest),
        "WARC-Date": date, "WARC-Target-URI": target, "Content-Type": "application/http;msgtype=response",
        "WARC-Payload-Digest": payload_digest,
    }
    if page_id is not None:
        headers["X-Page-Id"] = str(page_id)
    if revisits:
        headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to, payload_digest), "X-Refers-To-Page-Id": str(refers_to)}
    return member(headers, http if revisits else http + payload)


def members(file: BinaryIO, chunk: int = 1 << 16) -> Iterator[bytes]:
    """The decompressed members of a gzip file, one after the other; holds one member and one chunk."""
    rest = b""
    while True:
        rest = rest or file.read(chunk)
        if not rest:
            return
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not rest and not (rest := file.read(chunk)):
                raise ValueError("the archive ends inside a gzip member")
            parts.append(unpacker.decompress(rest))
            rest = unpacker.unused_data
        yield b"".join(parts)


def fields(lines: list[bytes]) -> dict[str, str]:
    return {k.strip(): v.strip() for k, _, v in (line.decode().partition(":") for line in lines)}


def read_records(file: BinaryIO) -> Iterator[Record]:
    """Records of an archive in order. A wrong length, version or digest raises ``ValueError``."""
    for data in members(file):
        head, found, rest = data.partition(b"\r\n\r\n")
        version, *lines = head.split(b"\r\n")
        headers = fields(lines)
        size = int(headers.get("Content-Length", -1))
        if not found or not version.startswith(b"WARC/1.") or size < 0 or rest[size:] != b"\r\n\r\n":
            raise ValueError(f"not a record of the announced length: {head[:200]!r}")
        record = Record(headers, rest[:size])
        if headers.get("WARC-Block-Digest") not in (None, digest(record.block)):
            raise ValueError(f"wrong block digest in {headers.get('WARC-Record-ID')}")
        if headers["WARC-Type"] == "response" and headers.get("WARC-Payload-Digest") not in (None, digest(record.payload)):
            raise ValueError(f"wrong payload digest in {headers.get('WARC-Record-ID')}")
        yield record


def write_archives(pages: DataFrame, least: int = 1000, roll_bytes: int = 256 << 20, date: str = "2024-01-01T00:00:00Z", folder: str | None = None) -> DataFrame:
    """Write a record per row of ``pages`` (page_id long, url string, html string); returns the staged manifest.

    The payload is the html in UTF-8, NULL as empty. Of equal payloads of ``least`` bytes or more the one of the
    largest page_id is a response and the others revisit it; smaller ones are all responses. Rows repeated with the
    same page_id and payload are the same page: where it is the response, each of them is. If no row of a payload
    has a page_id, all are responses. A NULL url is written as ``urn:page:<page_id>``. An empty table gives no archive.

    Payloads meet by their SHA-1 as one maximum per payload, combined before the shuffle. The join that gives it back
    to the pages is of two plain tables, so that adaptive execution splits a payload that many pages share. Each task
    writes its own archives, a new one after ``roll_bytes`` of them.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    large = rows.filter(F.octet_length("payload") >= least)
    shared = stage(
        large.groupBy(F.sha1("payload").alias("key")).agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1 AND refers_to IS NOT NULL").drop("n"))
    # Small payloads meet nothing: a key of their own keeps a common one, such as the empty page, out of one task.
    key = F.when(F.octet_length("payload") >= least, F.sha1("payload")).otherwise(F.concat(F.lit("small "), F.xxhash64("page_id", "url")))
    decided = rows.withColumn("key", key).join(shared, "key", "left").select(
        "page_id", "url", "payload", (F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))).alias("revisits"), "refers_to")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file, n, size, done = None, None, 0, 0, []
        for batch in batches:
            columns = batch.columns
            for i in range(batch.num_rows):
                page_id, url, data, revisits, refers_to = (c[i].as_py() for c in columns)
                if file is None:
                    name = f"{folder}/{attempt_name('pages', TaskContext.get().partitionId(), '.warc.gz')}"
                    system, path = located(name)
                    file, n, size = system.open_output_stream(path, compression=None), 0, 0
                    file.write(member({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(NAMES, name)}>", "WARC-Date": date,
                                       "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n"))
                size += file.write(page_record(page_id, url, data, revisits, refers_to, date))
                n += 1
                if size >= roll_bytes:
                    file.close()
                    done.append({"archive": name, "n_records": n})
                    file = None
        if file is not None:
            file.close()
            done.append({"archive": name, "n_records": n})
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=pa.schema([("archive", pa.string()), ("n_records", pa.int64())]))

    return stage(decided.mapInArrow(archive, MANIFEST))


def read_archives(manifest: DataFrame, batch_rows: int = 1000) -> DataFrame:
    """One row per page record of the archives, each read in order by one task.

    Length and digest of a revisit are those of the payload it refers to, from its own headers.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            for row in batch.to_pylist():
                system, path = located(row["archive"])
                rows, n = [], 0
                with system.open_input_stream(path, compression=None) as file:
                    for record in read_records(file):
                        if record.headers["WARC-Type"] == "warcinfo":
                            continue
                        rows.append(page_row(record))
                        n += 1
                        if len(rows) == batch_rows:
                            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                            rows = []
                if n != row["n_records"]:
                    raise ValueError(f"{row['archive']}: {n} records of {row['n_records']}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return manifest.repartition(max(1, manifest.count()), "archive").mapInArrow(read, RECORDS)


def page_row(record: Record) -> dict:
    of = record.headers
    return {
        "page_id": int(of["X-Page-Id"]) if "X-Page-Id" in of else None,
        "payload_bytes": int(record.http["Content-Length"]),
        "payload_digest": base64.b32decode(of["WARC-Payload-Digest"].removeprefix("sha1:")).hex(),
        "record_type": of["WARC-Type"],
        "refers_to": int(of["X-Refers-To-Page-Id"]) if of["WARC-Type"] == "revisit" else None,
    }
