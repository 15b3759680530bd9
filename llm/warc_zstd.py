"""WARC archives in Zstandard: a dictionary in front, then one frame per record.

An archive begins with a skippable frame that holds the dictionary for all frames
after it; each record is a frame of its own, so a reader can start at any record.
Archives are rows (path, content), as Spark's ``binaryFile`` source gives them for
files, and are written as a table in the shared folder, so that any store that
Spark reaches can hold them.

Of pages with equal payloads of at least ``REVISIT_BYTES`` bytes, that with the
smallest id is written as a response, the others as revisits that carry headers
only. One shuffle brings equal payloads' ids together: per digest only the least
id is kept, joined back by digest.

Defined results: a null html is an empty payload; a null id is written and read as
null, and is never the one referred to unless all equal ones are null (then all of
them are responses); rows that repeat the smallest id with the same payload are all
responses; an empty table gives no archives; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import small_batches, stage

REVISIT_BYTES = 100
ARCHIVE_BYTES = 8 << 20
DICTIONARY_BYTES = 32 << 10
TRAINING_RECORDS = 128
TRAINING_BYTES = 2 << 20
LEVEL = 3
# Fixed values of the two formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVES = "path string, content binary"
RECORDS = "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary"
_UNSAFE = re.compile("[\x00-\x20\x7f]")


class ArchiveError(ValueError):
    """An archive that breaks the format, or a record that differs from its headers."""


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    match = re.fullmatch(r"<urn:page:(none|-?\d+)>", name)
    if not match:
        raise ArchiveError(f"no record id: {name}")
    return None if match[1] == "none" else int(match[1])


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One record. A revisit keeps the HTTP header, with the payload's length, and no payload."""
    revisit = refers_to is not None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    headers = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}"]
    if url is not None:
        headers.append("WARC-Target-URI: " + _UNSAFE.sub(lambda match: f"%{ord(match[0]):02X}", url))
    headers += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        headers += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    headers += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join([*headers, "", ""]).encode() + block + b"\r\n\r\n"


def header_fields(lines: list[str]) -> dict[str, str]:
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise ArchiveError(f"no header: {line!r}")
        fields[name.lower()] = value.strip()
    return fields


def parse_record(data: bytes) -> tuple:
    """The record's row; raises ArchiveError where headers, lengths or digest are wrong."""
    head, split, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != VERSION or not split:
        raise ArchiveError(f"no record: {version!r}")
    fields = header_fields(lines)
    for name in ("warc-type", "warc-record-id", "warc-date", "warc-payload-digest", "content-length"):
        if name not in fields:
            raise ArchiveError(f"{name} is missing")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ArchiveError(f"{len(rest) - 4} bytes in the block of {length}")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    payload_bytes = int(header_fields(http.decode().split("\r\n")[1:])["content-length"])
    digest, kind = fields["warc-payload-digest"].removeprefix("sha256:"), fields["warc-type"]
    refers_to = page_of(fields["warc-refers-to"]) if kind == "revisit" else None
    if kind == "response":
        if len(payload) != payload_bytes or hashlib.sha256(payload).hexdigest() != digest:
            raise ArchiveError(f"the payload of {fields['warc-record-id']} differs from its headers")
    elif kind != "revisit" or payload:
        raise ArchiveError(f"unexpected record of type {kind}")
    page_id = page_of(fields["warc-record-id"])
    return page_id, fields.get("warc-target-uri"), kind, refers_to, digest, payload_bytes, payload if kind == "response" else None


def dictionary(records: list[bytes]) -> bytes:
    """A dictionary trained on the first records of the archive, or their text where that is too little to train on."""
    samples, size = [], 0
    for data in records[:TRAINING_RECORDS]:
        if size >= TRAINING_BYTES:
            break
        samples.append(data[: TRAINING_BYTES - size])
        size += len(samples[-1])
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, size // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def write_archive(records: list[bytes]) -> bytes:
    raw = dictionary(records)
    packed = zstandard.ZstdCompressor(level=LEVEL).compress(raw)
    compressor = zstandard.ZstdCompressor(
        level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=True, write_checksum=True
    )
    front = struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed
    return b"".join([front, *(compressor.compress(data) for data in records)])


def frame_end(content: memoryview, at: int) -> int:
    """Where the frame that begins here ends, from the sizes of its blocks."""
    if len(content) - at < 9 or struct.unpack_from("<I", content, at)[0] != FRAME_MAGIC:
        raise ArchiveError(f"no frame at {at}")
    front = bytes(content[at : at + 18])
    end, last = at + zstandard.frame_header_size(front), False
    while not last:
        if end + 3 > len(content):
            raise ArchiveError(f"the frame at {at} is cut off")
        header = int.from_bytes(content[end : end + 3], "little")
        last, repeated = header & 1, header >> 1 & 3 == 1
        end += 3 + (1 if repeated else header >> 3)
    end += 4 * zstandard.get_frame_parameters(front).has_checksum
    if end > len(content):
        raise ArchiveError(f"the frame at {at} is cut off")
    return end


def read_archive(content: bytes) -> Iterator[tuple]:
    """The rows of an archive's records, one frame at a time."""
    view, raw, at = memoryview(content), None, 0
    if len(view) >= 8 and struct.unpack_from("<I", view)[0] == DICTIONARY_MAGIC:
        at = 8 + struct.unpack_from("<I", view, 4)[0]
        raw = bytes(view[8:at])
        if len(raw) != at - 8:
            raise ArchiveError("the dictionary is cut off")
        if raw[:4] == struct.pack("<I", FRAME_MAGIC):
            raw = zstandard.ZstdDecompressor().decompress(raw)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    while at < len(view):
        end = frame_end(view, at)
        try:
            data = reader.decompress(bytes(view[at:end]))
        except zstandard.ZstdError as error:
            raise ArchiveError(f"the frame at {at} can't be read: {error}") from error
        yield parse_record(data)
        at = end


def with_record_types(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, payload, digest and, for revisits, the page referred to."""
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "utf-8")
    chosen = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    digested = chosen.withColumn("digest", F.sha2("payload", 256))
    long_enough = F.octet_length("payload") >= REVISIT_BYTES
    first = digested.where(long_enough).groupBy("digest").agg(F.min("page_id").alias("first"))
    refers_to = F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first"))
    large = digested.where(long_enough).join(first, "digest").withColumn("refers_to", refers_to)
    small = digested.where(~long_enough).withColumn("refers_to", F.lit(None).cast("bigint"))
    columns = ["page_id", "url", "payload", "digest", "refers_to"]
    return large.select(*columns).unionByName(small.select(*columns))


def write_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number, waiting, size = TaskContext.get().partitionId(), 0, [], 0

    def archive() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([f"part-{part:06d}-{number:06d}.warc.zst"]), pa.array([write_archive(waiting)], pa.binary())],
            names=["path", "content"],
        )

    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            waiting.append(record(*row))
            size += len(waiting[-1])
            if size >= ARCHIVE_BYTES:
                yield archive()
                number, waiting, size = number + 1, [], 0
    if waiting:
        yield archive()


def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [part.split()[0] for part in RECORDS.split(", ")]
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows, size = [], 0
            try:
                for row in read_archive(content):
                    rows.append(row)
                    size += len(row[-1] or b"")
                    if size >= ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows, size = [], 0
            except ArchiveError as error:
                raise ArchiveError(f"{path}: {error}") from error
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def to_archives(pages: DataFrame, **columns: str) -> DataFrame:
    """Archives (path, content) of all pages."""
    small_batches(pages.sparkSession)
    typed = with_record_types(pages, **columns)
    return typed.mapInArrow(write_batches, ARCHIVES)


def from_archives(archives: DataFrame) -> DataFrame:
    """The records of archives (path, content, and more): every frame is decoded and checked."""
    return archives.select("path", "content").mapInArrow(read_batches, RECORDS)


def round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """Write the archives to the shared folder and read them back."""
    return from_archives(stage(to_archives(pages, **columns), "warc"))
