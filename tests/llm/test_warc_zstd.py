import hashlib
import struct

import pytest

from llm import warc_zstd
from llm.warc_zstd import ArchiveError, read_archive, record, round_trip, write_archive

PAGE = "<p>" + "text " * 60 + "</p>"


def pages(spark, rows):
    return spark.createDataFrame([row + (7, 7) for row in rows], "page_id long, url string, html string, digest long, first long")


def test_round_trip_of_all_cases(spark):
    rows = [
        (5, "http://a/ b\n", PAGE), (3, "http://a", PAGE), (9, None, PAGE), (1, "u", "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""),
        (7, "u", "ü" * 50), (8, "u", "ü" * 50), (10, "u", "ü" * 49), (11, "u", "ü" * 49), (None, "u", PAGE + "x"), (12, "u", "z" * 3_000_000),
        (13, "u", PAGE + "y"), (13, "u", PAGE + "y"),
    ]
    found = round_trip(pages(spark, rows)).collect()
    assert len(found) == len(rows)
    for page, _, html in rows:
        raw = (html or "").encode()
        one = next(row for row in found if row["page_id"] == page)
        assert (one["payload_bytes"], one["payload_digest"]) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert one["payload"] == (raw if one["record_type"] == "response" else None)
    types = {row["page_id"]: (row["record_type"], row["refers_to"]) for row in found}
    assert types[3] == ("response", None) and types[5] == types[9] == ("revisit", 3) and types[8] == ("revisit", 7)
    assert all(types[page] == ("response", None) for page in (1, 2, 4, 6, 7, 10, 11, None, 12, 13))
    assert next(row["url"] for row in found if row["page_id"] == 5) == "http://a/%20b%0A"
    assert round_trip(pages(spark, [])).collect() == []


def archive(count=40):
    payloads = [f"<html>{number} {PAGE}</html>".encode() for number in range(count)]
    return write_archive([record(at, "u", raw, hashlib.sha256(raw).hexdigest(), None) for at, raw in enumerate(payloads)]), payloads


def test_dictionary_is_a_leading_skippable_frame_and_frames_stand_alone():
    content, payloads = archive()
    magic, size = struct.unpack_from("<II", content)
    assert magic == warc_zstd.DICTIONARY_MAGIC
    at, view = 8 + size, memoryview(content)
    front, ends = content[:at], []
    while at < len(content):
        end = warc_zstd.frame_end(view, at)
        ends.append((at, end))
        at = end
    assert len(ends) == len(payloads)
    begin, end = ends[17]
    assert [row[-1] for row in read_archive(front + content[begin:end])] == [payloads[17]]
    assert [row[0] for row in read_archive(write_archive([record(1, None, b"", hashlib.sha256(b"").hexdigest(), None)]))] == [1]


@pytest.mark.parametrize("harm", ["cut", "flip", "length", "digest", "type", "version"])
def test_broken_archives_are_refused(harm):
    raw = PAGE.encode()
    good = record(1, "u", raw, hashlib.sha256(raw).hexdigest(), None)
    if harm == "cut":
        broken = write_archive([good])[:-9]
    elif harm == "flip":
        whole = bytearray(write_archive([good]))
        whole[-6] ^= 0xFF
        broken = bytes(whole)
    else:
        change = {
            "length": (f"Content-Length: {len(raw)}".encode(), f"Content-Length: {len(raw) + 1}".encode()), "digest": (b"sha256:", b"sha256:0"),
            "type": (b"WARC-Type: response", b"WARC-Type: metadata"), "version": (b"WARC/1.1", b"WARC/9.9"),
        }[harm]
        broken = write_archive([good.replace(*change)])
    with pytest.raises(ArchiveError):
        list(read_archive(broken))
