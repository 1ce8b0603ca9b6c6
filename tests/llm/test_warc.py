"""Round trips through archives, and their bytes as another reader sees them."""

import gzip
import hashlib
import re

import inputs
import pytest

from ledgerloom.llm import warc


def rows():
    big, other = "<p>é</p>" * 40, "x" * 100
    return [(1, "http://a.example/x y", big), (2, "http://a.example/", big), (3, None, other), (4, "u", other),
            (5, "u", "x" * 99), (6, "u", "x" * 99), (7, "u\r\nWARC/1.1", None), (8, "u", ""), (0, "u", other),
            (9, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n" * 3), (10, "u", "\r\n\r\n" * 50),
            (11, "u", "\n"), (2, "u", big), (None, "u", "null id")]


def plain(pages):
    found = []
    for page_id, _, page in pages:
        raw = (page or "").encode()
        same = [p for p, _, h in pages if (h or "").encode() == raw and p is not None]
        first = min(same, default=page_id) if len(raw) >= 100 else page_id
        again = page_id is not None and page_id != first
        found.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response",
                      first if again else None))
    return sorted(found, key=str)


def test_round_trip(spark, tmp_path):
    pages = inputs.pages(spark, rows())
    got = [tuple(r) for r in warc.round_trip(pages, str(tmp_path / "a")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=str) == plain(rows())
    assert warc.round_trip(pages.limit(0), str(tmp_path / "b")).count() == 0


def test_archives_hold_each_payload_once(spark, tmp_path):
    warc.write_archives(inputs.pages(spark, rows()), str(tmp_path / "a"))
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "a").glob("part-*"))
    assert whole.count(("<p>é</p>" * 40).encode()) == 1 and whole.count(b"WARC-Type: revisit") == 4
    assert len(list(warc.parse(whole))) == len(rows())
    for head in re.findall(rb"WARC/1\.1\r\nWARC-Type: revisit.*?\r\n\r\n", whole, re.S):
        assert b"WARC-Refers-To: <urn:page:" in head and b"WARC-Profile: " in head


def test_broken_archives_raise():
    for raw in (b"x", b"WARC/1.1\r\nContent-Length: 9\r\nWARC-Type: response\r\n\r\nabc\r\n\r\n"):
        with pytest.raises((ValueError, KeyError)):
            list(warc.parse(raw))
