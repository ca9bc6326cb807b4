"""Archives: digests, revisits, and the way from one gzip stream to single members."""

import gzip
import hashlib
import io
import zlib
from urllib.parse import urlparse

import pytest

from patronage.llm import warc
from patronage.llm.staging import new_path, staged

PAGES = "page_id long, url string, html string, record_id string, size int"


def rows():
    long, trap = "x" * 1500, "WARC/1.1\r\n\r\n\r\nContent-Length: 3\r\n\r\n" + "é" * 600
    return [(1, "u", long, "r", 1), (2, "u\r\nX: y", long, "r", 1), (3, None, "short", "r", 1), (4, "u", "short", "r", 1), (5, "u", None, "r", 1),
            (6, "u", "", "r", 1), (7, "u", trap, "r", 1), (8, "u", trap, "r", 1), (9, "u", "y" * 3_000_000, "r", 1), (10, "u", "\r\n\r\n" * 400, "r", 1),
            (None, "u", long, "r", 1), (3, None, "short", "r", 1), (11, "u", "z" * 1000, "r", 1), (12, "u", "z" * 1000, "r", 1), (13, "u", "z" * 999, "r", 1), (14, "u", "z" * 999, "r", 1)]


def expected(pages):
    body = [(p[0], (p[2] or "").encode()) for p in pages]
    first = {}
    for d, b in body:
        if len(b) >= 1000 and d is not None:
            first[b] = max(first.get(b, d), d)
    return sorted((("" if d is None else str(d)), "response" if first.get(b, d) == d else "revisit", len(b), hashlib.sha1(b).hexdigest(),
                   None if first.get(b, d) == d else str(first[b])) for d, b in body)


def archive(spark, pages):
    whole, parts = new_path(spark, "t-whole"), new_path(spark, "t-parts")
    warc.write_monolithic(warc.page_records(spark.createDataFrame(pages, PAGES).repartition(3)), whole, rows_per_file=4)
    return whole, staged(warc.normalise(warc.archive_files(spark, whole), parts), "t-index")


def test_round_trip(spark):
    whole, index = archive(spark, rows())
    got = warc.read_records(index).collect()
    assert sorted(((r.record_id, r.warc_type, r.payload_bytes, r.payload_digest, r.refers_to) for r in got), key=repr) == sorted(expected(rows()), key=repr)
    for r in got:
        if r.warc_type == "response":
            assert len(r.body) == r.payload_bytes and hashlib.sha1(r.body).hexdigest() == r.payload_digest
        else:
            assert r.body == b""


def test_members(spark):
    """Every record is a gzip member at its offset, and the whole file is still one gzip stream."""
    _, index = archive(spark, rows())
    by_file = {}
    for r in index.collect():
        by_file.setdefault(r.file, []).append(r)
    for file, members in by_file.items():
        data = open(urlparse(file).path, "rb").read()
        end, plain = 0, b""
        for m in sorted(members, key=lambda m: m.offset):
            assert m.offset == end
            one = zlib.decompressobj(31)
            text = one.decompress(data[m.offset:m.offset + m.length])
            assert one.eof and not one.unused_data and text.startswith(b"WARC/1.1\r\n")
            end, plain = end + m.length, plain + text
        assert end == len(data) and gzip.decompress(data) == plain


def test_index_is_handed_on_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(warc, "INDEX_ROWS", 3)
    _, index = archive(spark, rows())
    assert index.count() == len(rows()) and warc.read_records(index).count() == len(rows())


def test_empty(spark):
    _, index = archive(spark, [])
    assert index.count() == 0 and warc.read_records(index).count() == 0


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_streams(size, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", size)
    plain = b"WARC/1.0\r\nContent-Length: 4\r\n\r\n\r\n\r\n\r\n\r\nWARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    for data in (gzip.compress(plain), gzip.compress(plain[:20]) + gzip.compress(plain[20:])):
        assert [r.body for r in warc.parse(warc.inflated(io.BytesIO(data)))] == [b"\r\n\r\n", b""]


def test_pieces_begin_anywhere():
    """A piece that begins with the line ends between two records once was taken for a header."""
    record = lambda body: b"WARC/1.1\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"
    bodies = [b"one", b"", b"\r\n\r\n", b"two\r\n"]
    plain = b"".join(map(record, bodies))
    for i in range(len(plain) + 1):
        for j in range(i, len(plain) + 1):
            assert [r.body for r in warc.parse(iter([plain[:i], plain[i:j], plain[j:]]))] == bodies
    assert list(warc.parse(iter([]))) == list(warc.parse(iter([b"\r\n", b"\r\n"]))) == []


@pytest.mark.parametrize("size", [2, 3, 5, 11, 64])
def test_round_trip_in_small_pieces(spark, monkeypatch, size):
    monkeypatch.setattr(warc, "READ_BYTES", size)
    pages = [(i, "u", "x" * (i % 23), "r", 1) for i in range(200)]
    _, index = archive(spark, pages)
    got = sorted((int(r.record_id), r.body.decode()) for r in warc.read_records(index).collect())
    assert got == [(i, t) for i, _, t, *_ in pages]


def test_broken():
    for plain in (b"WARC/1.0\r\nContent-Length: 9\r\n\r\nshort", b"HTTP/1.1 200\r\n\r\n", b"WARC/1.0\r\nContent"):
        with pytest.raises(ValueError):
            list(warc.parse(iter([plain])))
