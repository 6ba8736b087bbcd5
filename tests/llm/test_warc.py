"""Archives written whole, normalised to a member per record, and read back."""

import gzip
import hashlib
import io
import json
import zlib

import pytest

from conftest import SF001
from pyspark.sql import functions as F
from scrubline.llm import warc
from scrubline.llm.common import file_system, table
from scrubline.llm.queries import QUERIES

BIG = "<p>" + "same text " * 200
PAGES = "page_id long, url string, html string, id long, archive string, offset string"


def _pages(spark, rows):
    return spark.createDataFrame([(*r, 9, "x", "y") for r in rows], PAGES)


ROWS = [(1, "http://a/1", BIG), (7, "http://a/7 ä\r\nX: y", BIG), (3, None, BIG),
        (4, "http://a/4", None), (5, "http://a/5", ""), (6, "", "x" * 999), (8, "u", "x" * 999),
        (9, "u", "é" * 500), (10, "u", "é" * 500), (None, "n", "z" * 1000), (11, "u", "z" * 1000),
        (12, "d", "q" * 2000), (12, "d", "q" * 2000),
        (13, "w", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
        (14, "l", "long \x00 text " * 100_000)]


def _want(rows):
    """page id -> its records' (bytes, digest, type, refers_to)."""
    body = [(i, (h or "").encode()) for i, _, h in rows]
    last = {}
    for at, (i, b) in enumerate(body):
        if len(b) >= 1000 and (b not in last or (i is not None and (last[b][0] is None
                                                                    or i >= last[b][0]))):
            last[b] = (i, at)
    out = []
    for at, (i, b) in enumerate(body):
        again = len(b) >= 1000 and last[b][1] != at
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response",
                    last[b][0] if again else None))
    return sorted(out, key=str)


def _bytes(uri):
    system, path = file_system(uri)
    return system.open_input_file(path).read()


def _records(spark, rows, archive_bytes=warc.ARCHIVE_BYTES):
    log = warc.write_archives(_pages(spark, rows), archive_bytes=archive_bytes)
    manifest = warc.normalise(log, warc.repeats(log))
    return manifest, warc.read_records(warc.read_index(manifest)).collect()


@pytest.mark.parametrize("archive_bytes", [warc.ARCHIVE_BYTES, 1])
def test_pages_round_trip(spark, archive_bytes):
    manifest, got = _records(spark, ROWS, archive_bytes)
    pages = [r for r in got if r.record_type != "warcinfo"]
    assert sorted([(r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in pages], key=str) == _want(ROWS)
    text = {i: (h or "").encode() for i, _, h in ROWS}
    assert all(bytes(r.payload) == text[r.id] for r in pages if r.record_type == "response")
    urls = {r.id: r.url for r in pages}
    assert urls[3] is None and urls[1] == "http://a/1"
    assert urls[7] == "http://a/7%20%C3%A4%0D%0AX:%20y"
    by_id = {r.record_id: r for r in pages}
    assert len(by_id) == len(pages)
    for r in pages:  # a revisit names a record that holds its payload
        if r.record_type == "revisit":
            assert by_id[r.refers_id].record_type == "response"
            assert by_id[r.refers_id].payload_digest == r.payload_digest
    rows = manifest.collect()
    assert not any(r.truncated for r in rows) and (len(rows) > 8) == (archive_bytes == 1)
    for r in rows:  # one gzip stream before, one member a record after
        whole, members, lines = (_bytes(r[k]) for k in ("source", "archive", "index"))
        d = zlib.decompressobj(31)
        d.decompress(whole)
        assert d.eof and not d.unused_data
        index = [json.loads(x) for x in lines.splitlines()]
        assert len(index) == r.records and index[-1]["offset"] + index[-1]["length"] == len(members)
        for e in index:
            d = zlib.decompressobj(31)
            d.decompress(members[e["offset"]:e["offset"] + e["length"]])
            assert d.eof and not d.unused_data
        assert gzip.decompress(members).count(b"WARC-Record-ID") == r.records


def test_hot_payload_and_empty_table(spark):
    rows = [(i, "u", BIG if i % 3 else f"page {i} " * 200) for i in range(300)]
    _, got = _records(spark, rows)
    pages = [r for r in got if r.record_type != "warcinfo"]
    assert sum(r.record_type == "revisit" for r in pages) == 199
    assert {r.refers_to for r in pages if r.record_type == "revisit"} == {299}
    _, got = _records(spark, [])
    assert got == []


def test_one_member_is_fetched_by_its_index_row(spark):
    log = warc.write_archives(_pages(spark, ROWS))
    index = warc.read_index(warc.normalise(log))
    one = warc.read_records(index.filter("url = 'http://a/1'")).collect()
    assert [r.id for r in one] == [1] and bytes(one[0].payload) == BIG.encode()


def _stream(data, known=None, chunk=None):
    out, idx = io.BytesIO(), io.BytesIO()
    n, cut = warc.normalise_stream(io.BytesIO(data), out, idx, known or {})
    return n, cut, out.getvalue(), [json.loads(x) for x in idx.getvalue().splitlines()]


def _record(i, block):
    return (f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:{i}>\r\nX-Folded: a\r\n b\r\n"
            f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


@pytest.mark.parametrize("chunk", [1, 7, 1 << 18])
def test_foreign_archives(monkeypatch, chunk):
    """One stream, many members, zero padding between them, and an early end."""
    monkeypatch.setattr(warc, "CHUNK", chunk)
    records = [_record(i, b"ab\r\n\r\n" * i) for i in range(20)]
    whole = gzip.compress(b"".join(records))
    members = b"\0\0".join(gzip.compress(r) for r in records)
    for data in (whole, members):
        n, cut, out, index = _stream(data)
        assert (n, cut) == (20, False)
        for i, e in enumerate(index):
            got = zlib.decompress(out[e["offset"]:e["offset"] + e["length"]], 31)
            assert got.endswith(b"\r\n\r\n" + b"ab\r\n\r\n" * i + b"\r\n\r\n")
            assert e["record_id"] == f"<urn:{i}>" and b"X-Folded: a b\r\n" in got
    n, cut, out, index = _stream(whole[:len(whole) // 2])
    assert cut and 0 < n < 20 and len(index) == n
    assert zlib.decompress(out[index[-1]["offset"]:], 31)
    assert _stream(b"")[:2] == (0, False)
    with pytest.raises(ValueError, match="no WARC record"):
        _stream(gzip.compress(b"<html>\n"))


def test_archives_found_by_path(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"a{k}.warc.gz").write_bytes(gzip.compress(
            b"".join(_record(f"{k}-{i}", b"x" * i) for i in range(k + 1))))
    manifest = warc.normalise(warc.find_archives(spark, f"{tmp_path}/*.warc.gz"))
    got = warc.read_records(warc.read_index(manifest)).collect()
    assert sorted(r.record_id for r in got) == sorted(
        f"<urn:{k}-{i}>" for k in range(3) for i in range(k + 1))
    assert all(r.payload_digest == hashlib.sha1(r.payload).hexdigest() for r in got)


def test_a_changed_payload_is_refused():
    body = warc.http_head(3) + b"abc"
    rec = warc.head([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"),
                     ("WARC-Payload-Digest", warc._labelled(hashlib.sha1(b"abd").hexdigest())),
                     ("Content-Length", str(len(body)))]) + body + b"\r\n\r\n"
    with pytest.raises(ValueError, match="differs"):
        warc.parse_member(gzip.compress(rec), True)


def test_query_covers_all_pages(spark):
    got = QUERIES["op12_warc"](spark, SF001).collect()
    rows = [(r.page_id, r.url, r.html) for r in table(spark, SF001, "pages").collect()]
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in got], key=str) == _want(rows)
    again = table(spark, SF001, "pages").withColumn("page_id", F.col("page_id") + 10_000)
    log = warc.write_archives(table(spark, SF001, "pages").union(again))
    recs = warc.read_records(warc.read_index(warc.normalise(log, warc.repeats(log))), payload=False)
    assert sorted([(r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in recs.collect() if r.record_type != "warcinfo"], key=str) == _want(
        rows + [(i + 10_000, u, h) for i, u, h in rows])
