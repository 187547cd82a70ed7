import base64
import gzip
import hashlib

import pytest

from tabletransfer.llm.shared import new_path
from tabletransfer.llm.warc import parse_archive, read_archives, round_trip, transactions, write_archives

SCHEMA = "page_id long, url string, html string"


@pytest.fixture
def pages(spark):
    same, small = "<p>équal</p>\r\n\r\nWARC/1.1\r\n" * 6, "tiny"
    rows = [(5, "http://a/x", same), (3, "http://a/y z\r\nX: 1", same), (9, None, same), (1, "http://b/", small), (2, "http://b/", small),
            (4, "http://c/", None), (6, "http://c/", ""), (7, "http://d/", "ü" * 50), (8, "http://d/", "ü" * 50),
            (10, "http://e/", "long " * 100_000), (None, "http://f/", same)]
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as row", "2 as own", "3 as payload_digest")


def brute(rows):
    first, out = {}, []
    for page, html in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        known = first.setdefault(digest, page) if len(data) >= 100 else page
        revisit = known != page
        out.append((page, len(data), digest, "revisit" if revisit else "response", known if revisit else None))
    return sorted(out, key=repr)


def test_round_trip(spark, pages):
    got = sorted((tuple(r) for r in round_trip(pages, new_path(spark, "warc")).collect()), key=repr)
    assert got == brute([(r.page_id, r.html) for r in pages.collect()])
    assert sum(r[3] == "revisit" for r in got) == 4


def test_many_files_and_empty_table(spark, pages, monkeypatch):
    from tabletransfer.llm import warc
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 2)
    got = sorted((tuple(r) for r in round_trip(pages, new_path(spark, "warc")).collect()), key=repr)
    assert got == brute([(r.page_id, r.html) for r in pages.collect()])
    assert round_trip(pages.limit(0), new_path(spark, "warc")).collect() == []


def test_transactions_are_nested(spark, pages):
    path = new_path(spark, "warc")
    write_archives(pages, path)
    rows = {r.page_id: r for r in transactions(read_archives(spark, path)).collect()}
    assert len(rows) == pages.count()
    for page in pages.collect():
        row = rows[page.page_id]
        assert len(row.requests) == 1 and len(row.metadata) == 1
        if row.response.type == "response":
            assert bytes(row.response.payload).decode() == (page.html or "")
        else:
            assert row.response.payload is None
    assert rows[3].response.target_uri == "http://a/y%20z%20%20X:%201"


def test_repeated_rows(spark):
    rows = [(1, "u", "z" * 200), (1, "u", "z" * 200), (2, "u", "z" * 200)]
    got = round_trip(spark.createDataFrame(rows, SCHEMA), new_path(spark, "warc")).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got if r.record_type == "revisit") == [(1, "revisit", 1), (2, "revisit", 1)]
    assert len(got) == 3


def test_records_of_several_members_and_damage():
    block = b"HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nhi"
    digest = hashlib.sha256(b"hi").hexdigest()
    record = (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nWARC-Payload-Digest: sha256:{digest}\r\n"
              f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"
    rows = list(parse_archive(gzip.compress(record) + gzip.compress(record)))
    assert [r["payload"] for r in rows] == [b"hi", b"hi"]
    with pytest.raises(ValueError, match="cut short"):
        list(parse_archive(gzip.compress(record[:-6])))
    with pytest.raises(ValueError, match="digest"):
        list(parse_archive(gzip.compress(record.replace(b"hi", b"ho"))))


def foreign(kind, number, *headers, block=b""):
    lines = [f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{number}>\r\n".encode(), *[h.encode("latin-1") + b"\r\n" for h in headers]]
    return b"".join(lines) + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_records_of_other_writers():
    payload = b"hello"
    block = b"HTTP/1.1 200 OK\r\nX-Long: a\r\n b\r\n\r\n" + payload
    sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    good = [f"WARC-Payload-Digest: sha1:{sha1}", f"WARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}",
            f"WARC-Payload-Digest: MD5:{hashlib.md5(payload).hexdigest().upper()}", "WARC-Payload-Digest: blake9:abc", "X-None: 1"]
    archive = b"".join(foreign("response", n, h, "WARC-Target-URI: http://x/\xe9", block=block) for n, h in enumerate(good))
    for content in (archive, gzip.compress(archive)):
        rows = list(parse_archive(content))
        assert [(r["payload"], r["payload_bytes"], r["payload_digest"]) for r in rows] == [(payload, 5, hashlib.sha256(payload).hexdigest())] * 5
        assert all(r["target_uri"].startswith("http://x/") for r in rows)
    with pytest.raises(ValueError, match="digest"):
        list(parse_archive(foreign("response", 1, f"WARC-Payload-Digest: sha1:{sha1}", block=block + b"!")))
    with pytest.raises(ValueError, match="no length"):
        list(parse_archive(b"WARC/1.0\r\nWARC-Type: response\r\n\r\n"))
    (revisit,) = parse_archive(foreign("revisit", 7, f"WARC-Payload-Digest: sha1:{sha1}", block=b"HTTP/1.1 200 OK\r\n\r\n"))
    assert (revisit["payload_bytes"], revisit["payload_digest"]) == (None, f"sha1:{sha1}")
    (several,) = parse_archive(foreign("metadata", 8, "WARC-Concurrent-To: <1>", "WARC-Concurrent-To:", " <2>", block=b"page-id: x\r\n"))
    assert several["concurrent_to"] == ["<1>", "<2>"] and several["page_id"] is None


def test_transactions_of_other_writers(spark, tmp_path):
    """Responses that name their request, records that name several captures or none."""
    http = b"HTTP/1.1 200 OK\r\n\r\nbody"
    archive = b"".join([
        foreign("warcinfo", "i", block=b"software: x\r\n"), foreign("response", 1, "WARC-Concurrent-To: <3>", block=http),
        foreign("response", 2, block=http), foreign("request", 3, "WARC-Concurrent-To: <1>", block=b"GET / HTTP/1.1\r\n\r\n"),
        foreign("request", 4, block=b"GET / HTTP/1.1\r\n\r\n"), foreign("metadata", 5, "WARC-Concurrent-To: <1>", "WARC-Concurrent-To: <2>", block=b"page-id: 9\r\n"),
        foreign("metadata", 6, "WARC-Concurrent-To: <gone>")])
    (tmp_path / "a.warc").write_bytes(archive)
    rows = {r.record_id: r for r in transactions(read_archives(spark, str(tmp_path))).collect()}
    got = {i: ([q.record_id for q in r.requests], [m.record_id for m in r.metadata], r.page_id) for i, r in rows.items()}
    assert got == {"<1>": (["<3>"], ["<5>"], 9), "<2>": ([], ["<5>"], 9)}
