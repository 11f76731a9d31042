import gzip
import hashlib

import pytest
from llm_helpers import pandas_of, rows_of

from waveline.llm import warc

RECORDS = [warc.ArcRecord("http://a.example/x y", "192.0.2.7", "20010203040506", "text/html", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n<p>\n1 2 3\n</p>"), warc.ArcRecord("http://b.example/", "192.0.2.8", "20010203", "text/plain", b"bare\n\nWARC/1.1\r\n"), warc.ArcRecord("http://c.example/", "192.0.2.8", "20010203040506", "text/plain", b"")]


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(version):
    got = list(warc.parse_arc(warc.pack_arc(RECORDS, version)))
    assert [(r.url, r.ip, r.date, r.content_type, r.block) for r in got] == [(r.url.replace(" ", "%20"), r.ip, r.date, r.content_type, r.block) for r in RECORDS]


def test_arc_with_blanks_in_its_urls():
    data = warc.pack_arc(RECORDS[:1], 1).replace(b"x%20y", b"x y z")
    assert [r.url for r in warc.parse_arc(data)] == ["http://a.example/x y z"]


@pytest.mark.parametrize("cut", [1, 5, 30])
def test_torn_arc(cut):
    with pytest.raises(ValueError):
        list(warc.parse_arc(warc.pack_arc(RECORDS[:2], 1)[: -cut - 1]))
    with pytest.raises(ValueError):
        list(warc.parse_arc(b"http://x 1.2.3.4 20010101000000 text/html 3\nabc\n"))


def test_conversion():
    (data, digest), again = warc.to_warc(RECORDS[0], 9), warc.to_warc(RECORDS[0], 9)
    fields, block = warc.parse_warc(data)
    assert (data, digest) == again and block == RECORDS[0].block
    assert digest == hashlib.sha1(b"<p>\n1 2 3\n</p>").hexdigest() and fields["warc-payload-digest"] == f"sha1:{digest}"
    assert fields["warc-type"] == "response" and fields["warc-date"] == "2001-02-03T04:05:06Z"
    assert warc.parse_warc(warc.to_warc(RECORDS[1], 1)[0])[0]["warc-type"] == "resource"
    fields, block = warc.parse_warc(warc.to_warc(RECORDS[0], 9, 12)[0])
    assert fields["warc-type"] == "revisit" and fields["warc-refers-to"] == warc.record_id(digest, 12)
    assert block == b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n"


def brute(rows):
    payload = lambda r: (r[2] or "").encode()
    last = {}
    for r in rows:
        if len(payload(r)) >= 1000 and r[0] is not None:
            last[payload(r)] = max(last.get(payload(r), r[0]), r[0])
    out = []
    for r in rows:
        to = last.get(payload(r))
        revisit = r[0] is not None and to is not None and r[0] < to
        out.append((r[0], len(payload(r)), hashlib.sha1(payload(r)).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x) for x in t))


def test_written_and_read_back(make_pages):
    big, edge = "ü" * 700, "x" * 1000
    nasty = "WARC/1.1\r\nX-Mark: 0\r\nContent-Length: 5\r\n\r\n\0\r\n\r\n" * 40
    rows = [(1, "http://a", big), (2, None, big), (3, "u v\r\nw", big), (3, "u", big), (4, "u", edge), (5, "u", edge), (6, "u", edge[:-1]), (7, "u", edge[:-1]), (8, "u", None), (9, "u", ""), (None, "u", big), (None, "u", "small"), (10, "u", nasty), (11, "u", nasty), (12, "ü", "z" * 300_000)]
    out = warc.archive(make_pages(rows))
    assert rows_of(out, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == brute(rows)
    assert warc.archive(make_pages([])).collect() == []


def test_joined_where_payloads_repeat_too_often_to_broadcast(make_pages, monkeypatch):
    monkeypatch.setattr(warc, "bounded_broadcast", lambda df: df)
    rows = [(i, "u", "q" * (1000 + i % 3)) for i in range(30)]
    assert rows_of(warc.archive(make_pages(rows)), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == brute(rows)
    assert pandas_of(warc.archive(make_pages(rows))).record_type.value_counts()["response"] == 3


def test_bytes_of_any_kind(spark):
    """Images and Latin-1 pages aren't UTF-8; each record is a gzip member of its own."""
    image = bytes(range(256)) * 8
    rows = [(1, "http://a/i.png", image), (2, "http://a/i2.png", image), (3, None, "été".encode("latin-1")), (4, "u", warc.EMPTY_MEMBER * 3), (5, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html binary")
    want = sorted((i, len(b or b""), hashlib.sha1(b or b"").hexdigest(), "revisit" if i == 1 else "response", 2 if i == 1 else None) for i, _, b in rows)
    assert sorted(tuple(r) for r in warc.archive(pages).collect()) == want


def test_archives_are_readable_by_any_gzip_reader(spark, make_pages, tmp_path):
    rows = [(i, f"http://a/{i}", f"<p>{i}</p>" * (i + 1)) for i in range(7)]
    warc.write_archives(make_pages(rows), str(tmp_path / "w"), "page_id", "url", "html")
    data = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / "w").glob("part-*")))
    assert data.count(b"WARC/1.1\r\n") == 7
    got = warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert sorted((r.uri, bytes(r.payload).decode()) for r in got) == sorted((u, h) for _, u, h in rows)
    assert {r.type for r in got} == {"response"} and all(r.fields["content-length"] == str(len(r.block)) for r in got)


@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_files_of_other_writers(spark, tmp_path, pack):
    one = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    two = b"WARC/1.0\r\nwarc-type:response\r\nWARC-Target-URI: http://x\r\nContent-Length: 23\r\n\r\nHTTP/1.0 200\r\n\r\n\xff\xfe\0\r\n\r\n\r\n\r\n"
    (tmp_path / "x.warc").write_bytes(pack(one) + pack(two))
    got = [(r.type, r.uri, bytes(r.payload)) for r in warc.read_warc(spark, str(tmp_path / "x.warc")).collect()]
    assert got == [("warcinfo", None, b"abc"), ("response", "http://x", b"\xff\xfe\0\r\n\r\n")]
    (tmp_path / "y.warc").write_bytes(pack(two[:-9]))
    with pytest.raises(Exception, match="torn"):
        warc.read_warc(spark, str(tmp_path / "y.warc")).collect()


@pytest.mark.parametrize("version,pack", [(1, bytes), (2, gzip.compress)])
def test_arc_files_convert(spark, tmp_path, version, pack):
    records = [*RECORDS, warc.ArcRecord("http://d.example/i", "192.0.2.9", "20010203040506", "image/png", bytes(range(256)))]
    (tmp_path / "a.arc").write_bytes(pack(warc.pack_arc(records, version)))
    warc.convert_arc(spark, str(tmp_path / "a.arc"), str(tmp_path / "out"))
    got = sorted((r.uri, r.type, r.date, bytes(r.payload), r.fields["warc-payload-digest"]) for r in warc.read_warc(spark, str(tmp_path / "out")).collect())
    assert got == sorted((r.url.replace(" ", "%20"), "response" if r.block.startswith(b"HTTP/") else "resource", warc.iso_date(r.date), r.payload, f"sha1:{hashlib.sha1(r.payload).hexdigest()}") for r in records)
