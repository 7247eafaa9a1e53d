import hashlib
import io

import pytest

from tidemark.llm import archives


def brute(rows):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            first[data] = min(first.get(data, page), page)
    out, seen = [], set()
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        again = len(data) >= 100 and data in seen
        seen.add(data)
        out.append((page, len(data), digest, "revisit" if again else "response", first.get(data) if again else None))
    return sorted(out, key=repr)


def test_matches_brute_force(spark):
    long = "<p>ünï</p>" * 20
    rows = [(k, f"http://h/{k}", "x" * k) for k in range(90, 110)] + [
        (5, "http://a b/ü", long), (3, None, long), (9, "", long), (9, "", long), (4, "u", None), (2, "u", ""), (1, "u", ""), (None, "n", long), (None, "n", "only here" * 20),
        (200, "e", "HTTP/1.1 200 OK\r\nX-Page-Id: 7\r\n\r\n" * 9), (201, "e", "WARC/1.1\r\n\r\n\n\n"), (202, "e", "a" * 1_000_000), (203, "e", "filedesc://x 1 2 3 4\n")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int").repartition(3)
    got = sorted((tuple(r) for r in archives.archived_pages(pages).collect()), key=repr)
    assert got == brute(rows)


def test_empty_table(spark):
    assert archives.archived_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_versions_are_read_by_their_declared_fields(version):
    data = archives.arc_head(version, "old.arc", "19970101000000")
    second = archives.arc_record(version, "http://x/a b c", "1.2.3.4", "199612312359", "text/html", b"HTTP/1.0 200 OK\nServer: s\n\nbody\nmore", len(data), "old.arc")
    third = archives.arc_record(version, "dns:x", "1.2.3.4", "1996", "text/dns", b"19961231 x IN A 1.2.3.4")
    records = list(archives.read_arc(io.BytesIO(data + second + third)))
    assert [r.offset for r in records] == [0, len(data), len(data) + len(second)]
    assert records[1].url == "http://x/a b c" and records[1].body.endswith(b"body\nmore")
    warc = [archives.to_warc(r, "old.arc") for r in records]
    assert [w.headers["WARC-Type"] for w in warc] == ["warcinfo", "response", "resource"]
    assert [w.headers["WARC-Date"] for w in warc] == ["1997-01-01T00:00:00Z", "1996-12-31T23:59:00Z", "1996-01-01T00:00:00Z"]
    assert warc[1].headers["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(b"body\nmore").hexdigest()
    assert warc[2].headers["Content-Type"] == "text/dns"
    assert len({w.headers["WARC-Record-ID"] for w in warc}) == 3
    again = list(archives.read_warc_stream(io.BytesIO(b"".join(map(archives.warc_bytes, warc)))))
    assert [(w.headers, w.block) for w in again] == [(w.headers, w.block) for w in warc]


def test_undeclared_fields_come_from_the_version():
    head = archives.arc_record(1, "filedesc://x", "0.0.0.0", "19970101000000", "text/plain", b"1 0 Old\n")
    page = archives.arc_record(1, "http://x/", "1.2.3.4", "19970101000000", "text/html", b"HTTP/1.0 200 OK\r\n\r\nx")
    assert [r.url for r in archives.read_arc(io.BytesIO(head + page))] == ["filedesc://x", "http://x/"]


@pytest.mark.parametrize("data", [b"not an archive\n", archives.arc_head(1, "x", "1997")[:-9], archives.arc_record(1, "filedesc://x", "0", "1", "t", b"9 0 X\nURL\n")])
def test_damaged_archives_are_named(data):
    with pytest.raises(ValueError, match="ARC"):
        list(archives.read_arc(io.BytesIO(data)))


def test_urls_that_look_like_version_blocks_are_pages(spark):
    big = "<html>" + "x" * 200
    rows = [(1, "filedesc://a.arc", big), (2, "filedesc:b", "small"), (3, "http://c", big), (3, "http://c", big), (None, "filedesc:", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = sorted(((r.page_id, r.record_type, r.refers_to) for r in archives.archived_pages(pages).collect()), key=repr)
    assert found == [(1, "response", None), (2, "response", None), (3, "revisit", 1), (3, "revisit", 1), (None, "revisit", 1)]
