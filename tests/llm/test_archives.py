"""ARC parsing, conversion to WARC and the way back."""
from __future__ import annotations

import base64
import gzip
import hashlib
import random

import pytest

from martkit.llm import archives

V1_ABOUT = b"1 0 Archive\nURL IP-address Archive-date Content-type Archive-length\n\n"
V1 = b"filedesc://a.arc 0.0.0.0 20010203040506 text/plain %d\n" % len(V1_ABOUT) + V1_ABOUT + b"\n\n"
V2_ABOUT = b"2 0 Archive\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n\n"


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _v1(url: bytes, content: bytes) -> bytes:
    return url + b" 1.2.3.4 20010203040506 text/html %d\n" % len(content) + content + b"\n"


def test_version_specific_lines():
    page = b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\n<p>\n\nfiledesc://trap 1 2 3 4\n</p>"
    one = list(archives.arc_records(V1 + _v1(b"http://a/", page) + b"\n" + _v1(b"http://b/with blank", b"")))
    assert [(f["URL"], f["Archive-date"], c) for _, f, c in one] == [("http://a/", "20010203040506", page), ("http://b/with blank", "20010203040506", b"")]
    about = b"filedesc://b.arc 0.0.0.0 20010203040506 text/plain 200 - - 0 b.arc %d\n" % len(V2_ABOUT) + V2_ABOUT
    two = about + b"\nhttp://c/ 1.2.3.4 20020101000000 text/html 404 - - 9 b.arc 5\nhello\n"
    (_, fields, content), = archives.arc_records(two)
    assert (fields["Result-code"], fields["Offset"], content) == ("404", "9", b"hello")
    assert [c for _, _, c in archives.arc_records(V1 + b"no header line\n" + _v1(b"http://a/", b"x") + b"http://cut/ 1.2.3.4 20010203040506 text/html 99\nshort")] == [b"x", b"short"]
    assert list(archives.arc_records(b"")) == []


def test_foreign_archives_convert(spark, tmp_path):
    (tmp_path / "arc").mkdir()
    page = b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\n\xff\xfe bytes"
    data = V1 + _v1(b"http://a/", page) + _v1(b"http://b/", page) + _v1(b"dns:a", b"20010203 a 1.2.3.4")
    members = b"".join(gzip.compress(p) for p in (V1, data[len(V1):]))
    (tmp_path / "arc" / "x.arc.gz").write_bytes(members)
    archives.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    rows = {r.uri: r for r in archives.read_warc(spark, str(tmp_path / "warc")).collect()}
    assert sorted(r.record_type for r in rows.values()) == ["resource", "response", "revisit"]
    assert rows["dns:a"].record_type == "resource" and all(r.intact for r in rows.values())
    assert rows["http://a/"].payload_digest == _digest(b"\xff\xfe bytes")
    first, = (r for r in rows.values() if r.record_type == "response")
    again, = (r for r in rows.values() if r.record_type == "revisit")
    assert again.refers_to_id == first.record_id


def _plain(rows, least):
    out = []
    first = {}
    for p, _, h in rows:
        h = h or ""
        if p is not None and p < first.get(h, p + 1):
            first[h] = p
    seen = set()
    for p, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        body = (h or "").encode()
        again = len(body) >= least and h in seen or (h or "") in seen and len(body) >= least
        out.append((p, len(body), _digest(body), "revisit" if again else "response", first.get(h or "") if again else None))
        seen.add(h or "")
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_pages_round_trip(spark, least):
    rng = random.Random(4)
    bodies = ["", None, "<p>é\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\n</p>", "http://x 1.2.3.4 20010203040506 text/html 3\nabc", "a", "x" * 300_000]
    bodies += [f"<p>{i}</p>" for i in range(30)]
    rows = [(i, rng.choice([None, "http://a/ b", "http://é/?x", "http://c/"]), rng.choice(bodies)) for i in range(150)] + [(None, None, "<p>1</p>"), (7, "u", None)]
    rng.shuffle(rows)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = archives.archived_pages(pages.selectExpr("*", "'x' as record_id", "1 as digest"), least).collect()
    assert all(r.intact for r in got)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == _plain(rows, least)


def test_empty_table(spark):
    assert archives.archived_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
