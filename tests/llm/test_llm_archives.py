"""ZIP directories against the standard library, records by an exact round trip."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import os
import zipfile
from itertools import chain

import pytest

from llm_help import SF, duck_rows, spark_rows
from ridelens.llm import archives as A


def record(i, payload):
    return A.Record(i, f"http://x/{i}%\r\n", "response", None, hashlib.sha1(payload).hexdigest(), len(payload), payload)


def test_records_split_over_archives_come_back(monkeypatch):
    monkeypatch.setattr(A, "ARCHIVE_BYTES", 2000)
    records = [record(i, f"<p>{i}\r\n\r\n".encode() * (i % 9)) for i in range(80)]
    records[7] = A.Record(7, None, "revisit", 9, records[9].digest, records[9].size, b"")
    left, back, n_archives = iter(records), [], 0
    while (first := next(left, None)) is not None:
        out = io.BytesIO()
        A.write_zip(out, chain([first], left), wide=n_archives % 2 == 0)
        data = out.getvalue()
        assert zipfile.ZipFile(io.BytesIO(data)).testzip() is None
        back += [A.unpack_record(data[a : a + n]) for a, n in A.read_index(io.BytesIO(data), len(data))]
        n_archives += 1
    assert back == records and n_archives > 3


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 looks like an end record " * 3])
def test_directory_matches_the_standard_library(wide, comment):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for i in range(5):
            with z.open(f"dir/é{i}", "w", force_zip64=wide) as f:
                f.write(bytes([i]) * 1000 * i)
        z.writestr("packed", b"x" * 500, zipfile.ZIP_DEFLATED)
    plain = out.getvalue()
    data = plain[:-2] + len(comment).to_bytes(2, "little") + comment
    members = A.zip_members(io.BytesIO(data), len(data))
    infos = zipfile.ZipFile(io.BytesIO(plain)).infolist()  # it takes the comment's signature for the end record
    assert [(m.name, m.size, m.header, m.stored) for m in members] == [(x.filename, x.compress_size, x.header_offset, x.compress_type == 0) for x in infos]
    for m in members[:5]:
        at = A.data_start(io.BytesIO(data), m)
        assert data[at : at + m.size] == zipfile.ZipFile(io.BytesIO(plain)).read(m.name)


def test_zip64_end_record_is_followed(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 3)  # as for archives of over 65535 members
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for i in range(9):
            z.writestr(f"m{i}", str(i))
    data = out.getvalue()
    assert A.END64 in data
    assert [m.name for m in A.zip_members(io.BytesIO(data), len(data))] == [f"m{i}" for i in range(9)]


def test_wide_fields_of_entries_beyond_four_gigabytes():
    big = (1 << 33) + 5
    extra = b"\x99\x99\x02\x00ab" + b"\x01\x00\x18\x00" + b"".join(x.to_bytes(8, "little") for x in (big, big + 1, big + 2))
    assert A._wide(extra, 0xFFFFFFFF, 0xFFFFFFFF, 0xFFFFFFFF) == (big + 1, big + 2)
    assert A._wide(b"\x01\x00\x08\x00" + big.to_bytes(8, "little"), 7, 8, 0xFFFFFFFF) == (8, big)


def test_broken_archives_are_errors():
    for data in (b"", b"PK not a zip", b"x" * 100):
        with pytest.raises(ValueError):
            A.zip_members(io.BytesIO(data), len(data))
    bad = A.pack_record(A.Record(1, None, "response", None, hashlib.sha1(b"a").hexdigest(), 1, b"b"))
    with pytest.raises(ValueError):
        A.unpack_record(bad)


def test_whole_table_matches_sql(spark):
    assert spark_rows(A.op9_warc(spark, SF)) == duck_rows(A.OP9_SQL)


def test_payloads_round_trip(spark, tmp_dir):
    big, other = "é" * 600, "x" * 1000
    rows = [(1, "u1", big), (5, "u5", big), (3, None, big), (2, "u2", "small"), (4, "u4", "small"), (6, "u6", None), (None, "u", other), (8, "a\nb", other), (8, "a\nb", other), (7, "u7", other)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' as digest", "1 as size", "2 as owner")
    got = [(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload).decode()) for r in A.archive_round_trip(df, f"{tmp_dir}/warc", with_payload=True).collect()]
    kind = {1: ("revisit", 5), 3: ("revisit", 5), 7: ("revisit", 8)}
    want = []
    for page, url, html in rows:
        body = html or ""
        record_type, refers = kind.get(page, ("response", None))
        stored = (body or b"") if record_type == "response" else None
        want.append((page, url, len(body.encode()), hashlib.sha1(body.encode()).hexdigest(), record_type, refers, stored))
    assert sorted(((*g[:6], g[6] or None) for g in got), key=str) == sorted(((*w[:6], w[6] or None) for w in want), key=str)
    assert A.archive_round_trip(df.limit(0), f"{tmp_dir}/none").count() == 0


def raw(kind, record_id, block, *more, eol="\r\n", length=True):
    """A record as other writers make them."""
    head = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{record_id}>", "WARC-Date: 2021-02-03T04:05:06Z", *more]
    head += [f"Content-Length: {len(block)}"] if length else []
    return eol.join(head).encode() + eol.encode() * 2 + block + eol.encode() * 2


PAGE = b"<html>" + b"body " * 300
CHUNKED = b"".join(b"%x;x=y\r\n%b\r\n" % (len(PAGE[i : i + 100]), PAGE[i : i + 100]) for i in range(0, len(PAGE), 100)) + b"0\r\n\r\n"
SHA1 = hashlib.sha1(PAGE)
FOREIGN = [
    raw("warcinfo", "a0", b"software: some crawler\r\nformat: WARC File Format 1.0\r\n", "Content-Type: application/warc-fields", "WARC-Filename: x.warc.gz"),
    raw("request", "a1", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n", "WARC-Target-URI: http://x/", "Content-Type: application/http;msgtype=request"),
    raw("response", "a2", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + CHUNKED, "WARC-Target-URI: http://x/", "WARC-Payload-Digest: sha1:" + base64.b32encode(SHA1.digest()).decode()),
    raw("response", "a3", b"HTTP/1.0 404 Not Found\nX-Folded: a\n  b\n\n" + PAGE, "WARC-Target-URI: http://x/2", "WARC-Payload-Digest: SHA-1:" + SHA1.hexdigest(), eol="\n"),
    raw("response", "a4", b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\nabcd", "WARC-Target-URI: http://x/3", "WARC-Payload-Digest: sha256:" + hashlib.sha256(b"other").hexdigest()),
    raw("response", "a5", b"HTTP/1.1\r\nTransfer-Encoding: chunked\r\n\r\nnot chunked", "WARC-Target-URI: http://x/4", length=False),
    raw("metadata", "a6", b"outlink: http://y/", "WARC-Concurrent-To: <urn:uuid:a2>", "Content-Type: application/warc-fields"),
    raw("revisit", "a7", b"HTTP/1.1 304 Not Modified\r\n\r\n", "WARC-Target-URI: http://x/", "WARC-Refers-To: <urn:uuid:a2>", "WARC-Payload-Digest: sha1:" + base64.b32encode(SHA1.digest()).decode()),
    raw("resource", "a8", b"\x89PNG", "WARC-Target-URI: urn:pic", "Content-Type: image/png", "WARC-Payload-Digest: crc:12"),
]
WANT = {
    "a0": ("warcinfo", None, None, 54, None), "a1": ("request", "http://x/", None, 27, None), "a2": ("response", "http://x/", 200, len(PAGE), True),
    "a3": ("response", "http://x/2", 404, len(PAGE), True), "a4": ("response", "http://x/3", 200, 4, False), "a5": ("response", "http://x/4", None, 11, None),
    "a6": ("metadata", None, None, 18, None), "a7": ("revisit", "http://x/", 304, None, None), "a8": ("resource", "urn:pic", None, 4, None),
}


def foreign_zip(path, index, packed=True):
    """An archive with two WARC members and the given kind of index."""
    members, entries = [], []
    for k, records in enumerate((FOREIGN[:5], FOREIGN[5:])):
        data, name = b"", f"crawl-{k}.warc" + (".gz" if packed else "")
        for r in records:
            part = gzip.compress(r) if packed else r
            entries.append((name, len(data), len(part)))
            data += part
        members.append((f"archive/{name}", data))
    lines = [f'com,x)/{i} 20210203040506 {json.dumps({"url": "http://x/", "filename": n, "offset": str(o), "length": str(size)})}\n' for i, (n, o, size) in enumerate(entries)]
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("datapackage.json", "{}", zipfile.ZIP_DEFLATED)
        z.writestr("pages/pages.jsonl", "{}")
        for name, data in members:
            z.writestr(name, data)
        if index == "cdxj":
            z.writestr("indexes/index.cdxj", "!meta 0 {}\n" + "".join(lines))
        elif index == "blocks":
            blocks = [gzip.compress("".join(lines[i : i + 2]).encode()) for i in range(0, len(lines), 2)]
            z.writestr("indexes/index.cdx.gz", b"".join(blocks))
            z.writestr("indexes/index.idx", "!meta 0 {}\n")
        elif index == "half":
            z.writestr("indexes/index.cdx", "".join(lines[:5]))


@pytest.mark.parametrize("index, packed", [("cdxj", True), ("blocks", True), ("half", True), ("none", True), ("cdxj", False), ("none", False)])
def test_archives_of_others_are_read(spark, tmp_dir, index, packed):
    if not packed:
        records = [r for r in FOREIGN if b"<urn:uuid:a5>" not in r]  # a plain record must tell its length
    path = f"{tmp_dir}/x.wacz"
    with pytest.MonkeyPatch.context() as m:
        if not packed:
            m.setitem(globals(), "FOREIGN", records)
        foreign_zip(path, index, packed)
    df = spark.createDataFrame([(f"file://{path}", os.path.getsize(path))], "uri string, n_bytes bigint")
    rows = A.read_web_records(df, with_payload=True).collect()
    got = {r.record_id[10:-1]: (r.record_type, r.target_uri, r.status, r.payload_bytes, r.digest_ok) for r in rows}
    assert got == {k: v for k, v in WANT.items() if packed or k != "a5"} and len(rows) == len(got)
    by = {r.record_id[10:-1]: r for r in rows}
    assert bytes(by["a2"].payload) == bytes(by["a3"].payload) == PAGE and by["a2"].payload_digest == SHA1.hexdigest() == by["a7"].payload_digest
    assert by["a7"].refers_to == "<urn:uuid:a2>" and by["a7"].payload is None and by["a8"].content_type == "image/png"
    assert {r.date for r in rows} == {"2021-02-03T04:05:06Z"}
    assert "payload" not in A.read_web_records(df.limit(0)).columns and A.read_web_records(df.limit(0)).count() == 0


def test_our_own_archives_are_web_records_too(spark, tmp_dir):
    df = spark.createDataFrame([(1, "u", "a" * 1200), (2, "v", "a" * 1200), (3, None, None)], "page_id bigint, url string, html string")
    got = {r.record_id: (r.record_type, r.target_uri, r.payload_bytes, r.refers_to) for r in A.read_web_records(A.write_archives(df, f"file://{tmp_dir}/own")).collect()}
    assert got == {"<urn:page:1>": ("revisit", "u", 1200, "<urn:page:2>"), "<urn:page:2>": ("response", "v", 1200, None), "<urn:page:3>": ("response", None, 0, None)}


def test_an_index_in_many_ranges_and_a_missing_member(monkeypatch):
    monkeypatch.setattr(A, "_ranges", lambda f, at, n, step=7, g=A._ranges: g(f, at, n, 7))
    for index, packed in (("blocks", True), ("none", True), ("cdxj", True)):
        out = io.BytesIO()
        foreign_zip(out, index, packed)
        data = out.getvalue()
        places = sorted(A.read_index(io.BytesIO(data), len(data)))
        assert [A.parse_record(data[a : a + n]).fields["warc-record-id"] for a, n in places] == [f"<urn:uuid:a{i}>" for i in range(9)]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("indexes/index.cdx", 'x 1 {"filename": "gone.warc.gz", "offset": 0, "length": 9}')
    with pytest.raises(ValueError, match="does not have"):
        list(A.read_index(io.BytesIO(out.getvalue()), len(out.getvalue())))


def test_a_very_long_page_comes_back(spark, tmp_dir):
    html = "".join(f"<p>{i}</p>" for i in range(500_000))
    (row,) = A.archive_round_trip(spark.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string"), f"{tmp_dir}/long").collect()
    assert (row.payload_bytes, row.payload_digest) == (len(html), hashlib.sha1(html.encode()).hexdigest())
