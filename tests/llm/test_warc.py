"""WARC archive: exact records, content addressing and revisits."""

import base64
import hashlib

import pytest

from clicklens.llm import warc_cas as W

SCHEMA = "page_id long, url string, html string, size int, key string"


def sha1(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def test_records(spark):
    rows = [(1, "http://a\r\nWARC-Type: x", "é"), (2, None, "é"), (None, "u", "é"), (3, "u", None), (None, "v", ""),
            (None, "v", "q"), (3, "u", None), (9, "big", "z" * 200_000)]
    pages = spark.createDataFrame([(*r, 0, "k") for r in rows], SCHEMA)
    archive = W.write_archive(pages)
    assert archive.payloads.count() == 4
    got = {}
    for r in W.read_archive(archive).collect():
        body, record, header = bytes(r.payload), bytes(r.record), bytes(r.header)
        assert r.payload_digest == sha1(body)
        head, rest = record.split(b"\r\n\r\n", 1)
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        block = rest[:int(fields["Content-Length"])]
        assert record == header + (body if r.record_type == "response" else b"") + b"\r\n\r\n"
        assert block == W.HTTP_HEAD.encode() + (body if r.record_type == "response" else b"")
        assert rest[len(block):] == b"\r\n\r\n" and fields["WARC-Type"] == r.record_type
        got.setdefault((r.page_id, body), []).append((r.record_type, r.refers_to, fields.get("WARC-Target-URI")))
    e = "é".encode()
    assert got == {
        (1, e): [("revisit", 2, "http://a%0D%0AWARC-Type: x")], (2, e): [("response", None, None)], (None, e): [("revisit", 2, "u")],
        (3, b""): [("response", None, "u")] * 2, (None, b""): [("revisit", 3, "v")], (None, b"q"): [("response", None, "v")],
        (9, b"z" * 200_000): [("response", None, "big")]}
    assert W.query(pages.where("false")).count() == 0


def test_small_payloads_stay_responses(spark):
    pages = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "xyz"), (4, "d", "xyz")], "page_id long, url string, html string")
    rows = W.read_archive(W.write_archive(pages, min_bytes=3)).collect()
    assert sorted((r.page_id, r.record_type) for r in rows) == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response")]


def test_damage_is_noticed(spark):
    pages = spark.createDataFrame([(1, "a", "xy")], "page_id long, url string, html string")
    archive = W.write_archive(pages)
    bad = W.Archive(archive.headers, archive.payloads.selectExpr("key", "cast('xz' AS binary) AS payload"))
    with pytest.raises(Exception, match="damaged payload"):
        W.read_archive(bad).collect()
