"""WARC archive against a dictionary of payloads, and byte by byte."""

from __future__ import annotations

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from salesmill.llm import warc_archive as wa
from salesmill.llm.queries import op13_warc_archive

from .conftest import SMALL

LAYOUT = "page_id bigint, url string, html string, key string, head string, payload int, nth int, sha1 int, size string"


def base32_sha1(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plain(rows, least=0):
    """Of equal payloads the first by page_id (null last), then url (null first)."""
    first, out = {}, []
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    for page_id, _, html in ordered:
        payload = (html or "").encode()
        kind, refers = "response", None
        if len(payload) >= least:
            if payload in first:
                kind, refers = "revisit", first[payload]
            first.setdefault(payload, page_id)
        out.append((page_id, len(payload), base32_sha1(payload), kind, refers))
    return sorted(out, key=repr)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


ODD = [
    (1, "http://a.example/", None), (2, None, ""), (3, "http://a.example/x\r\nWARC-Type: x", "<p>one</p>"),
    (4, "http://é.example/ü", "<p>é 🙂 ß</p>"), (5, "u", "<p>one</p>"), (5, "u", "<p>one</p>"), (5, "t", "<p>one</p>"),
    (None, None, None), (None, "n", "<p>only null ids</p>"), (None, "n", "<p>only null ids</p>"),
    (6, "u", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nb\r\n\r\n"), (7, "u", "\r\n\r\n"), (8, "u", "x" * 300_000),
    (9, "u", "x" * 300_000), (-4, "u", "<p>é 🙂 ß</p>"),
] + [(1000 + k, f"http://h/{k}", "<html>copied everywhere</html>") for k in range(150)]


@pytest.fixture
def odd_pages(spark):
    return spark.createDataFrame([(*r, *[None] * 6) for r in ODD], LAYOUT).repartition(4)


def test_query_against_plain(spark, small):
    got = op13_warc_archive(spark, SMALL)
    assert got.columns == list(COLUMNS)
    assert rows_of(got) == plain([(p["page_id"], p["url"], p["html"]) for p in small("pages")])


@pytest.mark.parametrize("least", [0, 5, 10**9])
def test_odd_pages(spark, odd_pages, tmp_path, least):
    wa.write_archive(odd_pages, str(tmp_path), least)
    assert rows_of(wa.read_archive(spark, str(tmp_path))) == plain(ODD, least)
    stored = spark.read.parquet(f"{tmp_path}/payloads")
    assert stored.count() == len({r[2] or "" for r in ODD})


def test_records_are_exact(spark, odd_pages, tmp_path):
    """Restored records say what they hold, and come back equal from WARC files."""
    wa.write_archive(odd_pages, f"{tmp_path}/archive")
    records = wa.read_archive(spark, f"{tmp_path}/archive")
    rows = records.collect()
    assert len({r.record_id for r in rows}) == len(ODD)
    by_id = {r.record_id: r for r in rows}
    for r in rows:
        header, rest = bytes(r.record).split(b"\r\n\r\n", 1)
        fields = dict(line.decode().split(": ", 1) for line in header.split(b"\r\n")[1:])
        block = rest[:int(fields["Content-Length"])]
        assert header.startswith(b"WARC/1.1\r\n") and rest[len(block):] == b"\r\n\r\n"
        http, body = block.split(b"\r\n\r\n", 1)
        assert f"Content-Length: {r.payload_bytes}".encode() in http
        assert fields["WARC-Payload-Digest"] == "sha1:" + base32_sha1(bytes(r.payload))
        assert body == (b"" if r.record_type == "revisit" else bytes(r.payload))
        assert ("WARC-Target-URI" in fields) == (r.url is not None)
        if r.record_type == "revisit":
            assert by_id[fields["WARC-Refers-To"]].payload == r.payload

    wa.write_warc(records, f"{tmp_path}/warc")
    back = {r.record_id: bytes(r.header) + b"\r\n\r\n" + bytes(r.block) + b"\r\n\r\n" for r in wa.read_warc(spark, f"{tmp_path}/warc").collect()}
    assert back == {r.record_id: bytes(r.record) for r in rows}


@pytest.mark.parametrize("change", ["changed", "missing"])
def test_damage_raises(spark, odd_pages, tmp_path, change):
    wa.write_archive(odd_pages, f"{tmp_path}/archive")
    stored = spark.read.parquet(f"{tmp_path}/archive/payloads").withColumn("hit", F.octet_length("payload") == 10)
    if change == "changed":
        stored = stored.withColumn("payload", F.when(F.col("hit"), F.lit("<p>0ne</p>").cast("binary")).otherwise(F.col("payload")))
    else:
        stored = stored.where("not hit")
    spark.read.parquet(f"{tmp_path}/archive/headers").write.parquet(f"{tmp_path}/damaged/headers")
    stored.select("key", "payload").write.parquet(f"{tmp_path}/damaged/payloads")
    with pytest.raises(Exception, match="damaged record"):
        wa.read_archive(spark, f"{tmp_path}/damaged").select("record_type").collect()


def test_cut_files_are_refused():
    with pytest.raises(ValueError, match="cut off"):
        list(wa._parsed(b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc"))
    with pytest.raises(ValueError, match="no WARC record"):
        list(wa._parsed(b"HTTP/1.1 200 OK\r\n\r\n"))


def test_no_pages(spark):
    assert wa.archive_digest(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
