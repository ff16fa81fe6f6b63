"""The content-addressed archive: round trips, single storage, verification."""
import hashlib

import pytest

from tabloom.llm.archive import parse_record, parse_records, read_archive, write_archive
from tabloom.session import scratch_path

BIG, EDGE, SMALL = "x" * 5000, "é" * 500, "y" * 999
ROWS = [(1, "http://a", BIG), (2, None, BIG), (9, "http://b", BIG), (9, "http://b", BIG), (3, "u", SMALL),
        (4, "u", SMALL), (5, "u", EDGE), (6, "u\r\nWARC-Type: x", EDGE), (7, "u", None), (8, "u", ""),
        (None, "n", "alone" * 300), (10, "u", "\r\n\r\n" * 400)]


def expected(rows):
    body = [(i, (h or "").encode()) for i, _, h in rows]
    out, given = [], set()
    for i, h in body:
        same = [j for j, g in body if g == h and j is not None]
        top = max(same, default=None)
        first = len(h) < 1000 or i == top and (i, h) not in given
        given.add((i, h))
        out.append((i, len(h), hashlib.sha1(h).hexdigest(), "response" if first else "revisit",
                    None if first else top))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [100_000, 0])
def test_records_come_back_and_payloads_are_stored_once(spark, monkeypatch, limit):
    import tabloom.llm.archive as module

    monkeypatch.setattr(module, "BROADCAST_ROWS", limit)
    path = scratch_path(spark, "archive-test")
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, digest string")
    write_archive(pages, path)
    stored = spark.read.parquet(f"{path}/payloads").collect()
    assert sorted(hashlib.sha256(bytes(r.payload)).hexdigest() for r in stored) == sorted(
        {hashlib.sha256((h or "").encode()).hexdigest() for *_, h in ROWS})
    assert all(r.digest == hashlib.sha256(bytes(r.payload)).hexdigest() for r in stored)
    got = parse_records(read_archive(spark, path), with_payload=True).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got),
                  key=repr) == expected(ROWS)
    assert sorted(r.url for r in got) == sorted(u or "" for _, u, _ in ROWS)
    assert sorted(bytes(r.payload) for r in got) == sorted((h or "").encode() for *_, h in ROWS)


def test_a_record_is_a_whole_warc_record(spark):
    path = scratch_path(spark, "archive-test")
    write_archive(spark.createDataFrame([(1, "http://a", "héllo")], "page_id long, url string, html string"), path)
    record = bytes(read_archive(spark, path).first().record)
    head, body = record.split(b"\r\n\r\n", 1)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>")
    assert b"Content-Length: 6" in head and body == "héllo".encode() + b"\r\n\r\n"
    with pytest.raises(ValueError):
        parse_record(record.replace(b"llo\r\n", b"llx\r\n"))


def test_a_changed_payload_is_an_error(spark):
    path = scratch_path(spark, "archive-test")
    write_archive(spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"), path)
    bad = spark.read.parquet(f"{path}/payloads").selectExpr("digest", "cast('abd' as binary) as payload").collect()
    spark.createDataFrame(bad, "digest string, payload binary").write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="does not give its digest"):
        read_archive(spark, path).collect()


def test_no_pages(spark):
    path = scratch_path(spark, "archive-test")
    write_archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert parse_records(read_archive(spark, path)).count() == 0


def test_urls_come_back_exactly(spark):
    urls = ["a\r\nb", "\n", "%0A", "%0D%0A\r", "%250A", "%25", "%%0D", "%2\r", "%25\n25", "a%20b", "100%", "", "x: y", " z "]
    path = scratch_path(spark, "archive-test")
    write_archive(spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)],
                                        "page_id long, url string, html string"), path)
    records = read_archive(spark, path)
    assert {r.page_id: r.url for r in parse_records(records).collect()} == dict(enumerate(urls))
    heads = [bytes(r.record).split(b"\r\n\r\n")[0].split(b"\r\n") for r in records.collect()]
    assert {len(h) for h in heads} == {8} and any(b"WARC-Target-URI: a%20b" in h for h in heads)
