"""Content-addressed WARC archive.

An archive is two tables in a shared folder:

* ``payloads`` (digest, payload): every payload's bytes once, under the SHA-256 of
  those bytes;
* ``headers`` (record_no, ..., header, digest): the exact header block of every
  record, apart from its payload.

``write_archive`` looks payloads up by digest without moving their bytes: digests
are computed where the payload is read, one record per digest is elected on
(digest, id) rows, and only rows of elected records are written, with their
bytes.  ``read_archive`` joins both tables back into whole records: header block,
blank line, payload, blank lines.  Both sides verify: a payload whose bytes do not
give the digest it is stored under raises an error, and so does a header whose
Content-Length or digest disagrees with its payload.

Records with equal payloads of at least ``MIN_REVISIT`` bytes: the one with the
largest id is a response, the others are revisits that refer to it.  Smaller ones
are responses, yet their bytes are stored once, too.

Nulls: a null payload is empty, a null url is the empty URI; a null id is written
as an empty record id and ordered first.  Line breaks inside a url are written as
%0D and %0A and read back as they were.  Repeated rows (equal id and payload) are
one record each; with ``MIN_REVISIT`` bytes or more one of them is the response.
An empty table gives an archive without records.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.columns import row_bounded
from tabloom.session import Stages, scratch_path

MIN_REVISIT = 1000
#: Lists of (id, digest) are broadcast up to this count (about 100 bytes each).
BROADCAST_ROWS = 100_000
CRLF = "\r\n"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The same date in every record: archives of equal tables are equal.
DATE = "2024-01-01T00:00:00Z"


def _verified(digest: Column, payload: Column) -> Column:
    """The payload, or an error when its bytes do not give the digest."""
    return F.when(F.sha2(payload, 256) == digest, payload).otherwise(
        F.raise_error(F.concat(F.lit("payload does not give its digest "), digest)).cast("binary"))


def _record_id(i: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(i.cast("string"), F.lit("")), F.lit(">"))


def _escaped(url: Column) -> Column:
    """A url on one line: CR and LF become %0D and %0A, and the percent sign of a
    text that reads like one of the three escapes becomes %25."""
    url = F.regexp_replace(url, "%(?=25|0D|0A)", "%25")
    return F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A")


def _unescaped(text: str) -> str:
    signs = {"%25": "%", "%0D": "\r", "%0A": "\n"}
    return re.sub("%25(?=25|0D|0A)|%0D|%0A", lambda m: signs[m[0]], text)


def header_block() -> Column:
    """The header lines of a record, from the columns of ``write_archive``."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    revisit = F.col("record_type") == "revisit"
    return F.concat(
        F.lit(VERSION + CRLF), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _record_id(F.col("page_id"))), line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", _escaped(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)),
                                 line("WARC-Refers-To", _record_id(F.col("refers_to"))))
               ).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.col("size").cast("string")))


def _payload(pages: DataFrame, id_col: str, payload_col: str, *more: Column) -> DataFrame:
    """(page_id, payload, digest, ...) of every row."""
    return pages.select(F.col(id_col).alias("page_id"), *more,
                        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload")
                        ).withColumn("digest", F.sha2("payload", 256))


def _pick(rows: DataFrame, pairs: DataFrame, how: str) -> DataFrame:
    """``rows`` with (left_semi) or without (left_anti) those of the listed
    (page_id, digest); a list of checked size is broadcast."""
    side = pairs.select(F.col("page_id").alias("p_id"), F.col("digest").alias("p_digest"))
    side = F.broadcast(side) if row_bounded(side, BROADCAST_ROWS) else side
    return rows.join(side, F.col("page_id").eqNullSafe(F.col("p_id"))
                     & (F.col("digest") == F.col("p_digest")), how)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_revisit: int = MIN_REVISIT) -> None:
    """Write one record per row of ``pages`` under ``path``."""
    stages = Stages(pages.sparkSession)
    index = stages.write(
        _payload(pages, id_col, payload_col, F.coalesce(F.col(url_col), F.lit("")).alias("url")).select(
            F.monotonically_increasing_id().alias("record_no"), "page_id", "url", "digest",
            F.length("payload").cast("long").alias("size"), F.sha1("payload").alias("sha1")), "records")
    # one elected record per digest: the largest id, then the largest number
    elected = stages.write(index.groupBy("digest").agg(
        F.max(F.struct("page_id", "record_no")).alias("e")).select(
        F.col("digest").alias("e_digest"), F.col("e.record_no").alias("e_no"),
        F.col("e.page_id").alias("e_id")), "elected")
    first = F.col("record_no") == F.col("e_no")
    revisit = ~first & (F.col("size") >= min_revisit)
    kinds = index.join(elected, F.col("digest") == F.col("e_digest")).withColumn(
        "record_type", F.when(revisit, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(revisit, F.col("e_id")))
    kinds.select("record_no", "page_id", "digest", first.alias("first"),
                 header_block().alias("header")).write.parquet(f"{path}/headers")
    stages.drop(index, elected)

    # bytes are written where they are read, but for rows whose digest another
    # row brings; equal rows that bring the same bytes go through one group
    headers = pages.sparkSession.read.parquet(f"{path}/headers")
    per_row = headers.groupBy("page_id", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.max("first").alias("first"))
    several = stages.write(per_row.where("not first or n > 1"), "several")
    raw = _payload(pages, id_col, payload_col)
    bytes_once = _pick(raw, several, "left_anti").select("digest", "payload")
    equal = several.where("first")
    if not row_bounded(equal, 0):
        bytes_once = bytes_once.union(_pick(raw, equal, "left_semi").groupBy("digest").agg(
            F.first("payload").alias("payload")))
    bytes_once.write.option("compression", "zstd").parquet(f"{path}/payloads")
    stages.drop(several)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(record_no, record): every record's bytes, rebuilt from both tables."""
    headers = spark.read.parquet(f"{path}/headers").select("record_no", "digest", "header")
    payloads = spark.read.parquet(f"{path}/payloads").select(
        F.col("digest").alias("p_digest"), "payload")
    both = headers.join(payloads, F.col("digest") == F.col("p_digest"), "left")
    held = F.coalesce(F.col("payload"), F.raise_error(F.concat(
        F.lit("no payload under "), F.col("digest"))).cast("binary"))
    return both.select("record_no", F.concat(
        F.encode("header", "UTF-8"), F.lit(CRLF.encode()), _verified(F.col("digest"), held),
        F.lit(2 * CRLF.encode())).alias("record"))


def parse_record(record: bytes) -> tuple:
    """(page_id, url, payload, sha1, record_type, refers_to) of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split(CRLF)
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    payload = rest[:size]
    sha1 = hashlib.sha1(payload).hexdigest()
    if lines[0] != VERSION or rest[size:] != 2 * CRLF.encode() or len(payload) != size:
        raise ValueError(f"no whole record: {lines[:3]}")
    if fields["WARC-Payload-Digest"] != f"sha1:{sha1}":
        raise ValueError(f"payload digest differs: {lines[:3]}")
    number = lambda name: int(x) if (x := fields.get(name, "")[len("<urn:page:"):-1]) else None
    return (number("WARC-Record-ID"), _unescaped(fields["WARC-Target-URI"]), payload, sha1, fields["WARC-Type"],
            number("WARC-Refers-To"))


def parse_records(records: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of ``read_archive`` as rows: page_id, url, payload_bytes,
    payload_digest, record_type, refers_to[, payload]."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [parse_record(r) for r in pdf["record"]]
            yield pd.DataFrame(
                [(i, url, len(body), sha1, kind, ref, *([body] if with_payload else []))
                 for i, url, body, sha1, kind, ref in rows],
                columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + [
        "payload"] * with_payload
    return records.select("record").mapInPandas(
        parse, "page_id long, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long" + ", payload binary" * with_payload)


def archive_round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Write an archive of ``pages`` into the shared folder and read it back."""
    path = scratch_path(pages.sparkSession, "archive")
    write_archive(pages, path, **columns)
    return parse_records(read_archive(pages.sparkSession, path))
