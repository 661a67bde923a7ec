"""Operator 4: WARC archives with revisits, and a reader that salvages damaged ones.

Writing: one record per page, through Spark's text writer with CR LF CR LF (a record's end) as the
line separator, so archives are committed like any table and survive lost executors.  Of the
records with equal payloads of at least ``least`` bytes the one with the smallest page_id is a
response, the others are revisits that refer to it and carry no payload.

Reading: each record is checked (version line, headers, length, record end, block digest, payload
digest).  After a failed check the reader searches for the next position that starts a whole valid
record (a ``WARC/`` version line; in compressed archives the next gzip member that inflates to
one), goes on there, and logs the bytes between as a quarantined gap.  The search reads each header
line once however many version lines precede it, and members are inflated in pieces, so its time grows
with the archive; only blocks that overlap and end in a record end are digested more than once.

Defined results: a null html is the empty payload; null urls are ``urn:none`` and line ends in urls
are percent-encoded; a page with a null id takes part: it revisits an equal page that has an id,
and is a response where none has; rows that repeat a page_id with an equal payload get the same
result each; an empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.session import materialized, scratch_path

from .bloom import BloomFilter
from .common import table

LEAST = 0
END = "\r\n\r\n"
VERSION = b"WARC/1."
# bytes of a compressed archive that are inflated at a time
PIECE = 1 << 16


def base32_sha1(data: F.Column) -> F.Column:
    """Bare upper-case base32 of the SHA-1: five hex digits at a time become four characters."""
    digits = F.sha1(data)
    return F.concat(*[
        F.translate(F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0"), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
        for i in range(8)])


def records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
                        base32_sha1(payload.cast("binary")).alias("payload_digest"))
    # payloads that are there more than once, and their smallest page
    first = (rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
             .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1"))
    first = materialized(first, "repeated-payloads")
    # pages whose payload is surely there once are written where they were read
    shared = spark.sparkContext.broadcast(BloomFilter.of(first.select(F.xxhash64("payload_digest").alias("h"))))

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        return pd.Series(shared.value.holds(h.to_numpy(np.int64).view(np.uint64)))

    # payloads with over one part's share of all repeated rows: fewer than there are parts, so they
    # are broadcast, and no part of the shuffle gets more than its share of one payload
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    repeated = first.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * parts > repeated
    rows = rows.join(F.broadcast(first.where(hot).select("payload_digest", F.col("first_id").alias("hot_id"), F.lit(True).alias("hot"))), "payload_digest", "left")
    rows = rows.withColumn("go", maybe(F.xxhash64("payload_digest")) & F.col("hot").isNull())
    stay = rows.where(~F.col("go")).withColumnRenamed("hot_id", "first_id").drop("go", "hot")
    go = rows.where("go").drop("go", "hot", "hot_id").join(first.where(~hot).drop("n"), "payload_digest", "left")
    rows = stay.unionByName(go)
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"))


def _urn(page: str) -> F.Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(page).cast("string"), F.lit("none")), F.lit(">"))


def record_text(date: str = "1970-01-01T00:00:00Z") -> F.Column:
    """A record without its end: header, empty line, block."""
    url = F.coalesce(F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit("urn:none"))
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(http, body)
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"), F.lit("\r\nWARC-Record-ID: "), _urn("page_id"),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.lit("\r\nWARC-Block-Digest: sha1:"), base32_sha1(block.cast("binary")),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
                                 _urn("refers_to"), F.lit("\r\nX-Payload-Length: "), F.col("payload_bytes").cast("string"))).otherwise(""),
        F.lit("\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END), block)


def write_warc(records: DataFrame, path: str) -> None:
    """Archives under ``path``, one a partition."""
    records.select(record_text().alias("value")).write.option("lineSep", END).text(path)


class Damaged(Exception):
    pass


_LENGTH = re.compile(rb"\d{1,18}")
_NAME = re.compile(rb"[A-Za-z0-9!#$%&'*+.^_`|~-]+")
_VERSION_LINE = re.compile(rb"WARC/1\.[0-9]{1,3}\r\n")


class Headers:
    """Header lines of one archive.  The lines walked through last are remembered: a version line
    inside them has the same end and, of each name, the same last value, unless that stands before it."""

    def __init__(self, raw: bytes):
        self.raw = raw
        self.begin, self.end, self.reason = 0, -1, ""
        self.last: dict[str, tuple[int, str]] = {}  # name to (where its last line begins, value)

    def after(self, line: int) -> tuple[int, dict[str, str]]:
        """(where the empty line behind the header lines from ``line`` on begins, the headers)."""
        if not self.begin <= line <= self.end:
            self._walk(line)
        if self.reason:
            raise Damaged(self.reason)
        return self.end, {name: value for name, (at, value) in self.last.items() if at >= line}

    def _walk(self, line: int) -> None:
        raw = self.raw
        self.begin, self.reason, self.last = line, "", {}
        while True:
            self.end = line
            stop = raw.find(b"\r\n", line)
            if stop == line:
                return
            colon = raw.find(b":", line, stop) if stop >= 0 else -1
            if stop < 0:
                # no line end behind here: whatever begins later has none either
                self.end, self.reason = len(raw), "no header end"
                return
            if colon < 0 or not _NAME.fullmatch(raw, line, colon):
                self.reason = "bad header line"
                return
            self.last[raw[line:colon].decode("latin-1").lower()] = line, raw[colon + 1:stop].strip().decode("utf-8", "replace")
            line = stop + 2


def parse(raw: bytes, at: int, lines: Headers | None = None) -> tuple[int, dict[str, str], memoryview]:
    """The record that starts at ``at``: (where it ends, headers, payload); Damaged if any check fails."""
    version = _VERSION_LINE.match(raw, at)
    if not version:
        raise Damaged("no version line")
    stop, headers = (lines or Headers(raw)).after(version.end())
    if "warc-type" not in headers or "warc-record-id" not in headers:
        raise Damaged("no type or id")
    length = headers.get("content-length", "")
    if not _LENGTH.fullmatch(length.encode()):
        raise Damaged("bad length")
    begin = stop + 2
    end = begin + int(length)
    if raw[end:end + 4] != b"\r\n\r\n":
        raise Damaged("no record end")
    block = memoryview(raw)[begin:end]
    if "warc-block-digest" in headers and headers["warc-block-digest"] != "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode():
        raise Damaged("block digest")
    payload = block
    if headers.get("content-type", "").startswith("application/http"):
        inner = raw.find(b"\r\n\r\n", begin, end)
        if inner < 0:
            raise Damaged("no http header end")
        payload = block[inner + 4 - begin:]
    if headers.get("warc-type") == "response" and "warc-payload-digest" in headers \
            and headers["warc-payload-digest"] != "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode():
        raise Damaged("payload digest")
    return end + 4, headers, payload


def salvage_plain(raw: bytes, base: int = 0) -> Iterator[tuple[str, int, int, str, dict[str, str], memoryview | None]]:
    """(kind, start, end, reason, headers, payload) of each record and each quarantined gap."""
    at, lines = 0, Headers(raw)
    while at < len(raw):
        try:
            end, headers, payload = parse(raw, at, lines)
            yield "record", base + at, base + end, "", headers, payload
            at = end
            continue
        except Damaged as e:
            reason = str(e)
        next_at = -1
        for version in _VERSION_LINE.finditer(raw, at + 1):
            try:
                parse(raw, version.start(), lines)
                next_at = version.start()
                break
            except Damaged:
                pass
        end = next_at if next_at >= 0 else len(raw)
        yield "gap", base + at, base + end, reason, {}, None
        at = end


def _member(raw: bytes, at: int) -> tuple[bytes, int]:
    """The gzip member at ``at`` and where it ends."""
    inflate, view, out, end = zlib.decompressobj(31), memoryview(raw), [], at
    try:
        while not inflate.eof and end < len(raw):
            out.append(inflate.decompress(view[end:end + PIECE]))
            end = min(end + PIECE, len(raw))
    except zlib.error as e:
        raise Damaged("gzip: " + str(e)) from None
    if not inflate.eof:
        raise Damaged("gzip: cut off")
    return b"".join(out), end - len(inflate.unused_data)


def salvage_gzip(raw: bytes) -> Iterator[tuple[str, int, int, str, dict[str, str], memoryview | None]]:
    """As ``salvage_plain`` for members of one or more records; offsets are of the archive."""
    at = 0
    while at < len(raw):
        try:
            out, end = _member(raw, at)
            if any(kind == "record" for kind, *_ in salvage_plain(out)) or not out:
                for kind, _, _, reason, headers, payload in salvage_plain(out):
                    yield kind, at, end, reason, headers, payload
                at = end
                continue
            reason = "no record in member"
        except Damaged as e:
            reason = str(e)
        next_at = raw.find(b"\x1f\x8b\x08", at + 1)
        while next_at >= 0:
            try:
                out, _ = _member(raw, next_at)
                if out.startswith(VERSION):
                    break
            except Damaged:
                pass
            next_at = raw.find(b"\x1f\x8b\x08", next_at + 1)
        end = next_at if next_at >= 0 else len(raw)
        yield "gap", at, end, reason, {}, None
        at = end


_SCHEMA = pa.schema([("archive", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reason", pa.string()),
                     ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()),
                     ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records (kind ``record``) and quarantined byte gaps (kind ``gap``) of the archives under
    ``path``.  payload_bytes and payload_digest are of the full payload, for revisits as their
    headers say; for responses both are measured on the bytes read."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, raw = batch.column("path")[i].as_py(), batch.column("content")[i].as_py()
                rows, held = [], 0
                for kind, start, end, reason, h, payload in (salvage_gzip if raw[:2] == b"\x1f\x8b" else salvage_plain)(raw):
                    revisit = h.get("warc-type") == "revisit"
                    if payload is None:
                        digest, size = None, None
                    elif revisit:
                        digest, size = h.get("warc-payload-digest", "").removeprefix("sha1:"), int(h.get("x-payload-length", "0"))
                    else:
                        digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
                    rows.append((name, kind, start, end, reason or None, h.get("warc-type"), h.get("warc-record-id"), h.get("warc-refers-to"),
                                 h.get("warc-target-uri"), digest, size, bytes(payload) if payloads and payload is not None else None))
                    held += len(payload or b"") if payloads else 0
                    if len(rows) >= 4096 or held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    return files.mapInArrow(work, "archive string, kind string, start long, end long, reason string, record_type string, record_id string, "
                                  "refers_to string, target_uri string, payload_digest string, payload_bytes long, payload binary")


def page_of(urn: str) -> F.Column:
    """The page id in a record's urn; null for none."""
    return F.regexp_extract(urn, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(records(table(spark, sf_dir, "pages")), path)
    # a gap in archives just written is lost rows: the query fails
    sound = F.when(F.col("kind") == "record", True).otherwise(F.raise_error(F.concat(F.lit("gap in a written archive: "), F.col("archive"), F.lit(": "), F.col("reason"))))
    return read_warc(spark, path, payloads=False).where(sound).select(
        page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").alias("refers_to"))
