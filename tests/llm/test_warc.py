import base64
import gzip
import hashlib
import time

import pytest

from chronoweave.llm import warc_salvage as op
from chronoweave.llm.common import ship
from chronoweave.session import scratch_path

PAGES = [(5, "http://a/1", "<p>same</p>"), (3, "http://a/2", "<p>same</p>"), (9, None, "<p>same</p>"), (4, "http://b\r\n/x", "<p>é😀 own\r\n\r\nWARC/1.1 text</p>"),
         (6, "http://c", None), (2, "http://d", ""), (None, "http://e", "<p>same</p>"), (None, "http://f", "<i>lone</i>"), (8, "http://g", "z" * 300_000), (3, "http://a/2", "<p>same</p>")]


@pytest.fixture(scope="module")
def pages(spark):
    ship(spark)
    return spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, payload string, record_type int").repartition(3)


def expected():
    first = {}
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in PAGES:
        raw, f = (h or "").encode(), first.get(h or "")
        revisit = f is not None and i != f
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark, pages):
    path = scratch_path(spark, "warc-test")
    op.write_warc(op.records(pages), path)
    back = op.read_warc(spark, path)
    assert back.where("kind = 'gap'").count() == 0
    rows = back.select(op.page_of("record_id").alias("i"), "payload_bytes", "payload_digest", "record_type", op.page_of("refers_to").alias("r")).collect()
    assert sorted((tuple(r) for r in rows), key=str) == expected()
    payloads = {(r.i, bytes(r.payload)) for r in back.where("record_type = 'response'").select(op.page_of("record_id").alias("i"), "payload").collect()}
    assert (4, PAGES[3][2].encode()) in payloads and (8, b"z" * 300_000) in payloads


def test_smaller_payloads_are_all_responses(pages):
    rows = op.records(pages, least=20).collect()
    assert {r.record_type for r in rows if r.payload_bytes < 20} == {"response"}


def test_empty(spark, pages):
    path = scratch_path(spark, "warc-none")
    op.write_warc(op.records(pages.limit(0)), path)
    assert op.read_warc(spark, path).collect() == []


def archive(n=6):
    out = []
    for i in range(n):
        block = b"HTTP/1.1 200 OK\r\n\r\n" + f"<p>page {i}</p>".encode() * 20
        digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
        out.append((f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Type: application/http\r\n"
                    f"WARC-Block-Digest: sha1:{digest}\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n")
    return out


def ids(found):
    return [h["warc-record-id"] for kind, _, _, _, h, _ in found if kind == "record"]


def gaps(found):
    return [(a, b) for kind, a, b, *_ in found if kind == "gap"]


def test_damage_costs_one_record_and_is_logged():
    records = archive()
    at = [sum(map(len, records[:i])) for i in range(7)]
    raw = b"".join(records)
    for harm in (lambda r: r[:at[2] + 200] + b"#" + r[at[2] + 201:],  # a payload byte
                 lambda r: r[:at[2] + 3] + b"X" + r[at[2] + 4:],  # the version line
                 lambda r: r.replace(b"WARC-Record-ID: <urn:page:2>", b"WARC-Record-ID _<urn:page:2>")):  # a header
        found = list(op.salvage_plain(harm(raw)))
        assert ids(found) == [f"<urn:page:{i}>" for i in (0, 1, 3, 4, 5)] and gaps(found) == [(at[2], at[3])]
    short = raw[:at[2] + 100] + raw[at[2] + 150:]
    found = list(op.salvage_plain(short))
    assert ids(found) == [f"<urn:page:{i}>" for i in (0, 1, 3, 4, 5)] and gaps(found) == [(at[2], at[3] - 50)]
    found = list(op.salvage_plain(b"junk" + raw[:at[5] + 30]))
    assert ids(found) == [f"<urn:page:{i}>" for i in range(5)] and gaps(found) == [(0, 4), (4 + at[5], 4 + at[5] + 30)]


def test_damaged_members():
    members = [gzip.compress(r) for r in archive()]
    at = [sum(map(len, members[:i])) for i in range(7)]
    raw = bytearray(b"".join(members))
    assert ids(op.salvage_gzip(bytes(raw))) == [f"<urn:page:{i}>" for i in range(6)]
    raw[at[3] + 40] ^= 0xFF
    found = list(op.salvage_gzip(bytes(raw)))
    assert ids(found) == [f"<urn:page:{i}>" for i in (0, 1, 2, 4, 5)] and gaps(found) == [(at[3], at[4])]


def test_gaps_are_rows(spark, pages, tmp_path):
    raw = archive()
    (tmp_path / "a.warc").write_bytes(b"".join(raw[:2]) + b"garbage" + b"".join(raw[2:]))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(raw[0])[:-9] + gzip.compress(raw[1]))
    (tmp_path / "c.warc").write_bytes(b"")
    out = op.read_warc(spark, str(tmp_path)).collect()
    assert sum(r.kind == "record" for r in out) == 7
    assert sorted((r.archive[-6:], r.end - r.start) for r in out if r.kind == "gap") == [("a.warc", 7), ("arc.gz", len(gzip.compress(raw[0])) - 9)]


def test_long_headers(spark, tmp_path):
    url = "data:text/html," + "a" * 100_000
    rows = [(1, "http://a", "<p>one</p>"), (2, url, "<p>two</p>"), (3, url + "b", "<p>two</p>"), (4, "http://b", "<p>four</p>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    out = {r.page_id: (r.record_type, r.refers_to) for r in op.query(spark, str(tmp_path)).collect()}
    assert out == {1: ("response", None), 2: ("response", None), 3: ("revisit", 2), 4: ("response", None)}
    block = b"HTTP/1.1 200 OK\r\nX-Long: " + b"h" * 100_000 + b"\r\n\r\nbody"
    record = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:7>\r\nX-Long: {'h' * 100_000}\r\nContent-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n"
    found = list(op.salvage_plain(archive(1)[0] + record.encode() + block + b"\r\n\r\n" + archive(1)[0]))
    assert gaps(found) == [] and [bytes(f[5]) for f in found][1] == b"body"


def test_query_fails_on_a_gap(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "http://a", "x")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    write = op.write_warc

    def damaged(records, path):
        write(records, path)
        records.sparkSession.createDataFrame([("WARC/1.1",)], "value string").write.mode("append").text(path)

    monkeypatch.setattr(op, "write_warc", damaged)
    with pytest.raises(Exception, match="gap in a written archive"):
        op.query(spark, str(tmp_path)).collect()


def seconds(work):
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


@pytest.mark.parametrize("junk", [b"WARC/1.", b"WARC/1.1 ", b"WARC/1.1\r\n", b"X: WARC/1.1\r\n", b"X: y\r\nWARC/1.1\r\nX: WARC/1.1\r\n"])
def test_many_version_lines_take_time_by_size(junk):
    record = archive(1)[0]
    found = list(op.salvage_plain(junk * 2000 + record + junk * 3 + record))
    assert gaps(found) == [(0, len(junk) * 2000), (len(junk) * 2000 + len(record), len(junk) * 2003 + len(record))] and len(ids(found)) == 2
    small, large = (min(seconds(lambda: list(op.salvage_plain(junk * n))) for _ in range(2)) for n in (40_000, 400_000))
    assert large < 30 * small + 0.5


def test_a_header_keeps_its_last_value_only_behind_the_version_line():
    block = b"<p>body</p>"
    inner = b"WARC/1.1\r\nWARC-Record-ID: <b>\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    # the type stands before the second version line only, so no record starts there
    found = list(op.salvage_plain(b"WARC/1.1\r\nWARC-Type: resource\r\nX: " + inner))
    assert gaps(found) == [] and found[0][4]["warc-record-id"] == "<b>" and found[0][1] == 0
    found = list(op.salvage_plain(b"WARC/1.1\r\n: bad\r\nWARC-Type: resource\r\nX: " + inner))
    assert ids(found) == []


def test_many_members_take_time_by_size():
    member = gzip.compress(archive(1)[0])
    assert len(ids(op.salvage_gzip(member * 300))) == 300
    small, large = (min(seconds(lambda: list(op.salvage_gzip(member * n))) for _ in range(2)) for n in (1000, 10_000))
    assert large < 30 * small + 0.5
    long = gzip.compress(b"".join(archive(4000)))
    assert len(ids(op.salvage_gzip(long + member))) == 4001


def test_hot_payloads_are_not_shuffled_by_digest(spark):
    pages = [(i, f"http://{i}", "hot" if i % 3 else f"<p>{i // 30}</p>") for i in range(600)]
    out = op.records(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    first = {}
    for i, _, h in pages:
        first.setdefault(h, i)
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in out) == [(i, "response" if first[h] == i else "revisit", None if first[h] == i else first[h]) for i, _, h in pages]
