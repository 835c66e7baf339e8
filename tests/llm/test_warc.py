"""WARC: brute force, exact round trip, salvage."""

from __future__ import annotations

import base64
import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cyclewise.llm import warc

PAGES = "page_id long, url string, html string, value string, sha string"


def _pages(spark):
    rows = [
        (1, "http://a", "<p>x</p>", "v", "s"), (9, "http://b\r\nX: y", "<p>x</p>", None, None),
        (4, None, "<p>x</p>", None, None), (5, "u", None, None, None), (6, "u", "", None, None),
        (7, "u", "Größe\r\n\r\nWARC/1.1\r\nContent-Length: 3", None, None),
        (7, "u", "Größe\r\n\r\nWARC/1.1\r\nContent-Length: 3", None, None),
        (None, "u", "<p>x</p>", None, None), (None, "u", "alone", None, None),
        (8, "u", "long " * 400_000, None, None),
    ]
    return spark.createDataFrame(rows, PAGES)


def _expected(rows):
    out = []
    payloads = [(r["page_id"], (r["html"] or "").encode()) for r in rows]
    for page_id, data in payloads:
        ids = [p for p, d in payloads if d == data and p is not None]
        winner = max(ids) if ids else None
        revisit = winner is not None and page_id != winner
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "revisit" if revisit else "response", winner if revisit else None))
    return sorted(out, key=str)


def test_round_trip_equals_brute_force(spark):
    pages = _pages(spark)
    got = sorted((tuple(r) for r in warc.round_trip(pages).collect()), key=str)
    assert got == _expected(pages.collect())


def test_registered_query_equals_brute_force(spark, sf_dir):
    from cyclewise.llm.queries import QUERIES

    got = sorted((tuple(r) for r in QUERIES["op2_warc_round_trip"](spark, sf_dir).collect()), key=str)
    assert got == _expected(spark.read.parquet(f"{sf_dir}/pages.parquet").collect())


def test_payloads_survive_plain_and_packed(spark, tmp_path):
    pages = _pages(spark)
    for compress in (True, False):
        path = str(tmp_path / f"w{compress}")
        warc.write_warc(pages, path, compress=compress)
        back = warc.read_warc(spark, path).collect()
        assert {r["kind"] for r in back} == {"record"}
        assert {bytes(r["payload"]) for r in back if r["record_type"] == "response"} == {
            (r["html"] or "").encode() for r in pages.collect()
        }


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def _records(n):
    bodies = [f"<p>page {i}</p>".encode() * 30 for i in range(n)]
    return [
        warc.record_bytes(i, "http://a", b, None, False, base64.b32encode(hashlib.sha1(b).digest()).decode())
        for i, b in enumerate(bodies)
    ]


def _walk(data):
    found = list(warc.read_records(data))
    ids = [warc._page(f[3]["warc-record-id"]) for f in found if f[0] == "record"]
    gaps = [(f[1], f[2]) for f in found if f[0] == "gap"]
    assert sum(f[2] for f in found) == len(data)
    return ids, gaps


def test_salvage_of_members():
    members = [warc.member(r) + b"\0" for r in _records(5)]
    assert _walk(b"".join(members)) == ([0, 1, 2, 3, 4], [])
    broken = bytearray(b"".join(members))
    at = len(members[0]) + len(members[1]) // 2
    broken[at] ^= 0xFF
    assert _walk(bytes(broken)) == ([0, 2, 3, 4], [(len(members[0]), len(members[1]))])
    noisy = members[0] + b"noise \x1f\x8b\x08 noise" + members[1] + members[2][:-9]
    ids, gaps = _walk(noisy)
    assert ids == [0, 1] and len(gaps) == 2


def test_salvage_of_plain_records():
    records = _records(4)
    assert _walk(b"".join(records)) == ([0, 1, 2, 3], [])
    cut = records[0] + records[1][: len(records[1]) // 2] + records[2] + records[3]
    assert _walk(cut)[0] == [0, 2, 3]
    altered = records[0] + records[1].replace(b"page 1", b"page X", 1) + records[2]
    ids, gaps = _walk(altered)
    assert ids == [0, 2] and gaps == [(len(records[0]), len(records[1]))]
    assert _walk(b"") == ([], [])


def test_long_header_comes_back(spark):
    rows = [(1, "http://a/" + "x" * 200_000, "<p>y</p>", None, None), (2, "u", "<p>z</p>", None, None)]
    pages = spark.createDataFrame(rows, PAGES)
    got = sorted((tuple(r) for r in warc.round_trip(pages).collect()), key=str)
    assert got == _expected(pages.collect())


def test_version_marks_without_headers_take_linear_time():
    import time

    data = b"WARC/1.1 broken " * 60_000
    record = warc.record_bytes(1, "u", b"body", None, False, warc._base32(hashlib.sha1(b"body").digest()))
    started = time.perf_counter()
    found = list(warc.read_records(data + record))
    assert time.perf_counter() - started < 5
    assert [f[0] for f in found] == ["gap", "record"] and found[0][2] == len(data)


def test_archives_are_closed_by_bytes(spark, tmp_path):
    pages = spark.range(300).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.col("id").cast("string"), 5_000).alias("html")
    )
    warc.write_warc(pages.coalesce(1), f"{tmp_path}/w", compress=False, bytes_per_file=100_000)
    files = [f for f in tmp_path.rglob("part-*") if not f.name.startswith(".")]
    sizes = [f.stat().st_size for f in files]
    assert len(files) > 10 and max(sizes) < 130_000
    back = warc.read_warc(spark, f"{tmp_path}/w")
    assert back.filter("kind = 'gap'").count() == 0 and back.filter("record_type = 'response'").count() == 300


def test_a_gap_in_a_fresh_archive_is_an_error(spark, monkeypatch):
    real = warc.read_warc

    def with_gap(session, path, payload=True):
        rows = real(session, path, payload)
        gap = rows.limit(1).withColumn("kind", F.lit("gap")).withColumn("reason", F.lit("planted"))
        return rows.unionByName(gap)

    monkeypatch.setattr(warc, "read_warc", with_gap)
    with pytest.raises(PySparkException, match="planted"):
        warc.round_trip(_pages(spark)).collect()
