from __future__ import annotations

import base64
import hashlib

import pytest

from texmend.llm import warc

FORGED = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
PAGES = [
    (1, "http://a", "<p>one</p>"), (2, "http://b", "<p>one</p>"), (3, "http://c", FORGED), (4, None, None), (5, "http://e", ""), (6, "http://f", f"x{FORGED}y{FORGED}"), (7, "bad url\r\nX: y", "é😀" * 500),
    (8, "http://h", "\r\n\r\n"), (9, "http://i", "end\r\n\r\nWARC/1.1\r\n"), (9, "http://i", "end\r\n\r\nWARC/1.1\r\n"), (None, "http://n", "<p>one</p>"), (10, "http://j", "WARC/1.1\r\n" * 50),
]


def expected(rows):
    newest = {}
    for i, _, html in rows:
        newest[html or ""] = max(newest.get(html or "", -1), -1 if i is None else i)
    out = []
    for i, _, html in rows:
        raw, low = (html or "").encode(), newest[html or ""]
        same = i == low or low == -1
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if same else "revisit", None if same else low))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", ["128m", "700b"])
def test_round_trip(spark, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = PAGES + [(100 + k, "http://x", f"page {k} " * 30) for k in range(40)]
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
        got = warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_hostile_lengths(spark):
    html = ["x WARC/1.1\r\nContent-Length: " + n + "\r\n\r\nbody" for n in ("99999999999999999999", "²", "9" * 5000, "-1", "")]
    pages = spark.createDataFrame([(k, f"http://x/{k}", h) for k, h in enumerate(html)], "page_id long, url string, html string")
    assert {r.page_id: r.payload_bytes for r in warc.round_trip(pages).collect()} == {k: len(h.encode()) for k, h in enumerate(html)}
