import hashlib
import io

import pytest

from recurwork.llm import warc


def want(rows):
    """Plain version: by payload, in one loop."""
    first = {}
    for i, _, html in rows:
        p = (html or "").encode()
        if len(p) >= 100 and i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, _, html in rows:
        p = (html or "").encode()
        again = p in first and first[p] != i
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", first[p] if again else None))
    return sorted(out, key=repr)


def got(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    found = warc.through_archives(spark, df).collect()
    assert all(r.error is None for r in found)
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=repr)


def test_round_trip_with_nulls_copies_repeats_and_long_pages(spark):
    tricky = "WARC/1.1\r\n\r\n\r\nContent-Length: 7\r\n\r\n"
    rows = [(1, "http://a", "x" * 200), (0, None, "x" * 200), (5, "u\r\nv", "é" * 50_000), (6, "w", None), (None, "n", "x" * 200), (None, "n", "only null " * 20),
            (7, "z", "small"), (8, "z", "small"), (9, "b", tricky * 4000), (10, "b", tricky * 4000), (10, "b", tricky * 4000), (9, "b", tricky * 4000),
            (11, "c", "y" * 99), (12, "c", "y" * 99), (13, "d", "z" * 100), (14, "d", "z" * 100), (15, "e", ""), (16, "e", "\r\n\r\n" * 9)]
    assert got(spark, rows) == want(rows)


def test_empty_table(spark):
    assert warc.through_archives(spark, spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pages(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()]
    rows += [(10_000 + i, u, h) for i, u, h in rows[:20]]
    assert got(spark, rows) == want(rows)


def segments(n=70_000):
    records = warc.records_of(3, "u", "ab" * n, hashlib.sha256(b"ab" * n).hexdigest(), None)
    parsed = [warc.row_of(*next(warc.parsed(io.BytesIO(r)))) for r in records]
    names = [f.name for f in warc.PARSED_ARROW]
    return [dict(zip(names, p, strict=True)) for p in parsed]


def test_segments_are_put_in_order_and_checked():
    own = segments()
    assert len(own) > 3 and own[0]["number"] == 1 and {s["origin"] for s in own} == {own[0]["origin"]}
    assert warc.assembled(own[::-1]) == (3, hashlib.sha256(b"ab" * 70_000).hexdigest(), 140_000, None)
    assert warc.assembled(own + own[1:2]) == warc.assembled(own)
    assert "missing" in warc.assembled(own[:1] + own[2:])[3]
    assert "length" in warc.assembled(own[:-1])[3]
    assert "digest" in warc.assembled([s | {"digest": "0" * 64} if s["number"] == 1 else s for s in own])[3]


def test_chunks():
    for payload in (b"", b"a", b"\r\n0\r\n\r\n" * 5000, bytes(range(256)) * 100):
        assert warc.unchunked(warc.chunked(payload)) == payload
    assert warc.unchunked(b"3;name=v\r\nabc\r\n0\r\n\r\n") == b"abc"
    for broken in (b"3\r\nab", b"x\r\n", b"3\r\nabcd\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(broken)
