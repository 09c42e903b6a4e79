import base64
import hashlib

import pytest

from wardline.llm import warc as X
from wardline.llm.common import Scratch

HTML = ["<p>a</p>", "<p>a</p>", None, "", "é😀" * 9000, "é😀" * 9000, "WARC/1.1\r\n\r\n" * 40, "\r\n\r\n", "<p>b</p>",
        "x" * 16_300, "y" * 200_000]


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows],
                                 "page_id long, url string, html string, first string, payload string")


def brute(rows):
    first = {}
    for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(h or "", i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        revisit = first[h or ""] != i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", first[h or ""] if revisit else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_round_trip(spark):
    rows = [(i, f"http://h/{i}\r\nX: y", h) for i, h in enumerate(HTML)] + [(20, None, "<p>a</p>"), (21, "", "z")]
    rows += [(22, "u", "twice"), (22, "u", "twice"), (23, "u", "twice"), (None, "u", "<p>b</p>"),
             (24, "u", "long" * 20_000), (24, "u", "long" * 20_000), (None, "u", "alone")]
    assert got(X.round_trip(pages(spark, rows))) == brute(rows)
    assert got(X.round_trip(pages(spark, []))) == []


def test_payloads_come_back_from_the_files(spark, monkeypatch):
    monkeypatch.setattr(X, "RECORDS_PER_FILE", 3)
    scratch = Scratch(spark, "warc-test")
    path = f"{scratch.base}/files"
    rows = [(i, f"http://h/{i}", h) for i, h in enumerate(HTML)]
    X.write_archives(pages(spark, rows), path, segment_bytes=1000, min_revisit_bytes=100, scratch=scratch)
    out = {r.page_id: r for r in X.read_archives(spark, path, scratch).collect()}
    assert {i: bytes(r.data).decode() for i, r in out.items() if r.record_type == "response"} == {
        i: h or "" for i, h in enumerate(HTML) if i != 5}
    assert out[5].refers_to == 4 and out[5].url == "http://h/5" and out[1].record_type == "response"


def test_broken_framing_raises():
    assert X.dechunked(b"3;x=1\r\nabc\r\n2\r\nde\r\n0\r\nTrailer: 1\r\n\r\n") == b"abcde"
    for bad in (b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabc", b"zz\r\n"):
        with pytest.raises(ValueError):
            X.dechunked(bad)


def test_lost_segment_raises(spark):
    scratch = Scratch(spark, "warc-test")
    records = list(X.records_of(1, "u", b"q" * 5000, None, False, 1000))
    del records[2]
    df = spark.createDataFrame([(bytearray(r),) for r in records], "record binary")
    df.selectExpr("cast(record as string) as value").write.option("lineSep", "\r\n\r\n").text(f"{scratch.base}/cut",
                                                                                           compression="gzip")
    with pytest.raises(Exception, match="incomplete"):
        X.read_archives(spark, f"{scratch.base}/cut", scratch).collect()
