"""WARC: exact round trip, revisits, ranges, odd rows."""

from __future__ import annotations

import glob
import gzip
import hashlib

from martlet.llm import warc
from martlet.llm.catalog import QUERIES
from martlet.llm.common import scratch, table

SF = "/root/testdata/sf0.001"
BIG = "<p>" + "é" * 600 + "</p>"
ODD = [
    (1, "http://a/", BIG), (5, None, BIG), (3, "http://b/ x\r\nEvil: 1", BIG), (None, "u", BIG), (2, "u", None), (4, "u", ""),
    (6, "u", "small"), (7, "u", "small"), (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 200), (9, "u", "z" * 3_000_000), (5, None, BIG),
]


def brute(rows):
    pay = [(i, (h or "").encode()) for i, _, h in rows]
    newest = {}
    for i, p in pay:
        if len(p) >= 1000 and i is not None:
            newest[p] = max(newest.get(p, i), i)
    out = []
    for i, p in pay:
        keep = newest.get(p) if len(p) >= 1000 and sum(q == p for _, q in pay) > 1 else None
        revisit = keep is not None and keep != i
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", keep if revisit else None))
    return sorted(out, key=str)


def test_query(spark):
    rows = [(r.page_id, r.url, r.html) for r in table(spark, SF, "pages").collect()]
    got = QUERIES["op7_warc"](spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def odd(spark, n):
    rows = [(i, u, h, "x", 1) for i, u, h in ODD]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, keep int").repartition(n)


def test_odd_rows_round_trip(spark):
    for n in (1, 4):
        path = scratch(spark, "t")
        index = warc.write_archives(odd(spark, n), path)
        got = warc.read_records(index, path, max_gap=10, max_read=1 << 16).collect()
        assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == brute(ODD)
        for r in got:
            assert (r.payload is None) == (r.record_type == "revisit")
            assert r.payload is None or hashlib.sha1(r.payload).hexdigest() == r.payload_digest


def test_archives_are_whole_warc_files(spark):
    path = scratch(spark, "t")
    index = warc.write_archives(odd(spark, 2), path).collect()
    records = 0
    for f in glob.glob(path.removeprefix("file:") + "/*.warc.gz"):
        data = gzip.open(f).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\n") and b"Evil: 1\r" not in head.replace(b"x Evil: 1", b"")
            size = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
            assert rest[size : size + 4] == b"\r\n\r\n"
            data, records = rest[size + 4 :], records + 1
    assert records == len(index) == len(ODD)


def test_selection_by_index(spark):
    path = scratch(spark, "t")
    index = warc.write_archives(odd(spark, 3), path)
    some = warc.read_records(index.where("page_id in (4, 8)"), path).collect()
    assert sorted(r.page_id for r in some) == [4, 8]
    assert warc.read_records(index.where("false"), path).count() == 0
    empty = warc.write_archives(odd(spark, 1).where("false"), scratch(spark, "t"))
    assert empty.count() == 0


def test_ranges_are_coalesced_within_bounds():
    ranges = [("a", 0, 10), ("a", 12, 5), ("a", 40, 5), ("b", 45, 5), ("b", 50, 90), ("b", 140, 5)]
    got = list(warc.coalesce_ranges(ranges, max_gap=5, max_read=60))
    assert [(f, s, e, len(p)) for f, s, e, p in got] == [
        ("a", 0, 17, 2), ("a", 40, 45, 1), ("b", 45, 50, 1), ("b", 50, 140, 1), ("b", 140, 145, 1)
    ]
