"""WARC archives: exact round trip, and the SQL of the query."""

import glob
import gzip
import hashlib
import re

import pytest

from tallyloom.llm import queries, warc


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, payload string")


ROWS = [
    (1, "http://a/1", "x" * 1000), (2, "http://a/2", "x" * 1000), (9, None, "x" * 1000), (3, "http://a/é ü\r\nX: y%20", "é" * 500), (4, "u", "é" * 500),
    (5, "u", "y" * 999), (6, "u", "y" * 999), (7, "", None), (8, "u", ""), (None, "n", "solo\r\n\r\n" * 300), (10, "u", "long " * 300000),
    (11, "u", "tie" * 400), (11, "u", "tie" * 400), (None, "u", "x" * 1000),
]


def test_round_trip(spark):
    folder, index = warc.write_archives(frame(spark, ROWS))
    back = warc.read_archives(folder, index).collect()
    keep = {}
    for i, _, h in ROWS:
        if h and len(h.encode()) >= 1000 and i is not None:
            keep[h] = max(i, keep.get(h, i))
    want = []
    for i, u, h in ROWS:
        data, first = (h or "").encode(), keep.get(h) if h and len(h.encode()) >= 1000 else None
        copy = first is not None and first != i
        want.append((i, u, len(data), hashlib.sha1(data).hexdigest(), "revisit" if copy else "response", first if copy else None, None if copy else data))
    got = [(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in back]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    one = warc.read_archives(folder, index.where("page_id in (3, 8)")).collect()
    assert sorted(r.page_id for r in one) == [3, 8]
    assert warc.read_archives(*warc.write_archives(frame(spark, []))).count() == 0


def test_ranges_join_neighbours(spark):
    rows = [(0, "f", o, 10, "", "", 0, "") for o in (0, 10, 20, 200, 210)] + [(0, "g", 5, 10, "", "", 0, "")]
    index = spark.createDataFrame(rows, warc.INDEX)
    got = sorted((r.file, r.begin, r.end, len(r.records)) for r in warc.ranges(index, 1000, 50).collect())
    assert got == [("f", 0, 30, 3), ("f", 200, 220, 2), ("g", 5, 15, 1)]


def test_damage_is_told():
    data = warc.record(1, "u", b"payload", hashlib.sha1(b"other bytes").hexdigest(), None, "1970-01-01T00:00:00Z")
    with pytest.raises(ValueError):
        warc.parse(data)


def test_query_agrees_with_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{folder}/pages.parquet')")
    got = queries.QUERIES["op9_warc"](spark, folder)
    want = con.sql(queries.ORACLES["op9_warc"])
    assert sorted(map(repr, (tuple(r) for r in got.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_target_uri_is_the_url():
    for url, stored in (("http://x.org/a%20b?q={1}|2", "http://x.org/a%20b?q={1}|2"), ("http://x.org/\u00e9 b", "http://x.org/%C3%A9%20b"), ("a\r\nX: y", "a%0D%0AX:%20y")):
        data = warc.record(1, url, b"", hashlib.sha1(b"").hexdigest(), None, "1970-01-01T00:00:00Z", "f/0")
        assert f"WARC-Target-URI: {stored}\r\n".encode() in gzip.decompress(data)
        assert warc.parse(data)["url"] == url


def test_record_ids_differ_and_reading_is_spread(spark):
    folder, index = warc.write_archives(frame(spark, ROWS))
    ids = set()
    for file in glob.glob(f"{folder.removeprefix('file:')}/*.warc.gz"):
        with gzip.open(file) as f:
            ids |= set(re.findall(rb"WARC-Record-ID: (<urn:uuid:[^>]+>)", f.read()))
    assert len(ids) == len(ROWS)
    assert warc.read_archives(folder, index).rdd.getNumPartitions() == 4
