import gzip
import hashlib
import io
import os

import duckdb
import pytest

from conftest import SF001
from eventide.llm import warc as W
from eventide.llm.catalog import ORACLE_SQL, QUERIES

LONG = "<p>payload é</p>" * 40


@pytest.fixture()
def path(scratch):
    return scratch


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 5) for r in rows],
                                 "page_id long, url string, html string, payload string, first int").repartition(3)


ROWS = [(5, "http://a/1", LONG), (3, "http://a/2\r\nWARC-Type: evil", LONG), (9, None, LONG), (1, "http://b/é", "short"), (2, "http://b", "short"),
        (4, "u", None), (6, "u", ""), (7, "u", LONG + "\r\n\r\nWARC/1.1\r\n"), (None, "none", LONG), (8, "big", "x" * 3_000_000),
        (10, "u", "z" * 100), (11, "u", "z" * 100), (12, "u", "z" * 99), (13, "u", "z" * 99)]


def test_round_trip(spark, path):
    W.archive_pages(pages(spark, ROWS), path, fileBytes=2000)
    got = {r.page_id: r for r in W.read_pages(spark, path).collect()}
    first = {LONG: 3, "z" * 100: 10}
    for i, _, html in ROWS:
        data = (html or "").encode()
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        want = first.get(html)
        assert (r.record_type, r.refers_to) == (("revisit", want) if want not in (None, i) else ("response", None))
    assert len(got) == len(ROWS)
    assert {r.page_id: r.url for r in got.values()}[3] == "http://a/2%0D%0AWARC-Type: evil"
    payloads = {r.record_id: r.payload for r in spark.read.format("warc").load(path).collect()}
    assert bytes(payloads["urn:page:8"]) == b"x" * 3_000_000 and payloads["urn:page:5"] is None


def test_archives_are_standard_gzip(spark, path):
    W.archive_pages(pages(spark, ROWS), path)
    text = b"".join(gzip.open(f"{path}/{f}").read() for f in os.listdir(path) if f.endswith(".warc.gz"))
    assert text.count(b"WARC/1.1\r\nWARC-Type: re") == len(ROWS)


def test_filters_reach_the_source(spark, path, monkeypatch):
    W.archive_pages(pages(spark, ROWS), path)
    W.register(spark)
    df = spark.read.format("warc").load(path).where("record_type = 'revisit' and target_uri = 'http://a/1' and length(target_uri) > 3")
    plan = df._jdf.queryExecution().toString()
    assert "record_type" not in plan.split("Physical Plan")[1].split("Filter")[1].split("\n")[0]    # only what the source cannot do stays
    assert [r.record_id for r in df.collect()] == ["urn:page:5"]
    assert spark.read.format("warc").option("header:warc-type", "revisit").load(path).count() == 4
    reader = W.WarcReader({"path": path})
    from pyspark.sql.datasource import EqualTo
    assert list(reader.pushFilters([EqualTo(("record_type",), "revisit"), EqualTo(("payload",), b"")])) == [EqualTo(("payload",), b"")]
    decoded = []
    monkeypatch.setattr(W, "http_payload", lambda b: decoded.append(b) or b)
    found = [b for p in reader.partitions() for b in reader.read(p)]
    assert sum(b.num_rows for b in found) == 4 and not decoded      # headers only


def test_foreign_archives(spark, path):
    plain = b"".join(gzip.decompress(W.encode_record({"record_id": f"urn:{k}", "record_type": t, "payload": b"p" * k}, "2024-01-01T00:00:00Z"))
                     for k, t in ((1, "response"), (70_000, "response"), (0, "request")))
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n4\r\nWiki\r\n5;x=1\r\npedia\r\n0\r\n\r\n"
    plain += b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:c>\r\nX-Fold: a\r\n b\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n" % (len(chunked), chunked)
    os.makedirs(path)
    for name, data in (("a.warc", plain), ("b.warc.gz", gzip.compress(plain)), ("c.warc.gz", gzip.compress(plain[:200]) + gzip.compress(plain[200:])), ("skip.txt", b"x")):
        open(f"{path}/{name}", "wb").write(data)
    W.register(spark)
    for name in ("a.warc", "b.warc.gz", "c.warc.gz"):
        got = {r.record_id: r for r in spark.read.format("warc").load(f"{path}/{name}").collect()}
        assert {k: len(r.payload) for k, r in got.items()} == {"urn:1": 1, "urn:70000": 70_000, "urn:0": 0, "urn:c": 9}
        assert got["urn:c"].payload == b"Wikipedia" and got["urn:c"].headers["x-fold"] == "a b"
    assert spark.read.format("warc").option("partitionBytes", "1").load(path).rdd.getNumPartitions() == 3
    assert spark.read.format("warc").load(path).count() == 12
    with pytest.raises(ValueError):
        list(W.records(io.BytesIO(plain[:300]), 300))


def test_lengths_that_foreign_archives_do_not_tell(spark, path):
    os.makedirs(path)
    record = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:%d>\r\nContent-Type: text/plain\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n"
    open(f"{path}/f.warc", "wb").write(b"".join(record % (n, n, b"x" * n) for n in (500, 20)))
    W.register(spark)
    df = spark.read.format("warc").load(path)
    assert [r.payload_length for r in df.where("payload_length >= 100").collect()] == [500]
    assert df.where("payload_length is null").count() == 0 and df.where("payload_length in (20, 500) and record_type = 'resource'").count() == 2
    bare = spark.read.format("warc").option("payload", "false").load(path)      # payloads not read: their length is not known
    assert bare.where("payload_length >= 100").count() == 0 and bare.where("payload_length is null").count() == 2


def test_uncommitted_files_are_not_read(spark, path):
    W.archive_pages(pages(spark, ROWS[:3]), path)
    open(f"{path}/lost-task.warc.gz", "wb").write(b"half a record")
    assert W.read_pages(spark, path).count() == 3
    W.archive_pages(pages(spark, ROWS[3:5]), path)
    assert W.read_pages(spark, path).count() == 5


def test_empty_table_and_repeated_rows(spark, path):
    W.archive_pages(pages(spark, []).limit(0), path)
    assert W.read_pages(spark, path).count() == 0
    W.archive_pages(pages(spark, [(1, "a", LONG), (1, "a", LONG), (2, "a", LONG)]), path + "2")
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in W.read_pages(spark, path + "2").collect()) == [
        (1, "response", None), (1, "response", None), (2, "revisit", 1)]


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{SF001}/pages.parquet')")
    df = QUERIES["op4_warc"](spark, SF001)
    want = con.execute(ORACLE_SQL["op4_warc"])
    cols = [d[0] for d in want.description]
    assert sorted(map(tuple, df.select(cols).collect())) == sorted(want.fetchall())
