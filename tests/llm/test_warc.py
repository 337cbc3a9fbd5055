import gzip
import hashlib
import io

import pytest

from panelkit.llm import warc

PAGES = [
    (1, "http://a/1", "x" * 1000), (2, "http://a/2", "x" * 1000), (3, "http://b/3\r\nX: y", "x" * 1000), (3, None, "x" * 1000),
    (4, "http://a/4", "y" * 999), (5, "http://a/5", "y" * 999), (6, "http://a/6", None), (7, "http://a/7", ""),
    (None, "http://a/8", "x" * 1000), (9, "http://ü/9", "é" * 600 + "\r\n\r\n\0"), (None, None, "z" * 5000), (None, None, "z" * 5000),
    (10, "http://a/10", "long " * 400_000),
]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    warc.register(spark)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as record_type", "2 as payload")
    path = str(tmp_path_factory.mktemp("warc"))
    warc.page_records(pages.repartition(3)).write.format("warc").mode("append").save(path)
    return path


def test_round_trip(spark, archive):
    rows = spark.read.format("warc").load(archive).withColumn("page_id", warc.page_number("record_id")).collect()
    expected = []
    for page, url, html in PAGES:
        data = (html or "").encode()
        top = max((p for p, _, h in PAGES if h == html and p is not None), default=None)
        again = len(data) >= 1000 and top is not None and page != top
        uri = url and url.replace("\r", "%0D").replace("\n", "%0A")
        expected.append((page, uri, "revisit" if again else "response", f"<urn:page:{top}>" if again else None,
                         hashlib.sha1(data).hexdigest(), len(data), None if again else data))
    own = [(r.page_id, r.target_uri, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes, r.payload and bytes(r.payload) or (None if r.payload is None else b"")) for r in rows]
    assert sorted(own, key=repr) == sorted(expected, key=repr)


def test_predicates_are_decided_at_the_header(spark, archive):
    df = spark.read.format("warc").load(archive)
    found = df.filter("record_type = 'revisit' and target_uri like 'http://a/%'")
    assert found.count() == 3
    reader = warc.WarcReader({"path": archive}, df.schema)
    from pyspark.sql.datasource import EqualTo, GreaterThan

    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_bytes",), 5)]))
    assert [type(x) for x in left] == [GreaterThan] and reader.tests == [("record_type", "in", {"revisit"})]
    assert spark.read.format("warc").option("payload", "false").load(archive).columns == df.columns[:-1]


def test_unwanted_payloads_are_not_read():
    class Counting(io.BytesIO):
        taken = 0

        def read(self, *a):
            out = super().read(*a)
            Counting.taken += len(out)
            return out

    import os

    big = warc.record({"record_type": "response", "payload": os.urandom(2_000_000).hex()}, "2020")
    small = warc.record({"record_type": "resource", "payload": "small"}, "2020")
    file = Counting(warc.member(big) + warc.member(small) + warc.member(big))
    found = list(warc.records(file, lambda h: h["record_type"] == "resource", True))
    assert [p for _, p in found] == [b"small"] and Counting.taken < 20_000


@pytest.mark.parametrize("packing", ["plain", "one member", "plain members"])
def test_foreign_archives(packing, spark, tmp_path):
    records = [
        b"WARC/1.0\r\nwarc-type: warcinfo\r\nContent-Length: 4\r\n\r\ninfo\r\n\r\n",
        b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://a/\r\n  b\r\nContent-Type: application/http; msgtype=response\r\n"
        b"Content-Length: 30\r\n\r\nHTTP/1.1 200 OK\r\nA: b\r\n\r\nhello\r\n\r\n",
    ]
    data = b"".join(records) if packing == "plain" else gzip.compress(b"".join(records)) if packing == "one member" else b"".join(map(gzip.compress, records))
    name = tmp_path / ("x.warc" if packing == "plain" else "x.warc.gz")
    name.write_bytes(data)
    warc.register(spark)
    rows = spark.read.format("warc").load(str(tmp_path)).collect()
    assert [(r.record_type, r.target_uri, bytes(r.payload)) for r in rows] == [("warcinfo", None, b"info"), ("response", "http://a/ b", b"hello")]


def test_only_committed_files_are_read(spark, archive):
    before = spark.read.format("warc").load(archive).count()
    with open(f"{archive}/part-99999-lost-0.warc.gz", "wb") as f:
        f.write(warc.member(warc.record({"record_type": "response", "payload": "x"}, "2020")))
    assert spark.read.format("warc").load(archive).count() == before


def test_empty(spark, tmp_path):
    warc.register(spark)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.page_records(pages).write.format("warc").mode("append").save(str(tmp_path / "e"))
    assert spark.read.format("warc").load(str(tmp_path / "e")).count() == 0


def test_no_archive_and_single_files(spark, archive, tmp_path):
    warc.register(spark)
    (tmp_path / "none").mkdir()
    assert spark.read.format("warc").load(str(tmp_path / "none")).count() == 0
    name = tmp_path / "one.warc.gz"
    name.write_bytes(b"".join(warc.member(warc.record({"record_type": "resource", "payload": str(i)}, "2020")) for i in range(3)))
    rows = spark.read.format("warc").load(str(name)).collect()
    assert sorted(bytes(r.payload) for r in rows) == [b"0", b"1", b"2"]


@pytest.mark.parametrize("length", ["abc", "-5", "", "1e3", "\u0663"])
def test_records_of_malformed_length_have_no_payload(length, spark, tmp_path):
    record = f"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: {length}\r\n\r\nbody\r\n\r\n"
    after = "WARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    (tmp_path / "x.warc").write_bytes((record + after).encode())
    warc.register(spark)
    rows = spark.read.format("warc").load(str(tmp_path)).collect()
    assert [(r.record_type, bytes(r.payload)) for r in rows] == [("resource", b""), ("metadata", b"ok")]
