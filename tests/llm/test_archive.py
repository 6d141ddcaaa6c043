import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tallyfold.llm import archive
from tallyfold.session import scratch_path

BIG = "<p>" + "é" * 60 + "</p>"
PAGES = [
    (1, "http://a.test/1", "small"), (2, "http://a.test/2", "small"), (5, "http://a.test/5", BIG), (3, None, BIG),
    (9, "http://a.test/9\r\nX: y", BIG), (4, "http://a.test/4", None), (6, "http://a.test/6", ""), (3, None, BIG),
    (None, "http://a.test/n", BIG), (None, None, "only here" * 20),
]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'x' AS digest", "'y' AS payload")


def test_rules(pages):
    rows = archive.round_trip(pages).collect()
    assert len(rows) == len(PAGES)
    for r in rows:
        assert len(r.payload_digest) == 64
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in rows)
    size = len(BIG.encode())
    assert got == [
        (0, size, "revisit", 3), (0, 180, "response", 0), (1, 5, "response", 0), (2, 5, "response", 0), (3, size, "response", 0),
        (3, size, "response", 0), (4, 0, "response", 0), (5, size, "revisit", 3), (6, 0, "response", 0), (9, size, "revisit", 3),
    ]
    assert archive.round_trip(pages.limit(0)).count() == 0


def test_payloads_are_stored_once_and_records_come_back(spark, pages):
    path = scratch_path(spark, "archive-test")
    archive.write_archive(pages, path)
    stored = spark.read.parquet(f"{path}/payloads").collect()
    assert len(stored) == len({r.digest for r in stored}) == len({h or "" for _, _, h in PAGES})
    for r in archive.read_records(spark, path).collect():
        head = bytes(r.header).decode()
        assert head.startswith("WARC/1.1\r\nWARC-Type: ") and head.endswith("\r\n\r\n") and "\r\nX: y" not in head
        assert hashlib.sha256(bytes(r.payload)).hexdigest() in head


def test_a_damaged_payload_is_an_error(spark, pages):
    path = scratch_path(spark, "archive-test")
    archive.write_archive(pages, path)
    other = F.lit(bytearray(zlib.compress(b"zz"))).alias("packed")
    spark.read.parquet(f"{path}/payloads").select("digest", other).write.parquet(f"{path}/broken/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}/broken/headers")
    with pytest.raises(Exception, match="damaged payload"):
        archive.read_records(spark, f"{path}/broken").collect()
    spark.read.parquet(f"{path}/payloads").limit(0).write.parquet(f"{path}/lost/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}/lost/headers")
    with pytest.raises(Exception, match="missing payload"):
        archive.read_records(spark, f"{path}/lost").collect()


def parsed(data: bytes):
    """(fields, block) of one record, by its own lengths; nothing may be left over."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    assert first == "WARC/1.1"
    fields = [line.split(": ", 1) for line in lines]
    assert all(len(f) == 2 for f in fields) and len({k for k, _ in fields}) == len(fields)
    fields = dict(fields)
    size = int(fields["Content-Length"])
    assert rest[size:] == b"\r\n\r\n"
    return fields, rest[:size]


def test_every_record_is_read_by_its_own_lengths(spark, pages):
    long = spark.range(1).selectExpr("77L AS page_id", "'u' AS url", "repeat('long text \r\n\r\n', 300000) AS html", "'x' AS digest", "'y' AS payload")
    path = scratch_path(spark, "archive-test")
    archive.write_archive(pages.union(long), path)
    given = {(i, h or "") for i, _, h in PAGES} | {(77, "long text \r\n\r\n" * 300000)}
    seen, ids = set(), []
    for r in archive.read_records(spark, path).collect():
        fields, block = parsed(bytes(r.record))
        ids.append(fields["WARC-Record-ID"])
        if fields["WARC-Type"] == "revisit":
            assert block == b"" and fields["WARC-Profile"] == archive.PROFILE
            assert fields["WARC-Refers-To-Page-ID"] == "3" and fields["WARC-Refers-To-Target-URI"] == ""
        else:
            assert block == bytes(r.payload) and "WARC-Profile" not in fields
        assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(bytes(r.payload)).hexdigest()
        seen.add((r.page_id, bytes(r.payload).decode()))
    assert seen == given and len(set(ids)) == len(ids) == len(PAGES) + 1


def test_page_ids_keep_their_type(spark, pages):
    rows = archive.round_trip(pages.selectExpr("concat('p', page_id) AS page_id", "url", "html"))
    assert dict(rows.dtypes)["refers_to"] == "string"
    assert {r.refers_to for r in rows.collect()} == {None, "p3"}
