import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from ebbline.llm.warc import read_archive, read_records, write_archive
from ebbline.workspace import new_path

PAGES = [
    (1, "http://a", "same"), (5, "http://b", "same"), (5, "http://b", "same"), (None, "http://c", "same"), (2, None, None),
    (3, "bad\r\nWARC-Type: revisit", ""), (4, "http://d", "WARC/1.1\r\nWARC-Type: revisit\r\n\r\nä"), (6, "http://e", "x" * 200_000),
]


def archive(spark, pages=PAGES, **settings):
    path = new_path(spark, "warc-test")
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns(
        {c: F.lit(1) for c in ("payload", "address", "header", "copies")}
    )
    write_archive(table, path, **settings)
    return path


def test_result(spark):
    found = sorted((tuple(r)[:6] for r in read_archive(spark, archive(spark)).collect()), key=str)
    wanted = []
    for page_id, url, html in PAGES:
        payload = (html or "").encode()
        first = max(i for i, _, h in PAGES if i is not None and (h or "") == (html or ""))
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        revisit = page_id != first
        url = url and url.replace("\r", "%0D").replace("\n", "%0A")
        wanted.append((page_id, url, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    assert found == sorted(wanted, key=str)


def test_payloads_once_and_records_whole(spark):
    path = archive(spark)
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for *_, h in PAGES})
    for r in read_records(spark, path).collect():
        block = bytes(r.block)
        assert bytes(r.record) == r.header.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
        fields = dict(line.split(": ", 1) for line in r.header.split("\r\n")[1:])
        assert r.header.startswith("WARC/1.1\r\n") and int(fields["Content-Length"]) == len(block)
        assert fields["WARC-Type"] == ("revisit" if "WARC-Refers-To" in fields else "response")


def test_small_payloads_are_responses(spark):
    found = read_archive(spark, archive(spark, least_bytes=5)).collect()
    assert {r.record_type for r in found} == {"response"}


def test_a_header_that_tells_another_payload_shows(spark):
    path = archive(spark)
    for name, value in (("Content-Length", "1"), ("WARC-Payload-Digest", "sha1:A")):
        broken = new_path(spark, "warc-broken")
        spark.read.parquet(f"{path}/payloads").write.parquet(f"{broken}/payloads")
        told = F.regexp_replace("header", f"{name}: [^\r]*", f"{name}: {value}")
        spark.read.parquet(f"{path}/headers").withColumn("header", told).write.parquet(f"{broken}/headers")
        with pytest.raises(Exception, match="header and payload differ"):
            read_archive(spark, broken).collect()


def test_record_digests(spark):
    path = archive(spark)
    records = sorted(hashlib.sha256(bytes(r.record)).hexdigest() for r in read_records(spark, path).collect())
    assert sorted(r.record_sha256 for r in read_archive(spark, path).collect()) == records


def test_damage_shows(spark):
    path = archive(spark)
    broken = new_path(spark, "warc-broken")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{broken}/headers")
    stored = spark.read.parquet(f"{path}/payloads")
    stored.withColumn("payload", F.concat("payload", F.lit(b"!"))).write.parquet(f"{broken}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        read_archive(spark, broken).collect()


def test_empty_table(spark):
    assert read_archive(spark, archive(spark, pages=[])).count() == 0
