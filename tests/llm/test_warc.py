from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.errors import PySparkException

from batchlake.llm import warc

BIG, OTHER = "<p>é</p>" * 200, "<b>x</b>" * 300
ROWS = [
    (1, "http://a/1", BIG), (5, "http://a/5", BIG), (3, "http://a/3\r\nX: y", BIG), (2, None, "small"), (4, "http://a/4", "small"),
    (6, "http://a/6", None), (7, "http://a/7", ""), (8, "http://b/8", OTHER), (8, "http://b/8", OTHER), (None, "http://n", BIG),
]


@pytest.fixture(scope="module")
def path(spark):
    pages = spark.createDataFrame([(*r, "clash") for r in ROWS], "page_id long, url string, html string, digest string")
    return warc.write_archive(pages)


def test_round_trip(spark, path):
    got = warc.read_archive(spark, path).collect()
    assert len(got) == len(ROWS)
    payloads = sorted((r.page_id or 0, bytes(r.payload)) for r in got)
    assert payloads == sorted((i or 0, (h or "").encode()) for i, _, h in ROWS)
    assert all(r.payload_digest == hashlib.sha1(r.payload).hexdigest() for r in got)
    kinds = sorted(((r.page_id or 0), r.record_type, r.refers_to or 0) for r in got)
    assert kinds == [
        (0, "revisit", 5), (1, "revisit", 5), (2, "response", 0), (3, "revisit", 5), (4, "response", 0), (5, "response", 0),
        (6, "response", 0), (7, "response", 0), (8, "response", 0), (8, "revisit", 8),
    ]
    assert spark.read.parquet(f"{path}/payloads").count() == 4


def test_records_are_warc(spark, path):
    for r in warc.original_records(warc.read_archive(spark, path)).collect():
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1" and all(re.match(r"[\w-]+: ", x) for x in lines[1:])
        fields = dict(x.split(": ", 1) for x in lines[1:])
        assert block.endswith(b"\r\n\r\n") and len(block) - 4 == int(fields["Content-Length"])
        assert ("WARC-Refers-To" in fields) == (fields["WARC-Type"] == "revisit")


def test_a_changed_payload_is_noticed(spark, path):
    broken = f"{path}-broken"
    spark.read.parquet(f"{path}/headers").write.parquet(f"{broken}/headers")
    payloads = spark.read.parquet(f"{path}/payloads")
    payloads.selectExpr("digest", "concat(payload, cast('!' as binary)) AS payload").write.parquet(f"{broken}/payloads")
    with pytest.raises(PySparkException):
        warc.read_archive(spark, broken).collect()


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archive(spark, warc.write_archive(none)).count() == 0
