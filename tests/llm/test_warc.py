import gzip
import hashlib
import io
import os

import pytest
from pyspark.sql import functions as F

from mensula.llm import warc
from mensula.llm.common import table
from mensula.sizing import scratch_path


def plain(rows):
    first = {}
    for k, html in rows:
        body = (html or "").encode()
        if len(body) >= 100 and k is not None:
            first[body] = min(k, first.get(body, k))
    out = []
    for k, html in rows:
        body = (html or "").encode()
        again = len(body) >= 100 and body in first and first[body] != k
        out.append((k, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[body] if again else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_all_pages(spark, sf):
    pages = table(spark, sf, "pages")
    assert got(warc.archive(pages)) == plain([(r.page_id, r.html) for r in pages.collect()])


@pytest.mark.parametrize("compressed", [False, True])
@pytest.mark.parametrize("broadcast", [True, False])
def test_edges(spark, compressed, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(warc, "small_side", lambda df: df)
    long = "é<p>\r\n\r\nWARC/1.1\r\n" * 60_000
    rows = [
        (5, "u5", "x" * 99), (4, "u4", "x" * 99), (3, "u3", "y" * 100), (2, "u2", "y" * 100), (2, "u2", "y" * 100), (None, "u", "y" * 100),
        (None, None, "z" * 200), (9, "http://a b\r\nX: 1", None), (8, "", ""), (7, "u7", long), (6, "u6", long), (1, "u1", "WARC/1.1\r\n\r\n"),
    ]
    df = spark.createDataFrame([(*r, "q", 0) for r in rows], "page_id long, url string, html string, payload string, first int")
    back = warc.archive(df, compressed=compressed)
    assert got(back) == plain([(k, h) for k, _, h in rows])
    assert {r.page_id: bytes(r.payload).decode() for r in back.where("record_type = 'response' and page_id in (2, 6, 9)").collect()} == {2: "y" * 100, 6: long, 9: ""}
    assert warc.archive(df.limit(0), compressed=compressed).count() == 0


def test_header_conditions_skip_payloads(spark):
    path = scratch_path(spark, "warc")
    warc.register(spark)
    df = spark.createDataFrame([(i, f"http://h{i % 3}/p", "body" * 50 * (i + 1)) for i in range(9)], "page_id long, url string, html string")
    warc.page_records(df).repartition(3).write.format("warc").option("file_mb", 0.001).mode("append").save(path)
    read = spark.read.format("warc").load(path)
    assert read.where("target_uri = 'http://h1/p' and payload_length > 500").count() == 2
    assert read.where("record_id in ('<urn:page:3>', '<urn:page:77>')").select(F.col("payload").cast("string")).first()[0] == "body" * 200
    assert spark.read.format("warc").option("payload", "false").load(path).where("payload is not null").count() == 0
    assert spark.read.format("warc").option("partition_mb", 0.001).load(path).rdd.getNumPartitions() > 3

    class Watched(io.BytesIO):
        def read(self, n=-1):
            taken.append(n)
            return super().read(n)

    taken = []
    data = b"".join(warc.record({"record_id": f"<urn:page:{i}>", "record_type": t, "payload": b"p" * 1_000}) for i, t in enumerate(["response", "request"]))
    rows = list(warc.records(Watched(data), [warc.EqualTo(("record_type",), "request")], True))
    assert [r["record_id"] for r in rows] == ["<urn:page:1>"] and taken == [1_000]


def test_files_outside_the_manifest_are_not_read(spark):
    path = scratch_path(spark, "warc")
    warc.register(spark)
    df = spark.createDataFrame([(1, "u", "a" * 200)], "page_id long, url string, html string")
    warc.page_records(df).write.format("warc").mode("append").save(path)
    local = path.removeprefix("file:")
    with open(os.path.join(local, "left-behind.warc"), "wb") as out:
        out.write(b"WARC/1.1\r\nWARC-Ty")  # a broken attempt
    assert spark.read.format("warc").load(path).count() == 1
    warc.page_records(df).write.format("warc").mode("append").save(path)
    assert spark.read.format("warc").load(path).count() == 2


def test_archives_in_nested_folders(spark, tmp_path):
    warc.register(spark)
    schema = "page_id long, url string, html string"
    for i, folder in enumerate(("", "/below", "/below/deeper")):
        df = spark.createDataFrame([(i, f"http://x/{i}", f"page {i}")], schema)
        warc.page_records(df).write.format("warc").mode("append").save(f"{tmp_path}/a{folder}")
    os.makedirs(f"{tmp_path}/a/other")
    with open(f"{tmp_path}/a/other/lost.warc", "wb") as lost:
        lost.write(b"not listed")
    read = lambda folder: spark.read.format("warc").load(f"{tmp_path}/a{folder}").count()
    assert [read(f) for f in ("", "/below", "/below/deeper")] == [3, 2, 1]


def test_archives_of_others(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\nhello"
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    page = b"WARC/1.0\r\nwarc-type: response\r\nContent-Type: application/http\r\nLong: a\r\n b\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    with open(tmp_path / "a.warc.gz", "wb") as out:
        out.write(gzip.compress(info) + gzip.compress(page))
    warc.register(spark)
    rows = {r.record_type: r for r in spark.read.format("warc").load(str(tmp_path)).collect()}
    assert bytes(rows["response"].payload) == b"hello" and rows["response"].payload_length == 5 and rows["response"].headers["Long"] == "a b"
    assert bytes(rows["warcinfo"].payload) == b"abcd"
