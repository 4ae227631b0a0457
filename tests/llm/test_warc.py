import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc

PAGES = [(1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (2, "http://a/2b", "<p>same</p>"), (3, None, None),
         (4, "http://a/WARC/1.1", ""), (5, "http://a/5", "ünï " * 60_000), (6, "x\r\ny", "a WARC/1.1\r\nWARC-Type: response\r\n\r\nWARC/1.1\r\n"),
         (None, "http://a/n", "<p>same</p>"), (None, "http://a/m", "alone"), (None, None, "alone"), (7, "http://a/7", "0\r\n\r\n"), (8, "u", "ünï " * 60_000)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.mark.parametrize("segment_bytes", [warc.SEGMENT_BYTES, 1000, 37])
def test_round_trip(spark, pages, folder, segment_bytes):
    warc.write_archives(pages, f"{folder}/archives", "page_id", "url", "html", segment_bytes)
    found = warc.read_archives(spark, f"{folder}/archives")
    got = sorted((r["id"] or "", r["target"] or "", r["type"], r["digest"], None if r["payload"] is None else bytes(r["payload"]).decode())
                 for r in found.collect())
    want = []
    for id, url, html in PAGES:
        others = [i for i, _, h in PAGES if (h or "") == (html or "") and i is not None]
        revisit = bool(others) and id != max(others)
        target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
        want.append((str(id or ""), target, "revisit" if revisit else "response", digest(html), None if revisit else html or ""))
    assert got == sorted(want)
    sizes = {(r["id"], r["target"]): (r["payload_bytes"], r["refers_to"]) for r in warc.captures(found).collect()}
    assert sizes[("5", "http://a/5")] == (len("ünï " * 60_000) + 120_000, "8")
    assert sizes[(None, "http://a/n")] == (11, "2") and sizes[("2", "http://a/2")] == (11, None)


def test_damage_is_found(spark, pages, folder):
    warc.write_archives(pages.where("page_id = 8").repartition(1), f"{folder}/archives", "page_id", "url", "html", 1000)
    records = warc.read_records(spark, f"{folder}/archives")
    assert warc.decode(warc.reassemble(records)).where("fault IS NULL").count() == 1
    lost = warc.decode(warc.reassemble(records.where("segment IS NULL OR segment <> 5")))
    assert lost.first()["fault"] == "segment missing"
    cut = records.withColumn("block", F.when(F.col("segment") == 5, F.expr("substring(block, 1, 900)")).otherwise(F.col("block")))
    assert warc.decode(warc.reassemble(cut)).first()["fault"] == "total length"
    last = records.withColumn("total", F.lit(None).cast("long"))
    assert warc.reassemble(last).first()["fault"] == "segment missing"


def test_damaged_records_fail_or_go(spark, folder):
    text = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: 99\r\n\r\nshort\r\n\r\n"
    spark.createDataFrame([(text,)], "value string").write.text(f"{folder}/archives")
    assert warc.read_archives(spark, f"{folder}/archives", damaged="drop").count() == 0
    with pytest.raises(Exception, match="damaged record"):
        warc.read_archives(spark, f"{folder}/archives").collect()


def test_chunks():
    for payload in (b"", b"a", b"x" * 40_000, b"WARC/1.1\r\n" * 9, b"\r\n0\r\n\r\n"):
        framed = warc.chunked(payload, 1000)
        assert warc.unchunked(framed) == payload and b"WARC/1.1\r\n" not in framed
    assert warc.unchunked(b"3;name=v\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc")


def test_empty_table(spark, pages, folder):
    warc.write_archives(pages.limit(0), f"{folder}/archives", "page_id", "url", "html")
    assert warc.read_archives(spark, f"{folder}/archives").count() == 0
