import base64
import gzip
import hashlib
import tempfile

import pytest
from pyspark.sql import functions as F

from rowtide.llm.warc import archive_and_read, base32_sha1, coalesced, digest_of, read_records, write_archives


def folder():
    return "file://" + tempfile.mkdtemp(prefix="warc-")


def test_digests(spark):
    texts = ["", "a", "ünïcode" * 99]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(digest_of(F.col("t").cast("binary"))).collect()]
    assert got == [base32_sha1(t.encode()) for t in texts]
    assert got[1] == base64.b32encode(hashlib.sha1(b"a").digest()).decode()


def test_ranges_are_joined_up_to_a_gap_and_a_length():
    spans = [(0, 10), (10, 5), (20, 5), (100, 5), (105, 500), (605, 1)]
    assert list(coalesced(spans, 5, 300)) == [(0, 25, [0, 1, 2]), (100, 5, [3]), (105, 500, [4]), (605, 1, [5])]
    assert list(coalesced([], 5, 300)) == []
    assert sum(len(m) for _, _, m in coalesced(spans, 0, 1)) == 6


def test_round_trip_of_payloads(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").repartition(3)
    index = write_archives(pages, folder())
    assert index.count() == pages.count()
    html = {r.page_id: r.html for r in pages.collect()}
    read = read_records(index, gap=100, most=5_000).collect()
    assert {int(r.page): r.payload.decode() for r in read if r.record_type == "response"}.items() <= html.items()
    some = index.filter(F.col("page").cast("int") % 3 == 0)
    assert {int(r.page) for r in read_records(some).collect()} == {i for i in html if i % 3 == 0}


def test_archives_are_gzip_members_of_warc_records(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").limit(20)
    rows = write_archives(pages, folder()).collect()
    for file in {r.file for r in rows}:
        data = open(file.removeprefix("file://"), "rb").read()
        whole = gzip.decompress(data)
        assert whole.count(b"WARC/1.1\r\n") == sum(r.file == file for r in rows)
        for r in (r for r in rows if r.file == file):
            one = gzip.decompress(data[r.offset : r.offset + r.length])
            assert one.startswith(b"WARC/1.1\r\n") and r.digest.encode() in one


def expected(rows, least):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html in rows:
        own = first.get(html or "")
        again = page != own and own is not None and len((html or "").encode()) >= least
        kind, refers = ("revisit", own) if again else ("response", None)
        size = len((html or "").encode())
        out.append((str(page), size, base32_sha1((html or "").encode()), kind, str(refers)))
    return sorted(out)


@pytest.mark.parametrize("least", [0, 5])
def test_revisits_and_odd_rows(spark, least):
    rows = [
        (5, "http://a/", "<p>one</p>"),
        (2, "http://b/", "<p>one</p>"),
        (9, "http://b/\r\nX: y", "<p>one</p>"),
        (2, "http://b/", "<p>one</p>"),
        (7, None, None),
        (8, "http://c/", ""),
        (None, "http://d/", "<p>one</p>"),
        (None, None, "no id at all"),
        (11, "http://e/", "é\r\n\r\nWARC/1.1\r\n" * 200_000),
        (12, "http://f/", "abc"),
        (10, "http://f/", "abc"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.withColumns({c: F.lit("own") for c in ("id", "payload", "digest", "first", "page")})
    got = archive_and_read(pages, least_bytes=least).collect()
    assert expected(rows, least) == sorted(
        (str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got
    )
    assert archive_and_read(pages.limit(0)).count() == 0


def test_archives_are_read_by_many_tasks(spark, tmp_path):
    """However small the index is, what it leads to is read by a task for each file at least."""
    rows = spark.range(0, 400, numPartitions=6).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://a/"), "id").alias("url"), F.repeat(F.col("id").cast("string"), 50).alias("html")
    )
    index = write_archives(rows, f"file://{tmp_path}/warc")
    files = index.select("file").distinct().count()
    read = read_records(index).withColumn("task", F.spark_partition_id())
    assert files > 1 and read.count() == 400 and read.select("task").distinct().count() > 1
