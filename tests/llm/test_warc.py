import hashlib

import pytest

from newsroster.llm import warc
from newsroster.session import scratch_path

FAKE = (warc.MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\n"
        "abcde\r\n\r\n")
PAGES = [
    (1, "http://é", warc.MAGIC * 3), (2, "u\r\n", FAKE * 3), (3, None, None), (4, "x", ""),
    (5, "x", "é" * 200), (6, "y", "é" * 200), (7, "y", "short"), (8, "y", "short"),
    (9, "z", "a" + FAKE + warc.MAGIC), (10, "z", warc.MAGIC), (11, "z", "q" * 3000 + FAKE + "w" * 2000),
    (12, "r", "q" * 3000 + FAKE + "w" * 2000), (13, None, "e" * 100)]
SCHEMA = "page_id long, url string, html string"


def expected(pages):
    for i, _, html in pages:
        raw = (html or "").encode()
        first = min(p for p, _, h in pages if (h or "").encode() == raw)
        revisit = len(raw) >= 100 and first != i
        yield (i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response",
               first if revisit else None)


@pytest.mark.parametrize("split", ["600", "134217728"])
def test_round_trip(spark, split):
    path = scratch_path(spark, "warc-test")
    pages = spark.createDataFrame(PAGES, SCHEMA).withColumn("__key", __import__(
        "pyspark").sql.functions.lit("clash")).coalesce(2)
    warc.write_warc(pages, path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = [tuple(r) for r in warc.digest(warc.read_warc(spark, path)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == sorted(expected(PAGES))


def test_broken_chains_and_repeated_rows(spark):
    path = scratch_path(spark, "warc-test")
    rows = [(1, "u", "same" * 50), (1, "u", "same" * 50), (None, None, "same" * 50)]
    warc.write_warc(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)
    got = warc.digest(warc.read_warc(spark, path)).collect()
    assert sorted((r.page_id or 0, r.record_type) for r in got) == [
        (0, "revisit"), (1, "response"), (1, "response")]
    bad = scratch_path(spark, "warc-bad")
    text = FAKE + warc.MAGIC + "WARC-Type: response\r\nContent-Length: 9999\r\n\r\nxy\r\n\r\n" + FAKE
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(bad)
    records = warc.read_warc(spark, bad).collect()
    assert [r.record_id for r in records][:1] == ["<urn:page:99>"] and len(records) <= 2


def test_empty(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_warc(spark.createDataFrame([], SCHEMA), path)
    assert warc.digest(warc.read_warc(spark, path)).collect() == []


def test_repeated_ids_with_other_payloads(spark):
    """A revisit reports the bytes of the payload it names, not of another one under the same id."""
    rows = [(1, "u", "a" * 200), (1, "u", "b" * 500), (2, "v", "a" * 200)]
    path = scratch_path(spark, "warc-test")
    warc.write_warc(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)
    got = [tuple(r) for r in warc.digest(warc.read_warc(spark, path)).collect()]
    assert sorted(got) == sorted(expected(rows))
