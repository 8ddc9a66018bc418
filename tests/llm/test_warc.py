import gzip
import hashlib

import pytest

from courtline.llm import warc
from courtline.session import scratch_path

BIG = "<p>payload</p>" * 200
HTML = [None, "", "short", "short", BIG, BIG, BIG, "x" * 999, "x" * 999, "y" * 1000, "y" * 1000,
        "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40, "é" * 600, "line\r\n\r\n" * 3 + "\x00", "漢" * 70000]
SCHEMA = "page_id long, url string, html string, digest string, n int, payload string"


def pages(spark, html, ids=None):
    return spark.createDataFrame(
        [(i, None if i == 3 else f"http://host.example/{i}\r\nEvil: 1", h, "d", 1, "p")
         for i, h in zip(ids or range(len(html)), html)], SCHEMA)


def round_trip(spark, df, **options):
    path = warc.write_archives(df, scratch_path(spark, "warc"), **options)
    return warc.assemble(warc.read_archives(spark, path))


def test_round_trip(spark):
    nested = round_trip(spark, pages(spark, HTML))
    rows = {r.page_id: r for r in warc.page_rows(nested).collect()}
    assert len(rows) == len(HTML)
    for i, h in enumerate(HTML):
        data = (h or "").encode()
        same = [j for j, o in enumerate(HTML) if o == h] if len(data) >= 1000 else [i]
        assert (rows[i].payload_bytes, rows[i].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert rows[i].record_type == ("response" if i == max(same) else "revisit")
        assert rows[i].refers_to == (None if i == max(same) else max(same))
    full = {r.metadata.fields["page"]: r for r in nested.collect()}
    assert bytes(full["11"].response.payload).decode() == HTML[11]
    assert full["5"].response.payload is None and full["5"].response.type == "revisit"
    assert all(r.response.digest_ok in (None, True) for r in full.values())
    assert full["4"].request.fields["status"] == "GET http://host.example/4%0D%0AEvil: 1 HTTP/1.1"


def test_many_files_and_gzip_members(spark):
    html = [f"page {i} " * (i % 50) for i in range(300)]
    nested = round_trip(spark, pages(spark, html), archive_bytes=2 * warc.SIZE_CLASSES[0])
    rows = {r.page_id: r.payload_bytes for r in warc.page_rows(nested).collect()}
    assert rows == {i: len(h) for i, h in enumerate(html)}
    record = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 4\r\n\r\na: b\r\n\r\n"
    packed = gzip.compress(record) + gzip.compress(record * 2)
    assert [b for _, b in warc.parse(packed)] == [b"a: b"] * 3
    assert [b for _, b in warc.parse(record * 2)] == [b"a: b"] * 2


def test_archives_are_bounded_by_bytes(spark, monkeypatch):
    """Large pages make more archives, by their size class; none holds more than the bound
    but that of a single larger page."""
    monkeypatch.setattr(warc, "SIZE_CLASSES", (1000, 10_000))
    sizes = [900] * 40 + [9000] * 10 + [60_000] * 3
    html = [f"{i:05d}" + chr(97 + i % 26) * (n - 5) for i, n in enumerate(sizes)]
    path = warc.write_archives(pages(spark, html).coalesce(1), scratch_path(spark, "warc"), archive_bytes=20_000)
    files = [gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").option(
        "pathGlobFilter", "part-*").load(path).collect()]
    held = [[len(b) for h, b in warc.parse(f) if h["warc-type"] == "response"] for f in files]
    assert sorted(map(len, held)) == [1] * 3 + [2] * 5 + [20] * 2
    assert sorted(warc.page_rows(warc.assemble(warc.read_archives(spark, path))).toPandas().payload_bytes) == sorted(sizes)


def test_damaged_archives_are_reported():
    with pytest.raises(ValueError, match="begins with"):
        list(warc.parse(b"not an archive\r\n"))
    with pytest.raises(ValueError, match="within a record"):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 40\r\n\r\nshort"))


def test_empty_null_and_repeated(spark):
    assert round_trip(spark, pages(spark, [])).count() == 0
    rows = warc.page_rows(round_trip(spark, pages(spark, [BIG, BIG, BIG], ids=[None, 5, 5]))).collect()
    assert sorted((r.page_id or -1, r.record_type, r.refers_to) for r in rows) == [
        (-1, "revisit", 5), (5, "response", None), (5, "response", None)]


def test_records_without_partners(spark):
    records = spark.createDataFrame(
        [("response", "r1", None), ("request", "q1", "r1"), ("request", "q0", "r1"), ("metadata", "m", "r9"),
         ("revisit", "r2", None), ("warcinfo", "i", None)], "type string, record_id string, concurrent_to string")
    from pyspark.sql import functions as F
    for f in ("refers_to", "uri", "date", "payload_digest"):
        records = records.withColumn(f, F.lit(None).cast("string"))
    records = records.withColumns({"payload_bytes": F.lit(1), "digest_ok": F.lit(True), "payload": F.lit(None),
                                   "fields": F.lit(None).cast("map<string,string>")})
    rows = {r.record_id: r for r in warc.assemble(records).collect()}
    assert set(rows) == {"r1", "r2"}
    assert rows["r1"].request.record_id == "q0" and rows["r1"].metadata is None and rows["r2"].request is None
