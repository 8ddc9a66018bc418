"""WARC: write captures as archives, read archives back, assemble transactions.

A capture is three records: the request, the response (or a revisit, when an
equal payload is archived elsewhere) and metadata.  Request and metadata name
the response in ``WARC-Concurrent-To``; ``assemble`` joins the three by it into
one nested row.

Archives are written by Spark's text sink with the record separator as its line
separator, so they are committed like any Spark output and executors need no
file of their own; gzip makes each file a legal ``.warc.gz``.  They are read as
binary files and cut by ``Content-Length``, never by looking for a separator.

Defined results: a null payload is empty and a null URL an empty one; line ends
in a URL are percent-encoded; a null page_id is written as an empty number and
read back as null; rows that repeat a page_id share its record ids, and each
comes back as a row of its own; an empty table writes no record and reads back
as no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.llm.common import batches_of, in_python

CRLF = "\r\n"
MIN_REVISIT_BYTES = 1000
#: Payload bytes of an archive at most, unless a single page has more: a reader holds an
#: archive in memory, and Spark reads none of 2 GB or more.
ARCHIVE_BYTES = 256 << 20
#: Bounds of the size classes of pages; each class is written with as many records to a
#: file as ARCHIVE_BYTES allow at its bound.
SIZE_CLASSES = (64 << 10, 1 << 20, 16 << 20, 256 << 20)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _lines(*parts) -> Column:
    """Header lines and the empty line after them; a null line is left out."""
    return F.concat(F.concat_ws(CRLF, *parts), F.lit(CRLF + CRLF))


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def _record(kind: Column, record_id: Column, uri: Column, date: str, content_type: Column,
            block: Column, *more: Column) -> Column:
    return F.concat(_lines(
        F.lit("WARC/1.1"), _header("WARC-Type", kind), _header("WARC-Record-ID", record_id),
        _header("WARC-Date", F.lit(date)), _header("WARC-Target-URI", uri),
        _header("Content-Type", content_type), *more,
        _header("Content-Length", F.octet_length(block).cast("string"))), block)


def captures(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
             min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages with payload, digest and, for revisits, the page they refer to.

    Payloads stay out of the grouping: digests alone are grouped, and the few
    pages that repeat an earlier payload are joined back by page_id.
    """
    pages = pages.select(F.col(page_id).cast("long").alias("page_id"),
                         F.coalesce(F.col(url), F.lit("")).alias("url"),
                         F.coalesce(F.col(html), F.lit("")).alias("payload"))
    light = pages.select("page_id", F.sha1(F.col("payload").cast("binary")).alias("digest"),
                         F.octet_length("payload").alias("n_bytes"))
    large = light.filter(F.col("n_bytes") >= min_bytes)
    first = large.groupBy("digest").agg(F.max("page_id").alias("original"),
                                        F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    repeats = (large.join(first, "digest").filter(~F.coalesce(
        F.col("page_id") == F.col("original"), F.lit(False)) & F.col("original").isNotNull())
        .select(F.col("page_id").alias("repeat_id"), F.col("digest").alias("repeat_digest"),
                "original").distinct())
    pages = pages.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    return pages.join(repeats, F.col("page_id").eqNullSafe(F.col("repeat_id"))
                      & (F.col("digest") == F.col("repeat_digest")), "left").select(
        "page_id", "url", "payload", "digest", F.col("original").alias("refers_to"))


def _urn(page: Column, part: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")),
                    F.lit(f":{part}>"))


def size_class(payload: Column) -> Column:
    """The number of the bounds that a payload's bytes exceed."""
    size = F.coalesce(F.octet_length(payload), F.lit(0))
    return sum((F.when(size > b, 1).otherwise(0) for b in SIZE_CLASSES), F.lit(0))


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES, html: str = "html", **columns) -> str:
    """Three records for each page as gzipped archives under ``path``, bounded by bytes:
    one write for each size class that occurs, most often one."""
    present = [r[0] for r in pages.select(size_class(F.col(html))).distinct().collect()]  # 5 at most
    c = captures(pages, html=html, **columns)
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    host = F.regexp_extract(uri, r"^[A-Za-z]+://([^/?#]*)", 1)
    again = F.col("refers_to").isNotNull()
    c = c.select("page_id", uri.alias("uri"), host.alias("host"), "payload", "digest", "refers_to",
                 again.alias("again"), size_class(F.col("payload")).alias("size_class"))
    page, uri = F.col("page_id"), F.col("uri")
    answer = _urn(page, "response")
    together = _header("WARC-Concurrent-To", answer)
    request = _record(
        F.lit("request"), _urn(page, "request"), uri, date,
        F.lit("application/http; msgtype=request"),
        _lines(F.concat(F.lit("GET "), uri, F.lit(" HTTP/1.1")), _header("Host", F.col("host"))),
        together)
    status = _lines(F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"),
                    _header("Content-Length", F.octet_length("payload").cast("string")))
    response = _record(
        F.when(F.col("again"), "revisit").otherwise("response"), answer, uri, date,
        F.lit("application/http; msgtype=response"),
        F.concat(status, F.when(F.col("again"), "").otherwise(F.col("payload"))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(F.col("again"), _header("WARC-Profile", F.lit(PROFILE))),
        F.when(F.col("again"), _header("WARC-Refers-To", _urn(F.col("refers_to"), "response"))))
    fields = _lines(_header("page", F.coalesce(page.cast("string"), F.lit(""))))
    metadata = _record(F.lit("metadata"), _urn(page, "metadata"), uri, date,
                       F.lit("application/warc-fields"), fields, together)
    for k in sorted(present) or [0]:
        some = c.filter(F.col("size_class") == k) if len(present) > 1 else c
        pages_per_file = max(1, archive_bytes // SIZE_CLASSES[min(k, len(SIZE_CLASSES) - 1)])
        records = some.select(F.explode(F.array(request, response, metadata)).alias("value"))
        (records.write.mode("append").option("lineSep", CRLF + CRLF).option("compression", "gzip")
         .option("maxRecordsPerFile", 3 * pages_per_file if k < len(SIZE_CLASSES) else 3).text(path))
    return path


class _Reader:
    """Lines and byte counts out of a gzipped or plain archive held in memory;
    it is unpacked piece by piece."""

    def __init__(self, data: bytes, step: int = 1 << 20):
        self.data, self.step, self.at, self.out, self.pos = data, step, 0, b"", 0
        self.unpack = zlib.decompressobj(31) if data[:2] == b"\x1f\x8b" else None

    def _more(self) -> bool:
        if self.at >= len(self.data):
            return False
        part = self.data[self.at:self.at + self.step]
        self.at += len(part)
        if self.unpack:
            text = self.unpack.decompress(part)
            while self.unpack.eof and (rest := self.unpack.unused_data):  # the next gzip member
                self.unpack = zlib.decompressobj(31)
                text += self.unpack.decompress(rest)
            if self.unpack.eof:
                self.unpack = zlib.decompressobj(31)
            part = text
        self.out, self.pos = self.out[self.pos:] + part, 0
        return True

    def line(self) -> bytes | None:
        """The next line without its end, or None at the end."""
        while (end := self.out.find(b"\r\n", self.pos)) < 0:
            if not self._more():
                return None
        line, self.pos = self.out[self.pos:end], end + 2
        return line

    def take(self, n: int) -> bytes:
        if len(self.out) - self.pos < n:
            parts, have = [self.out[self.pos:]], len(self.out) - self.pos
            self.out, self.pos = b"", 0
            while have < n:
                if not self._more():
                    raise ValueError("an archive ends within a record")
                parts.append(self.out)
                have += len(self.out)
                self.out = b""
            whole = b"".join(parts)
            self.out, self.pos = whole, 0
        block = self.out[self.pos:self.pos + n]
        self.pos += n
        return block


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record; header names in lower case."""
    r = _Reader(data)
    while (line := r.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"a record begins with {line[:40]!r}")
        headers = {}
        while line := r.line():
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, r.take(int(headers["content-length"]))


def split_http(block: bytes) -> tuple[dict[str, str], bytes]:
    """HTTP headers (with the first line as ``status``) and the body."""
    head, _, body = block.partition(b"\r\n\r\n")
    first, *rest = head.decode("utf-8", "replace").split("\r\n")
    pairs = (x.partition(":") for x in rest)
    return {"status": first} | {k.strip().lower(): v.strip() for k, _, v in pairs}, body


_MAP = pa.map_(pa.string(), pa.string())
_SCHEMA = ("type string, record_id string, concurrent_to string, refers_to string, uri string, "
           "date string, payload_bytes long, payload_digest string, digest_ok boolean, "
           "fields map<string,string>, payload binary")
_ARROW = pa.schema([("type", pa.string()), ("record_id", pa.string()),
                    ("concurrent_to", pa.string()), ("refers_to", pa.string()), ("uri", pa.string()),
                    ("date", pa.string()), ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()), ("digest_ok", pa.bool_()), ("fields", _MAP),
                    ("payload", pa.binary())])


def _row(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind = headers.get("warc-type")
    claimed = headers.get("warc-payload-digest", "").rpartition(":")[2] or None
    n_bytes = digest = ok = payload = None
    fields: dict[str, str] = {}
    if kind in ("request", "response", "revisit"):
        fields, body = split_http(block)
        if kind == "response":
            payload, n_bytes = body, len(body)
            digest = hashlib.sha1(body).hexdigest()
            ok = claimed is None or claimed.lower() == digest
        elif kind == "revisit":
            digest, n_bytes = claimed, int(fields["content-length"])
    elif kind == "metadata":
        for line in block.decode("utf-8", "replace").split("\r\n"):
            name, colon, value = line.partition(":")
            if colon:
                fields[name.strip()] = value.strip()
    return (kind, headers.get("warc-record-id"), headers.get("warc-concurrent-to"),
            headers.get("warc-refers-to"), headers.get("warc-target-uri"), headers.get("warc-date"),
            n_bytes, digest, ok, fields, payload if with_payload else None)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records below ``path``, one row each.  A task holds one archive and
    unpacks it as it goes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                data = content.as_py()
                yield from batches_of((_row(h, x, with_payload) for h, x in parse(data)), _ARROW, 256)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return in_python(files.select("content"), rows, _SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit with its request and
    metadata, joined through concurrent-to identifiers.

    Captures lacking a request or metadata have null there; of several requests
    for one response the one with the smallest record id is taken.
    """
    answers = records.filter(F.col("type").isin("response", "revisit")).select(
        "record_id", F.struct("type", "record_id", "refers_to", "uri", "date", "payload_bytes",
                              "payload_digest", "digest_ok", "fields", "payload").alias("response"))

    def beside(kind: str) -> DataFrame:
        return records.filter((F.col("type") == kind) & F.col("concurrent_to").isNotNull()).groupBy(
            F.col("concurrent_to").alias("record_id")).agg(F.min_by(
                F.struct("record_id", "uri", "date", "fields"), "record_id").alias(kind))

    return (answers.join(beside("request"), "record_id", "left")
            .join(beside("metadata"), "record_id", "left"))


def page_rows(nested: DataFrame) -> DataFrame:
    """The digest columns of captures written by ``write_archives``."""
    number = F.expr("try_cast(nullif(metadata.fields['page'], '') as long)")
    target = F.regexp_extract("response.refers_to", r"^<urn:page:(-?\d+):response>$", 1)
    return nested.select(
        number.alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.when(target != "", target.cast("long")).alias("refers_to"))
