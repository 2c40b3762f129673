"""WARC archives of pages, with repeated payloads resolved to revisit records.

``write_archive`` writes one response record per page. ``read_archive`` parses archives by
their Content-Length fields. ``resolve`` shuffles only headers: those with one payload digest
meet in a partial aggregation that picks the original, and a join hands it to the others.
``write_deduplicated`` writes fresh headers for all, and payloads for responses only.

Files are gzip-compressed text written by Spark, so they go to any file system Spark writes
to, and a failed task leaves nothing behind; a record ends with two line breaks, which are
the line separator of that writer. A reader holds one compressed file, which
``records_per_file`` bounds, and inflates it piece by piece, a record at a time.

Defined results: a null html is an empty payload; a null page_id or url is left out of the
headers and read back as null, and a null page_id counts as the smallest; line breaks,
tabs, blanks and NULs in a url are percent-encoded; of equal payloads with equal page_ids (repeated rows) one is
the response; an empty table gives an archive without records.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dcflow.session import make_dirs, scratch_path

END = "\r\n\r\n"
MIN_BYTES = 1000
RECORDS_PER_FILE = 4000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = ("record_id string, type string, page_id long, uri string, date string, digest string, "
           "payload_bytes long, refers_to long")


def _lines(*parts: tuple[str, Column | str]) -> Column:
    """Header lines; a null value leaves its line out."""
    return F.concat_ws("\r\n", F.lit("WARC/1.1"), *[
        F.concat(F.lit(f"{name}: "), v if isinstance(v, Column) else F.lit(v)) for name, v in parts])


def _http(n: Column) -> Column:
    return F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), n.cast("string"), F.lit(END))


def _record(kind: str, body: Column, **fields: Column | str) -> Column:
    """One record without the two line breaks that end it."""
    names = {"record_id": "WARC-Record-ID", "date": "WARC-Date", "uri": "WARC-Target-URI", "digest": "WARC-Payload-Digest",
             "refers_id": "WARC-Refers-To", "refers_uri": "WARC-Refers-To-Target-URI", "refers_date": "WARC-Refers-To-Date",
             "profile": "WARC-Profile", "page_id": "X-Page-Id", "refers_to": "X-Refers-To-Page-Id"}
    head = _lines(("WARC-Type", kind), *[(names[k], v) for k, v in fields.items()],
                  ("Content-Type", "application/http; msgtype=response"), ("Content-Length", F.octet_length(body).cast("string")))
    return F.concat(head, F.lit(END), body)


def _write(values: DataFrame, path: str, records_per_file: int) -> None:
    make_dirs(values.sparkSession, path)
    (values.write.mode("append").option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def write_archive(pages: DataFrame, path: str, date: str = DATE, records_per_file: int = RECORDS_PER_FILE) -> None:
    """One response record per row of ``pages`` (page_id, url, html)."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.col("url").cast("string")
    for c in "\r\n\t \x00":
        url = F.replace(url, F.lit(c), F.lit(f"%{ord(c):02X}"))
    record = _record("response", F.concat(_http(F.octet_length(html)), html),
                     record_id=F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")), date=date, uri=url,
                     digest=F.concat(F.lit("sha1:"), F.sha1(F.encode(html, "UTF-8"))), page_id=F.col("page_id").cast("bigint").cast("string"))
    _write(pages.select(record.alias("value")), path, records_per_file)


def inflate(data: bytes, step: int = 4 << 20) -> Iterator[bytes]:
    """A gzip file's content in pieces of at most ``step`` bytes."""
    while data:
        member = zlib.decompressobj(47)
        while not member.eof:
            piece = member.decompress(data, step)
            data = member.unconsumed_tail
            if not piece and not data and not member.eof:
                raise ValueError("the archive ends inside a compressed block")
            yield piece
        data = member.unused_data


def parse_records(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(headers, HTTP header block, payload) of each record of an uncompressed archive that
    comes in pieces; one record and one piece are held at a time."""
    source, held = iter(pieces), bytearray()

    def more() -> bool:
        piece = next(source, None)
        held.extend(piece or b"")
        return piece is not None

    while held or more():
        while (stop := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held:
                    raise ValueError("the archive ends inside a header")
                return
        head = dict(line.split(": ", 1) for line in held[:stop].decode("utf-8", "replace").split("\r\n")[1:])
        end = stop + 4 + int(head["Content-Length"])
        while len(held) < end + 4 and more():
            pass
        if len(held) < end:
            raise ValueError("the archive ends inside a record")
        http, _, payload = bytes(held[stop + 4:end]).partition(b"\r\n\r\n")
        del held[:end + 4]
        yield head, http, payload


def read_archive(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The headers of all records and, if asked for, the payloads. Size and digest are those
    of the full payload: measured on a response, told by the headers of a revisit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()] + [pa.binary()] * payloads
        names = [x.split()[0] for x in HEADERS.split(", ")] + ["payload"] * payloads
        for b in batches:
            for content in b.column(0):
                rows, size = [], 0
                for head, http, payload in parse_records(inflate(content.as_py())):
                    whole = head["WARC-Type"] == "response"
                    n = len(payload) if whole else int(http.rpartition(b"Content-Length: ")[2])
                    digest = hashlib.sha1(payload).hexdigest() if whole else head["WARC-Payload-Digest"].removeprefix("sha1:")
                    number = lambda k: int(head[k]) if k in head else None  # noqa: E731, B023
                    rows.append((head["WARC-Record-ID"], head["WARC-Type"], number("X-Page-Id"), head.get("WARC-Target-URI"), head["WARC-Date"], digest,
                                 n, number("X-Refers-To-Page-Id"), *[payload] * payloads))
                    size += n
                    if size > 16 << 20:
                        yield table(rows)
                        rows, size = [], 0
                if rows:
                    yield table(rows)

    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option(
        "pathGlobFilter", "*.gz").load(path).where("length > 0")
    return files.select("content").mapInArrow(run, HEADERS + ", payload binary" * payloads)


def resolve(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``headers`` and, for those that repeat another record's payload, its header as ``first``:
    of equal payloads of at least ``min_bytes`` bytes the largest page_id is the original."""
    first = (headers.where(F.col("payload_bytes") >= min_bytes).groupBy("digest", "payload_bytes")
             .agg(F.max(F.struct("page_id", "record_id", "uri", "date")).alias("first"), F.count("*").alias("n"))
             .where("n > 1").drop("n"))
    found = headers.join(first, ["digest", "payload_bytes"], "left")
    return found.withColumn("first", F.when(F.col("first.record_id") != F.col("record_id"), F.col("first")))


def _fresh(record_id: Column) -> Column:
    """The new id of a rewritten record, the same wherever it is derived."""
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(
        F.substring(F.sha1(record_id.cast("binary")), 1, 32), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"), F.lit(">"))


def write_deduplicated(records: DataFrame, decided: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """A new archive: responses with their payloads, revisits with headers only. ``records``
    (record_id, payload) meets ``decided`` by record id, the only time payloads are shuffled."""
    joined = decided.join(records.select("record_id", F.col("payload").cast("string").alias("html")), "record_id")
    page = F.col("page_id").cast("string")
    base = {"record_id": _fresh(F.col("record_id")), "date": F.col("date"), "uri": F.col("uri"),
            "digest": F.concat(F.lit("sha1:"), F.col("digest")), "page_id": page}
    response = _record("response", F.concat(_http(F.col("payload_bytes")), F.col("html")), **base)
    revisit = _record("revisit", _http(F.col("payload_bytes")), **base, profile=PROFILE, refers_id=_fresh(F.col("first.record_id")),
                      refers_uri=F.col("first.uri"), refers_date=F.col("first.date"), refers_to=F.col("first.page_id").cast("string"))
    _write(joined.select(F.when(F.col("first").isNull(), response).otherwise(revisit).alias("value")), path, records_per_file)


def deduplicate(spark: SparkSession, pages: DataFrame, path: str | None = None, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write ``pages`` to an archive, resolve its repeated payloads, write the deduplicated
    archive to ``path`` (a fresh scratch folder if not given), and read that one's headers."""
    raw, out = scratch_path(spark, "warc-raw"), path or scratch_path(spark, "warc")
    write_archive(pages, raw)
    write_deduplicated(read_archive(spark, raw, payloads=True), resolve(read_archive(spark, raw), min_bytes), out)
    return read_archive(spark, out)
