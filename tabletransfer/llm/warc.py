"""WARC archives: writing captures, reading records, and assembling them again."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabletransfer.llm.shared import keep, plain

#: Payloads from this size on are stored once; later captures revisit the first.
LEAST_SHARED = 100
#: Records of a file; a capture has three.
RECORDS_PER_FILE = 3000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
#: Digests that are checked.
ALGORITHMS = ("md5", "sha1", "sha224", "sha256", "sha384", "sha512")

_RECORD = ("record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, date string, "
           "payload_digest string, payload_bytes long, page_id long, payload binary")


def _uuid(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    at = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(digest, a, n) for a, n in at]), F.lit(">"))


def _record(headers: dict[str, Column | str], block: Column) -> Column:
    """One record; a header whose value is null is left out. What ends it is the writer's line end."""
    lines = [F.concat(F.lit(f"{name}: "), F.lit(v) if isinstance(v, str) else v, F.lit(CRLF)) for name, v in headers.items()]
    size = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF))
    return F.concat(F.lit("WARC/1.1" + CRLF), F.concat_ws("", *lines), size, F.lit(CRLF), block)


def captures(pages: DataFrame) -> DataFrame:
    """Rows ``page_id, url, html`` with ``payload_bytes, payload_digest, own_id`` and, where an equal payload of
    at least 100 bytes has a smaller page_id, ``first_id`` of that capture. Null html is empty. Rows that repeat a
    page_id are captures each, the one that is read first counting as smaller; a null page_id counts as the largest."""
    pages = plain(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    pages = pages.withColumns({
        "row": F.monotonically_increasing_id(), "payload_bytes": F.octet_length("html").cast("long"),
        "payload_digest": F.sha2("html", 256)})
    pages = pages.withColumn("own", F.struct(
        F.coalesce("page_id", F.lit((1 << 63) - 1)).alias("page"), F.col("row").alias("row")))
    shared = pages.where(F.col("payload_bytes") >= LEAST_SHARED)
    first = shared.groupBy("payload_digest").agg(F.min("own").alias("first"), F.count("*").alias("times")).where("times > 1")
    joined = pages.join(first, "payload_digest", "left")
    revisit = (F.col("payload_bytes") >= LEAST_SHARED) & (F.col("own") != F.col("first"))
    return joined.select(
        "page_id", "url", "html", "payload_bytes", "payload_digest", _uuid(F.col("own.page"), F.col("own.row")).alias("own_id"),
        F.when(revisit, _uuid(F.col("first.page"), F.col("first.row"))).alias("first_id"))


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write three records per row of ``pages`` (request, response or revisit, metadata) as gzip files below ``path``.

    The request and the metadata name the response in WARC-Concurrent-To. A capture of a payload that is
    already stored is a revisit, which has the HTTP header but no payload. Characters that a header
    cannot hold are percent-encoded in the URI; a null url becomes ``urn:page:`` and the id.
    """
    rows = captures(pages)
    uri = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"),
                     F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none"))))
    is_revisit = F.col("first_id").isNotNull()
    http = F.concat(F.lit(CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "])),
                    F.col("payload_bytes").cast("string"), F.lit(CRLF * 2))
    common = {"WARC-Date": date, "WARC-Target-URI": uri}
    request = _record({"WARC-Type": "request", "WARC-Record-ID": _uuid(F.lit("request"), F.col("own_id")), **common,
                       "WARC-Concurrent-To": F.col("own_id"), "Content-Type": "application/http; msgtype=request"},
                      F.concat(F.lit("GET "), uri, F.lit(" HTTP/1.1" + CRLF * 2)))
    response = _record({
        "WARC-Type": F.when(is_revisit, "revisit").otherwise("response"), "WARC-Record-ID": F.col("own_id"), **common,
        "WARC-Payload-Digest": F.concat(F.lit("sha256:"), F.col("payload_digest")),
        "WARC-Profile": F.when(is_revisit, PROFILE), "WARC-Refers-To": F.col("first_id"),
        "Content-Type": "application/http; msgtype=response"},
        F.when(is_revisit, http).otherwise(F.concat(http, F.col("html"))))
    metadata = _record({"WARC-Type": "metadata", "WARC-Record-ID": _uuid(F.lit("metadata"), F.col("own_id")), **common,
                        "WARC-Concurrent-To": F.col("own_id"), "Content-Type": "application/warc-fields"},
                       F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit("")))
    (rows.select(F.explode(F.array(request, response, metadata)).alias("record"))
     .write.option("lineSep", CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def _fields(source) -> dict[str, list[str]]:
    """Header lines up to an empty one; a name may come several times, a line that starts with white space goes on with the
    one before, and bytes that are no UTF-8 are replaced."""
    found: dict[str, list[str]] = {}
    last: list[str] = []
    while line := source.readline().rstrip(b"\r\n"):
        text = line.decode("utf-8", "replace")
        if text[0] in " \t" and last:
            last[-1] = f"{last[-1]} {text.strip()}".strip()
            continue
        name, _, value = text.partition(":")
        last = found.setdefault(name.strip().lower(), [])
        last.append(value.strip())
    return found


def _fits(payload: bytes, digest: str) -> bool:
    """Whether a digest header, ``algorithm:value`` in hexadecimal or base 32, is that of a payload; one of an unknown
    algorithm or form says nothing."""
    name, _, value = digest.partition(":")
    name = name.strip().lower().replace("-", "")
    if name not in ALGORITHMS:
        return True
    found = hashlib.new(name, payload).digest()
    return value.strip().lower() == found.hex() or value.strip().upper().rstrip("=") == base64.b32encode(found).decode().rstrip("=")


def parse_archive(content: bytes) -> Iterator[dict]:
    """The records of one file, gzip of one or many members or plain; blocks are taken by their Content-Length.

    Of a response ``payload_digest`` is the SHA-256 of its payload, whatever its header has; a header of a known algorithm
    is checked. Of a revisit it is what the header has, without ``sha256:``. A record that is cut short, has no
    length or does not fit its digest is an error; other headers may be missing.
    """
    stream = io.BytesIO(content)
    if bytes(memoryview(content)[:2]) == b"\x1f\x8b":
        stream = gzip.GzipFile(fileobj=stream)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a record: {line[:40]!r}")
        head = _fields(stream)
        one = lambda name: next(iter(head.get(name, [])), None)
        length = one("content-length")
        if length is None or not length.isdigit():
            raise ValueError(f"record {one('warc-record-id')} has no length")
        block = stream.read(int(length))
        if len(block) != int(length):
            raise ValueError(f"record {one('warc-record-id')} is cut short")
        kind, digest = one("warc-type"), one("warc-payload-digest")
        row = {"record_id": one("warc-record-id"), "type": kind, "concurrent_to": head.get("warc-concurrent-to", []),
               "refers_to": one("warc-refers-to"), "target_uri": one("warc-target-uri"), "date": one("warc-date"),
               "payload_digest": digest and digest.removeprefix("sha256:"),
               "payload_bytes": None, "page_id": None, "payload": None}
        if kind in ("response", "revisit"):
            body = io.BytesIO(block)
            body.readline()
            http = _fields(body)
            payload = block[body.tell():]
            if kind == "response":
                if digest and not _fits(payload, digest):
                    raise ValueError(f"record {row['record_id']}: the payload does not fit its digest")
                row |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": hashlib.sha256(payload).hexdigest()}
            else:
                stated = next(iter(http.get("content-length", [])), "")
                row["payload_bytes"] = int(stated) if stated.isdigit() else None
        elif kind == "metadata":
            value = next(iter(_fields(io.BytesIO(block)).get("page-id", [])), "")
            row["page_id"] = int(value) if value.removeprefix("-").isdigit() else None
        yield row


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the files below ``path``; a damaged record fails the job.

    ``payloads=False`` leaves payloads null after their digests were checked.
    """
    names = [c.split()[0] for c in _RECORD.split(", ")]
    types = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<string>": pa.list_(pa.string())}
    schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in _RECORD.split(", ")])

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for row in parse_archive(content.as_buffer()):
                    size += len(row["payload"] or b"")
                    rows.append(row if payloads else row | {"payload": None})
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    assert names == schema.names
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parsed, _RECORD)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``response`` (or revisit), and the ``requests`` and ``metadata`` that name it in
    WARC-Concurrent-To, or that it names there.

    A capture without requests or metadata has empty lists; a record that goes with several captures is in the row of
    each, one that goes with none is in no row. A page_id is the first that the metadata give.
    """
    main = records.where("type in ('response', 'revisit')")
    named_by_main = main.select(F.explode("concurrent_to").alias("other"), F.col("record_id").alias("capture"))

    def named(kind: str, alias: str, *fields: str) -> DataFrame:
        own = records.where(F.col("type") == kind)
        naming = own.select(F.explode("concurrent_to").alias("capture"), "record_id", *fields)
        back = own.join(named_by_main, F.col("record_id") == F.col("other")).select("capture", "record_id", *fields)
        return (naming.union(back).groupBy(F.col("capture").alias("record_id"))
                .agg(F.array_sort(F.collect_set(F.struct("record_id", *fields))).alias(alias)))

    whole = (main.join(named("request", "requests", "target_uri", "date"), "record_id", "left")
             .join(named("metadata", "metadata", "page_id"), "record_id", "left"))
    return whole.select(
        "record_id", F.get(F.filter(F.col("metadata.page_id"), lambda p: p.isNotNull()), F.lit(0)).alias("page_id"),
        F.struct("type", "target_uri", "date", "payload_digest", "payload_bytes", "refers_to", "payload").alias("response"),
        F.coalesce("requests", F.array().cast("array<struct<record_id:string,target_uri:string,date:string>>")).alias("requests"),
        F.coalesce("metadata", F.array().cast("array<struct<record_id:string,page_id:bigint>>")).alias("metadata"))


def with_references(captured: DataFrame) -> DataFrame:
    """Adds ``refers_to``: the page_id of the response that a revisit names, null where there is none."""
    target = captured.where("response.type = 'response'").select(
        F.col("record_id").alias("target"), F.col("page_id").alias("refers_to"))
    return captured.join(target, captured["response.refers_to"] == F.col("target"), "left").drop("target")


def round_trip(pages: DataFrame, path: str) -> DataFrame:
    """Write archives below ``path``, read them again and return
    ``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every page.

    See ``captures`` for nulls, small payloads and repeated rows. Further columns are not read.
    """
    write_archives(pages, path)
    # Archives are parsed once; the records without their payloads are then joined several ways.
    records = keep(read_archives(pages.sparkSession, path, payloads=False), "records")
    captured = keep(transactions(records), "captures")
    return with_references(captured).select(
        "page_id", F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.type").alias("record_type"), "refers_to")
