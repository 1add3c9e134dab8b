"""Web archives: write captures as WARC records, read them back, assemble transactions.

Archives are written and read by Spark's text source with the blank line that
ends a record as separator, so they may lie in any store Spark knows, a failed
task leaves nothing behind, and records are parsed as a stream.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.sources.shared import staged

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

MAIN_TYPES = ("response", "revisit", "resource")  # a transaction has one of these


def sha1_base32(content: Column) -> Column:
    """SHA-1 of a binary column in base32, five hex digits to four letters."""
    digest = F.sha1(content)
    letters = []
    for part in range(8):
        number = F.conv(F.substring(digest, 1 + 5 * part, 5), 16, 10).cast("int")
        letters += [F.lit(BASE32).substr((F.shiftright(number, s) % 32 + 1).cast("int"), F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def _uuid(*parts) -> Column:
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    cuts = [F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _line(name: str, value) -> Column:
    """A header line, or nothing for null; line breaks in a value are escaped."""
    value = value if isinstance(value, Column) else F.lit(value)
    clean = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def _record(headers: list[Column], block: Column) -> Column:
    head = F.concat(F.lit(VERSION + "\r\n"), *headers, _line("Content-Length", F.length(block)), F.lit("\r\n"))
    return F.concat(F.encode(head, "UTF-8"), block).cast("string")


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """A request, a response or revisit, and a metadata record per row of ``pages`` (page_id, url, html, ...).

    The payload is html in UTF-8, empty for null. Of rows with equal payloads of
    at least ``min_bytes`` bytes, those with the largest page_id are responses and
    the others revisits, which have no payload of their own; rows without page_id
    revisit as well, unless none of the payload's rows has one. Smaller payloads
    are always responses. Rows that repeat a response share its record id. A null
    url leaves its header out. An empty table gives archives without records.

    Payloads are compared by digest. The table of repeated digests is written
    first, so the join with it is planned on its real size: a broadcast where
    that is small, otherwise a plain join whose hot keys adaptive execution splits.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )
    rows = rows.withColumn("digest", sha1_base32(F.col("payload")))
    repeated = staged(
        rows.where(F.length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .drop("n"),
        "repeated_payloads",
    )
    rows = rows.join(repeated, "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))

    def response_id(page_id: str) -> Column:
        return _uuid(F.lit("response"), F.coalesce(F.col(page_id).cast("string"), F.lit("-")), "digest")

    rows = rows.select(
        "*",
        revisit.alias("revisit"),
        F.when(revisit, _uuid(F.lit("revisit"), F.monotonically_increasing_id())).otherwise(response_id("page_id")).alias("id"),
        F.when(revisit, response_id("first_id")).alias("refers_to"),
        F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:]*://([^/?#]*)(.*)$", 1).alias("host"),
    )
    date_line, uri, concurrent = _line("WARC-Date", date), _line("WARC-Target-URI", F.col("url")), _line("WARC-Concurrent-To", F.col("id"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.length("payload").cast("string"),
        F.lit(END),
    )
    main = _record(
        [
            F.when(F.col("revisit"), _line("WARC-Type", "revisit")).otherwise(_line("WARC-Type", "response")),
            _line("WARC-Record-ID", F.col("id")), date_line, uri,
            F.when(F.col("revisit"), F.concat(_line("WARC-Profile", REVISIT_PROFILE), _line("WARC-Refers-To", F.col("refers_to")))).otherwise(""),
            _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
            _line("Content-Type", "application/http; msgtype=response"),
        ],
        F.when(F.col("revisit"), F.encode(http, "UTF-8")).otherwise(F.concat(F.encode(http, "UTF-8"), "payload")),
    )
    serial = F.monotonically_increasing_id()
    asked = F.concat(F.lit("GET "), F.coalesce(F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "), "host", F.lit(END))
    request = _record(
        [_line("WARC-Type", "request"), _line("WARC-Record-ID", _uuid(F.lit("request"), serial)), date_line, uri, concurrent, _line("Content-Type", "application/http; msgtype=request")],
        F.encode(asked, "UTF-8"),
    )
    about = _line("page-id", F.col("page_id"))
    metadata = _record(
        [_line("WARC-Type", "metadata"), _line("WARC-Record-ID", _uuid(F.lit("metadata"), serial)), date_line, uri, concurrent, _line("Content-Type", "application/warc-fields")],
        F.encode(about, "UTF-8"),
    )
    records = rows.select(F.explode(F.array(request, main, metadata)).alias("value"))
    records.write.option("lineSep", END).option("compression", "gzip").text(folder)


RECORD = (
    "record_id string, type string, date string, target_uri string, concurrent_to array<string>, refers_to string, "
    "content_type string, page_id long, payload binary, payload_bytes long, payload_digest string, digest_matches boolean"
)
_FIELDS = [x.split(" ")[0] for x in RECORD.split(", ")]


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the archives below ``folder``.

    payload is the body after the HTTP header, or the block of other records.
    payload_bytes and the bare payload_digest are of the full payload; a revisit
    has an empty payload, and both from its headers. digest_matches is null
    where a record names no digest to compare. page_id is what a metadata record
    says, null elsewhere.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for row in _records(part.as_py() or b"" for batch in batches for part in batch.column(0)):
            rows.append(row)
            size += len(row["payload"]) + 500
            if size >= 1 << 22:
                yield _batch(rows)
                rows, size = [], 0
        yield _batch(rows)

    parts = spark.read.option("lineSep", END).text(folder).select(F.col("value").cast("binary"))
    return parts.mapInArrow(parse, RECORD)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"concurrent_to": pa.list_(pa.string()), "page_id": pa.int64(), "payload": pa.binary(), "payload_bytes": pa.int64(), "digest_matches": pa.bool_()}
    return pa.RecordBatch.from_arrays([pa.array([r[f] for r in rows], kinds.get(f, pa.string())) for f in _FIELDS], names=_FIELDS)


def _records(parts: Iterator[bytes]) -> Iterator[dict]:
    """Records from the parts between blank lines.

    A block may hold blank lines or run into the one behind it, so the parts are
    put together again and only lengths say where a block ends. Line breaks
    between records are skipped.
    """
    end = END.encode()
    buffer = bytearray()

    def more() -> bool:
        part = next(parts, None)
        if part is not None:
            buffer.extend(part)
            buffer.extend(end)
        return part is not None

    while True:
        del buffer[: len(buffer) - len(buffer.lstrip(b"\r\n"))]
        if not buffer:
            if more():
                continue
            return
        head = buffer.index(end)
        headers = _headers(bytes(buffer[:head]))
        start = head + len(end)
        stop = start + int(headers["content-length"][0])
        while len(buffer) < stop:
            if not more():
                raise ValueError("an archive ends within a record")
        yield _row(headers, bytes(buffer[start:stop]))
        del buffer[:stop]


def _headers(head: bytes) -> dict[str, list[str]]:
    found: dict[str, list[str]] = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        found.setdefault(name.strip().lower(), []).append(value.strip())
    return found


def _row(headers: dict[str, list[str]], block: bytes) -> dict:
    def one(name: str) -> str | None:
        return headers.get(name, [None])[0]

    payload, length = block, None
    if (one("content-type") or "").startswith("application/http"):
        head, _, payload = block.partition(END.encode())
        length = _headers(head).get("content-length", [None])[0]
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    declared = (one("warc-payload-digest") or "").rpartition(":")[2] or None
    revisit = one("warc-type") == "revisit"
    page_id = None
    if one("content-type") == "application/warc-fields":
        page_id = _headers(b"\r\n" + block).get("page-id", [None])[0]
    return {
        "record_id": one("warc-record-id"),
        "type": one("warc-type"),
        "date": one("warc-date"),
        "target_uri": one("warc-target-uri"),
        "concurrent_to": headers.get("warc-concurrent-to", []),
        "refers_to": one("warc-refers-to"),
        "content_type": one("content-type"),
        "page_id": int(page_id) if page_id else None,
        "payload": payload,
        "payload_bytes": int(length) if revisit and length else len(payload),
        "payload_digest": declared if revisit and declared else digest,
        "digest_matches": None if revisit or not declared else declared == digest,
    }


def transactions(records: DataFrame, max_nested: int = 1000) -> DataFrame:
    """One row per capture: capture_id, part, main (the response, revisit or resource), requests, metadata.

    ``records`` has record_id, type and concurrent_to; all its columns are nested.
    A record belongs to the main record it is concurrent to, or that is concurrent
    to it, or else to that of a record it is so linked with. Records that reach no
    main record form a capture of their own, by the id they are concurrent to (or
    their own), with main null. Rows that repeat a main record's id each give a
    capture, with the same other records. Records without id can only be found by
    what they are concurrent to. An empty table gives an empty result.

    A capture with more than ``max_nested`` other records has them in several
    parts, told apart by hash, so no row and no task grows without bound.
    """
    is_main = F.col("type").isin(*MAIN_TYPES)
    mains = records.where(is_main)
    others = records.where(F.coalesce(~is_main, F.lit(True)))
    main_ids = mains.select(F.col("record_id").alias("to")).where("to IS NOT NULL").distinct()
    links = records.select("record_id", F.explode("concurrent_to").alias("to")).where("record_id IS NOT NULL")
    links = links.unionAll(links.select("to", "record_id")).distinct()
    direct = links.join(main_ids, "to").groupBy("record_id").agg(F.min("to").alias("capture_id"))
    onward = links.join(direct.select(F.col("record_id").alias("to"), "capture_id"), "to")
    onward = onward.groupBy("record_id").agg(F.min("capture_id").alias("over"))
    home = direct.join(onward, "record_id", "full").select("record_id", F.coalesce("capture_id", "over").alias("found"))

    alone = F.coalesce(F.get(F.array_sort("concurrent_to"), F.lit(0)), "record_id", F.lit(""))
    placed = others.join(home, "record_id", "left").withColumn("capture_id", F.coalesce("found", alone)).drop("found")
    sizes = placed.groupBy("capture_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_nested)
    row = F.struct(*records.columns)
    parts = F.ceil(F.coalesce("n", F.lit(1)) / F.lit(max_nested)).cast("int")
    nested = (
        placed.join(sizes, "capture_id", "left")
        .withColumn("part", F.pmod(F.xxhash64("record_id", F.lit(17)), parts).cast("int"))
        .groupBy("capture_id", "part")
        .agg(
            F.collect_list(F.when(F.col("type") == "request", row)).alias("requests"),
            F.collect_list(F.when(~F.col("type").eqNullSafe(F.lit("request")), row)).alias("metadata"),
        )
    )
    return (
        mains.select(F.coalesce("record_id", F.lit("")).alias("capture_id"), row.alias("main"))
        .join(nested, "capture_id", "full")
        .select("capture_id", F.coalesce("part", F.lit(0)).alias("part"), "main", *(F.coalesce(c, F.array()).alias(c) for c in ("requests", "metadata")))
    )
