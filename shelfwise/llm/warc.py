"""WARC archives: writing with revisit records, and a reader that salvages damaged archives."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import map_slices, salted_lookup, shared_folder, ship, table

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
VERSION = re.compile(rb"WARC/\d\.\d\r\n")
MEMBER = b"\x1f\x8b\x08"
DELIMITER = b"\r\n\r\n"
#: Tasks over which one payload's copies are dealt.
SALTS = 32
#: Records in a file, and the payload from which a record gets a file of its own: so a file, which one
#: task reads whole, holds at most their product or one record.
RECORDS_PER_ARCHIVE = 500
LARGE_BYTES = 1 << 20
#: A gzip member of nothing, between the members of records.
EMPTY_MEMBER = bytes.fromhex("1f8b080000000000000303000000000000000000")
#: Bytes that the reader hands to the decompressor at once.
CHUNK = 1 << 16


def sha1_base32(data: Column) -> Column:
    """Bare upper-case base32 SHA-1 in SQL functions: 40 bits, ten hex digits, make eight characters."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, payload_bytes, digest, refers_to): which row carries its payload and which refers.

    Of rows with equal payloads of at least ``min_bytes`` bytes those with the largest page_id
    carry it (all of them, if that id is repeated); the others get ``refers_to``. Null html is an
    empty payload; a row with a null page_id carries its payload.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumns(
        {"payload_bytes": F.octet_length("html").cast("long"), "digest": sha1_base32(F.col("html").cast("binary"))}
    )
    shared = (
        rows.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("carrier"), F.count("*").alias("__n"))
        .where("__n > 1")
        .drop("__n")
    )
    found = salted_lookup(rows, shared, "digest", SALTS, F.xxhash64("page_id", "url"))
    refers = F.when((F.col("payload_bytes") >= min_bytes) & (F.col("page_id") != F.col("carrier")), F.col("carrier"))
    return found.withColumn("refers_to", refers).drop("carrier")


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def record(date: str = DATE) -> Column:
    """One record's text without the closing delimiter."""
    revisit = F.col("refers_to").isNotNull()
    clean_url = F.regexp_replace("url", "[\\r\\n]", "")
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _urn(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), clean_url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _urn(F.col("refers_to")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), F.when(revisit, "").otherwise(F.col("html")))


def write_archives(planned: DataFrame, path: str, compression: str = "gzip", date: str = DATE) -> None:
    """Write the records below ``path``, through Spark's committer and on any store Spark can write to.

    A file holds at most RECORDS_PER_ARCHIVE records of up to LARGE_BYTES, or one larger record. With
    ``none`` the text sink's separator is the two line ends that close a WARC record, and every version line
    stays findable after damage. With ``gzip`` each record is a member of its own, so damage to one leaves
    the others: the sink writes a string column's bytes as they are, and its separator, an empty member,
    keeps the file a valid sequence of members.
    """
    text = {"compression": "none", "lineSep": DELIMITER.decode()}
    if compression == "gzip":
        text |= {"encoding": "ISO-8859-1", "lineSep": EMPTY_MEMBER.decode("latin-1")}
    carried = F.col("refers_to").isNull()
    large = F.col("payload_bytes") > LARGE_BYTES
    # the condition on the payload comes first, so that only large ones are shuffled a second time
    for name, some, records in (("records", ~large | ~carried, RECORDS_PER_ARCHIVE), ("large", large & carried, 1)):
        rows = planned.where(some).select(record(date).alias("value"))
        if compression == "gzip":
            rows = map_slices(rows, _members, "value binary", rows=64).select(F.col("value").cast("string"))
        rows.write.options(maxRecordsPerFile=records, **text).text(f"{path}/{name}")


def _members(cols: dict[str, list]) -> dict[str, list]:
    return {"value": [gzip.compress(v.encode("utf-8") + DELIMITER, 6, mtime=0) for v in cols["value"]]}


def _plain(data: bytes, base: int) -> Iterator[tuple[int, int, str | None, dict[str, str], bytes]]:
    """(start, end, reason, headers, payload) of each record or, with a reason, each gap."""
    at, n = 0, len(data)
    while at < n:
        reason, headers, payload, end = _record(data, at)
        if reason is None:
            yield base + at, base + end, None, headers, payload
            at = end
            continue
        if not (reason == "digest" and (end == n or VERSION.match(data, end))):
            found = VERSION.search(data, at + 1)
            end = found.start() if found else n
        yield base + at, base + end, reason, headers, b""
        at = end


def _record(data: bytes, at: int) -> tuple[str | None, dict[str, str], bytes, int]:
    version = VERSION.match(data, at)
    if not version:
        return "version line", {}, b"", at
    close = data.find(DELIMITER, version.end() - 2)
    if close < 0:
        return "header", {}, b"", at
    headers = {}
    for line in data[version.end() : close].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon:
            return "header", headers, b"", at
        headers[name.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    if not length.isascii() or not length.isdigit():
        return "length", headers, b"", at
    start = close + 4
    end = start + int(length)
    if data[end : end + 4] != DELIMITER:
        return "length", headers, b"", at
    payload = data[start:end]
    kind, _, digest = headers.get("warc-payload-digest", "").partition(":")
    if headers.get("warc-type") != "revisit" and kind == "sha1":
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            return "digest", headers, b"", end + 4
    return None, headers, payload, end + 4


def salvage(data: bytes) -> Iterator[tuple[int, int, str | None, dict[str, str], bytes]]:
    """Records and quarantined gaps of one archive, plain or of gzip members.

    After a failed check the reader looks for the next version line or, in a compressed archive, for
    the next member that opens, and goes on there. Offsets are bytes of the archive; inside a
    member, bytes of its content. A reason tells which check failed. An empty archive gives nothing.
    """
    if not data.startswith(MEMBER):
        if MEMBER not in data or VERSION.search(data):
            yield from _plain(data, 0)
            return
    at, n = 0, len(data)
    while at < n:
        content, end = _member(data, at)
        yield from _plain(content, 0)
        if end is None:
            end = _next_member(data, at + 1)
            yield at, end, "member", {}, b""
        at = end


def _member(data: bytes, at: int) -> tuple[bytes, int | None]:
    """(what can be decompressed of the member at ``at``, its end; None if it breaks)."""
    opener, out, view = zlib.decompressobj(31), [], memoryview(data)
    try:
        while at < len(data) and not opener.eof:
            out.append(opener.decompress(view[at : at + CHUNK]))
            at += CHUNK
    except zlib.error:
        return b"".join(out), None
    return b"".join(out), min(at, len(data)) - len(opener.unused_data) if opener.eof else None


def _next_member(data: bytes, at: int) -> int:
    """The next place where a gzip member can be opened and starts with a version line."""
    while (at := data.find(MEMBER, at)) >= 0:
        try:
            if VERSION.match(zlib.decompressobj(31).decompress(data[at : at + CHUNK], 64)):
                return at
        except zlib.error:
            pass
        at += 1
    return len(data)


READ_SCHEMA = "archive string, start long, end long, reason string, headers map<string,string>, payload binary"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record and gap of the archives below ``path``; a row with a ``reason`` is a gap."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(spark)
    arrow = to_arrow_schema(T.StructType.fromDDL(READ_SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                rows: list[tuple] = []
                size = 0
                for start, end, reason, headers, payload in salvage(content.as_py()):
                    rows.append((name.as_py(), start, end, reason, list(headers.items()), payload))
                    size += len(payload)
                    if len(rows) == 500 or size > 4_000_000:
                        yield _batch(rows, arrow)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, arrow)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInArrow(run, READ_SCHEMA)


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow
    )


def _page(urn: str) -> Column:
    return F.regexp_extract(F.col("headers")[urn], "^<urn:page:(.+)>$", 1).try_cast("long")


def described(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each intact record.

    A revisit has the size of the payload it refers to, null if that record was lost.
    """
    rows = records.where("reason is null").select(
        _page("warc-record-id").alias("page_id"),
        F.octet_length("payload").cast("long").alias("own_bytes"),
        F.regexp_replace(F.col("headers")["warc-payload-digest"], "^sha1:", "").alias("payload_digest"),
        F.col("headers")["warc-type"].alias("record_type"),
        _page("warc-refers-to").alias("refers_to"),
    )
    named = rows.where("refers_to is not null").groupBy("refers_to").agg(F.count("*").alias("__n"))
    carriers = rows.where("record_type = 'response'").groupBy("page_id").agg(F.max("own_bytes").alias("carried"))
    sizes = named.join(carriers.withColumnRenamed("page_id", "refers_to"), "refers_to").drop("__n")
    found = salted_lookup(rows, sizes, "refers_to", SALTS, F.xxhash64("page_id"))
    size = F.when(F.col("record_type") == "revisit", F.col("carried")).otherwise(F.col("own_bytes"))
    return found.select("page_id", size.alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page as a record, read the archives back, and describe the records read."""
    path = f"{shared_folder(spark)}/warc"
    write_archives(plan_records(table(spark, sf_dir, "pages")), path)
    records = read_archives(spark, path).select("reason", "headers", F.col("payload"))
    return described(records)
