"""Content-addressed WARC archive.

An archive is a folder with two stores. ``payloads`` has the bytes of each distinct payload once, under
their SHA-256; ``headers`` has, for every record, its exact bytes up to the payload (WARC header, blank line, HTTP
header, blank line) and the digest. Records come back by joining the two; what the digests, lengths
and headers say is checked against the bytes that were read, and what differs raises.

The first record with a payload is a response, records that repeat it are revisits that refer to
it. ``write_warc`` writes the restored records as WARC files, ``read_warc`` reads such files.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch_folder, stage

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE, BLANK = "\r\n", "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

WRITTEN_AT = "2024-01-01T00:00:00Z"
RECORDS_IN_FILE = 10_000


def sha1_base32(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: 40 bits at a time make eight digits."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), digits, BASE32)


def _record_id(*parts: Column) -> Column:
    told = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    cuts = [F.substring(told, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line; null where the value is null."""
    return F.concat(F.lit(f"{name}: "), value.cast("string"))


def _one_line(url: Column) -> Column:
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _payloads(pages: DataFrame) -> DataFrame:
    """What the archive takes from ``pages(page_id, url, html)``; a null html is an empty payload."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))


def write_archive(pages: DataFrame, folder: str, least_revisit: int = 0) -> None:
    """Write a record for every row of ``pages(page_id, url, html)`` to the two stores below ``folder``.

    Of records with equal payloads of ``least_revisit`` bytes or more that with the smallest page_id (null
    last, then by url, null first) is a response and the others revisit it; smaller payloads are all
    responses. Null ids and urls have no header line; line ends in urls are percent-encoded. Repeated
    rows are records of their own. No rows: two empty stores. Other columns are not read.
    """
    rows = stage(
        _payloads(pages).select(
            "page_id", "url", F.sha2("payload", 256).alias("key"), sha1_base32(F.col("payload")).alias("sha1"),
            F.octet_length("payload").cast("bigint").alias("size"), F.monotonically_increasing_id().alias("nth"),
        ),
        "warc-rows",
    )
    _write_headers(rows, f"{folder}/headers", least_revisit)
    _write_payloads(pages, f"{folder}/payloads")


def _write_headers(rows: DataFrame, place: str, least_revisit: int) -> None:
    # One row for each payload, least within tasks first; any number of copies may share it.
    first = rows.groupBy("key").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url", "nth")).alias("first")
    )
    named = rows.join(first, "key")
    first_of = {c: F.col("first")[c] for c in ("page_id", "url", "nth")}
    revisits = (F.col("size") >= least_revisit) & (F.col("nth") != first_of["nth"])
    http = F.concat_ws(
        LINE, F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), _field("Content-Length", F.col("size"))
    )
    length = F.octet_length(http) + len(BLANK) + F.when(revisits, 0).otherwise(F.col("size"))
    only_revisits = [
        _field("WARC-Refers-To", _record_id(first_of["page_id"], first_of["url"], F.col("key"), first_of["nth"])),
        _field("WARC-Refers-To-Target-URI", _one_line(first_of["url"])),
        F.lit(f"WARC-Profile: {REVISIT_PROFILE}"),
    ]
    header = F.concat_ws(
        LINE,
        F.lit(VERSION),
        _field("WARC-Type", F.when(revisits, "revisit").otherwise("response")),
        _field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("url"), F.col("key"), F.col("nth"))),
        F.lit(f"WARC-Date: {WRITTEN_AT}"),
        _field("WARC-Target-URI", _one_line(F.col("url"))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        *[F.when(revisits, line) for line in only_revisits],
        _field("X-Page-Id", F.col("page_id")),
        F.lit("Content-Type: application/http;msgtype=response"),
        _field("Content-Length", length),
    )
    named.select(
        "key", F.concat(header, F.lit(BLANK), http, F.lit(BLANK)).cast("binary").alias("head")
    ).write.parquet(place)


def _write_payloads(pages: DataFrame, place: str) -> None:
    """Copies meet within tasks first. Payloads of one digest that differ in another are refused."""
    digested = _payloads(pages).select("payload").withColumns({
        "key": F.sha2("payload", 256), "other": F.xxhash64("payload"), "size": F.octet_length("payload"),
    })
    once = digested.groupBy("key").agg(
        F.first("payload").alias("payload"),
        *[f(c).alias(f"{f.__name__}_{c}") for c in ("other", "size") for f in (F.min, F.max)],
    )
    same = (F.col("min_other") == F.col("max_other")) & (F.col("min_size") == F.col("max_size"))
    once.select(
        "key", F.when(same, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payloads differ under "), "key")).cast("binary")).alias("payload")
    ).write.option("compression", "zstd").parquet(place)


def _of(name: str) -> Column:
    """A field of the WARC header; null if it is not there."""
    header = F.substring_index(F.col("head").cast("string"), BLANK, 1)
    found = F.regexp_extract(header, f"(?m)^{name}: ([^\r\n]*)", 1)
    return F.when(F.contains(header, F.lit(f"{LINE}{name}: ")), found)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of an archive: ``record_id, record_type, page_id, url, refers_to`` (page_id of the
    response), ``payload_bytes, payload_digest`` (both from the stored bytes), ``head, payload, record``.

    ``record`` is the WARC record: head, payload (not in revisits) and the closing line ends. A
    payload that is missing or is not what its digest, its length or its header tell raises.
    """
    stored = spark.read.parquet(f"{folder}/payloads").select(
        "key", "payload", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        sha1_base32(F.col("payload")).alias("payload_digest"), (F.sha2("payload", 256) == F.col("key")).alias("intact"),
    )
    headers = spark.read.parquet(f"{folder}/headers").select("key", "head").withColumns({
        "record_id": _of("WARC-Record-ID"),
        "record_type": _of("WARC-Type"),
        "page_id": _of("X-Page-Id").cast("bigint"),
        "url": _of("WARC-Target-URI"),
        "refers_to_id": F.coalesce(_of("WARC-Refers-To"), _of("WARC-Record-ID")),   # no nulls that meet in one task
        "told_digest": _of("WARC-Payload-Digest"),
        "told_length": _of("Content-Length").cast("bigint"),
        "http_length": F.octet_length("head")
        - F.octet_length(F.substring_index(F.col("head").cast("string"), BLANK, 1)) - len(BLANK),
    })
    is_response = F.col("record_type") == "response"
    right = (
        F.col("intact")
        & (F.col("told_digest") == F.concat(F.lit("sha1:"), "payload_digest"))
        & (F.col("told_length") == F.col("http_length") + F.when(is_response, F.col("payload_bytes")).otherwise(0))
    )
    damaged = F.raise_error(F.concat(F.lit("damaged record "), "record_id")).cast("string")
    records = headers.join(stored, "key", "left").withColumn(
        "record_type", F.when(F.coalesce(right, F.lit(False)), F.col("record_type")).otherwise(damaged)
    )
    responses = headers.where(is_response).select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("first_page"))
    closing = F.lit(BLANK).cast("binary")
    body = F.when(is_response, F.col("payload")).otherwise(F.lit("").cast("binary"))
    return records.join(responses, "refers_to_id", "left").select(
        "record_id", "record_type", "page_id", "url", F.when(~is_response, F.col("first_page")).alias("refers_to"), "payload_bytes", "payload_digest", "head", "payload",
        F.concat("head", body, closing).alias("record"),
    )


def write_warc(records: DataFrame, folder: str, compression: str = "none") -> None:
    """Write ``record`` of restored records as WARC files, of ``RECORDS_IN_FILE`` records at most."""
    closed = F.expr(f"substring(record, 1, octet_length(record) - {len(BLANK)})").cast("string")
    records.select(closed.alias("value")).write.options(
        lineSep=BLANK, compression=compression, maxRecordsPerFile=RECORDS_IN_FILE
    ).text(folder)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """``record_type, record_id, url, payload_digest, header, block`` of all records in the uncompressed WARC files
    below ``folder``; a file is one row of Spark's ``binaryFile`` source, so files should be of some 100 MB at most."""
    names = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "url": "WARC-Target-URI", "payload_digest": "WARC-Payload-Digest"}
    layout = ", ".join(f"{c} string" for c in names) + ", header binary, block binary"

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for some in _parsed(content.as_buffer().to_pybytes()):
                    columns = [pa.array([fields.get(n.lower()) for fields, *_ in some], pa.string()) for n in names.values()]
                    columns += [pa.array([row[k] for row in some], pa.binary()) for k in (1, 2)]
                    yield pa.RecordBatch.from_arrays(columns, [*names, "header", "block"])

    files = spark.read.format("binaryFile").load(folder)
    return files.select("content").mapInArrow(parse, layout)


def _parsed(content: bytes, most_bytes: int = 8 << 20) -> Iterator[list[tuple[dict[str, str], bytes, bytes]]]:
    """Fields, header and block of each record, some MB at a time."""
    at, some, held = 0, [], 0
    while at < len(content):
        end = content.find(BLANK.encode(), at)
        header = content[at:end] if end >= 0 else b""
        if not header.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in header.decode().split(LINE)[1:])}
        if not re.fullmatch(r"\d+", fields.get("content-length", "")):
            raise ValueError(f"no Content-Length in the record at byte {at}")
        start = end + len(BLANK)
        at = start + int(fields["content-length"])
        if content[at:at + len(BLANK)] != BLANK.encode():
            raise ValueError(f"the record before byte {at} is cut off")
        some.append((fields, header, content[start:at]))
        held += at - start
        at += len(BLANK)
        if held >= most_bytes:
            yield some
            some, held = [], 0
    if some:
        yield some


def archive_digest(pages: DataFrame) -> DataFrame:
    """Archive all pages in the shared scratch folder and read the records back."""
    spark = pages.sparkSession
    folder = scratch_folder(spark, "warc-archive")
    write_archive(pages, folder)
    return read_archive(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
