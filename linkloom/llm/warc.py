"""WARC archives with revisit records: equal payloads are stored once.

Headers (digest, length, id) are shuffled by payload digest; of equal payloads, the record with the largest id stays
a response and the others become revisit records that refer to it. Archives are written by Spark's text
writer, a record to a row, with fresh headers; a record ends with the two line ends that the writer puts after
it. They are read back as files, parsed by the lengths in their headers, and revisits are joined to their responses.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators.sizes import fits_broadcast
from linkloom.operators.skew import skew_join
from linkloom.session import materialize

RECORDS_PER_FILE = 2048
# Payloads and headers that are read before they are passed on.
BATCH_BYTES = 16 << 20
_RESULTS = ("payload_bytes", "payload_digest", "record_type", "refers_to")
_END = "\r\n"
_ID = "urn:x-record:"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a binary value in base 32 (upper case, no padding: 160 bits are 32 characters)."""
    text = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(text, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def resolve(records: DataFrame, record_id: str, payload: str, least: int = 0) -> DataFrame:
    """``records`` with ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to``; columns of these names are replaced.

    ``payload`` is text, taken as UTF-8 (null: empty). Among records with equal payloads of at least ``least`` bytes, that
    with the largest id is the response. Records without an id are responses, and so are all rows of
    the largest id if it is repeated. An empty table gives none. Payloads are not shuffled unless very many of them are repeated.
    """
    if record_id in _RESULTS or payload in _RESULTS:
        raise ValueError(f"the id and the payload cannot be named like a result: {', '.join(_RESULTS)}")
    records = records.drop(*_RESULTS)
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    seen = records.withColumns({"payload_bytes": F.octet_length(body).cast("long"), "payload_digest": base32_sha1(body)})
    headers = seen.filter(F.col(record_id).isNotNull() & (F.col("payload_bytes") >= least))
    originals = materialize(
        headers.groupBy("payload_digest").agg(F.max(record_id).alias("__original"), F.count("*").alias("__n")).filter("__n > 1"), "originals"
    )
    kept = originals.drop("__n")
    if fits_broadcast(kept):
        joined = seen.join(F.broadcast(kept), "payload_digest", "left")
    else:
        counts = originals.select("payload_digest", F.col("__n").alias("n"))
        joined = skew_join(seen, kept, "payload_digest", F.col(record_id), counts=counts)
    revisit = (F.col("payload_bytes") >= least) & (F.col(record_id) < F.col("__original"))
    return joined.select(
        *[F.col(f"`{c}`") for c in records.columns], "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("__original")).alias("refers_to"),
    )


def _record(record_id: str, url: str, payload: str) -> Column:
    """One WARC record as text, without its end."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(_END))
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}"),
        line("Content-Length", F.col("payload_bytes").cast("string")), F.lit(_END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.coalesce(payload, F.lit(""))))
    own = lambda name: F.concat(F.lit(f"<{_ID}"), F.coalesce(F.col(name).cast("string"), F.lit("")), F.lit(">"))
    return F.concat(
        F.lit(f"WARC/1.1{_END}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", own(record_id)),
        line("WARC-Date", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce(url, F.lit("urn:x-unknown")), r"[\r\n\s]+", "%20")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(_REVISIT)), line("WARC-Refers-To", own("refers_to")))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(_END), block,
    )


def write_archives(resolved: DataFrame, path: str, record_id: str, url: str, payload: str, per_file: int = RECORDS_PER_FILE) -> None:
    """Write the records as gzip WARC files of at most ``per_file`` records; a failed task's files are not kept."""
    rows = resolved.select(_record(record_id, url, payload).alias("value"))
    rows.write.option("lineSep", _END * 2).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def _parse(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes, dict[str, str]]]:
    """Headers, payload and HTTP headers of each record, read one after the other."""
    while line := stream.readline():
        head = [line]
        while (line := stream.readline()).strip():
            head.append(line)
        fields = _fields(b"".join(head))
        http, _, payload = stream.read(int(fields["content-length"])).partition(b"\r\n\r\n")
        stream.read(len(_END * 2))
        yield fields, payload, _fields(http)


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8").split(_END)[1:])
    return {name.lower(): value.strip() for name, _, value in pairs}


def _number(uri: str | None) -> int | None:
    digits = (uri or "").removeprefix(f"<{_ID}").removesuffix(">")
    return int(digits) if digits else None


def read_archives(spark: SparkSession, path: str, payloads: bool = True, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(record_id, record_type, refers_to, url, payload_bytes, payload_digest, payload) of each record in the archives.

    Length and digest of a response are those of the payload that was read; a revisit has those of its headers and
    no payload. A file is one task's work, and its compressed bytes are one cell: ``write_archives`` bounds it by its records and
    by what a writing task has. It is decompressed record by record, and rows go on in batches of about ``batch_bytes``.
    """
    names = ["record_id", "record_type", "refers_to", "url", "payload_bytes", "payload_digest", *["payload"] * payloads]

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()][: len(names)]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for head, payload, http in _parse(gzip.open(io.BytesIO(content.as_buffer()))):
                    response = head["warc-type"] == "response"
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode() if response else head["warc-payload-digest"].removeprefix("sha1:")
                    rows.append((
                        _number(head["warc-record-id"]), head["warc-type"], _number(head.get("warc-refers-to")), head["warc-target-uri"],
                        len(payload) if response else int(http["content-length"]), digest, *[payload if response else None] * payloads,
                    ))
                    held += 200 + payloads * len(payload)
                    if held >= batch_bytes:
                        yield packed(rows)
                        rows, held = [], 0
                if rows:
                    yield packed(rows)

    schema = "record_id long, record_type string, refers_to long, url string, payload_bytes long, payload_digest string" + ", payload binary" * payloads
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, schema)


def join_revisits(records: DataFrame) -> DataFrame:
    """``records`` with length and digest (and payload, if there) of revisits taken from the response they refer to.

    ``records`` should be a table, as it is read more than once. Rows without a reference are spread, and so are those
    that refer to one response with a large share of all.
    """
    values = [c for c in ("payload_bytes", "payload_digest", "payload") if c in records.columns]
    responses = records.filter("record_type = 'response' AND record_id IS NOT NULL").groupBy(F.col("record_id").alias("refers_to")).agg(
        *[F.first(c).alias(f"_{c}") for c in values]
    )
    joined = skew_join(records, responses, "refers_to", F.col("record_id"))
    taken = {c: F.when(F.col("record_type") == "revisit", F.col(f"_{c}")).otherwise(F.col(c)) for c in values}
    return joined.withColumns(taken).select(*records.columns)
