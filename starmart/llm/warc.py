"""WARC archives of pages: writing with revisits, chunked bodies and segments; reading back.

A response of more than ``segment_bytes`` is written as a first segment and continuation
records, which name the first one's id as their origin and count up; the last tells the
total length.  Reading groups them by origin, orders them by number, checks that none is
missing and that lengths agree, and undoes the chunked transfer framing.  Every payload is
held against the digest in its record's header; what does not fit raises an error.

Archives are split by the line that opens a record, so one file is read by many tasks.  The
writer cuts a body's chunks inside any such line, and ends no chunk, segment or target with
the line's text, as a line break follows there: it never occurs within a record.  One file
is one gzip stream.

NULL html is an empty payload, NULL urls an empty target.  Of the rows with an equal payload
of ``least_bytes`` or more, those with the smallest page id are responses and the others
revisit it; if all their ids are NULL, all are responses.  Wholly equal rows are written and
read as often as they occur.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.exprs import col
from starmart.scratch import materialize, scratch_path

_NAME = "WARC/1.1"
_OPEN = f"{_NAME}\r\n".encode()
_END = "\r\n\r\n"
#: Repeated digests up to this number are broadcast: 100 bytes each at most.
BROADCAST_DIGESTS = 100_000


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _before_name(data: bytes, at: int, end: int) -> int:
    """``end``, or a place inside the name that opens records if ``data[at:end]`` ends with it."""
    return end - 4 if data.endswith(_NAME.encode(), at, end) else end


def chunked(payload: bytes, chunk_bytes: int) -> bytes:
    """Chunked transfer framing; no chunk holds the line that opens a record, or makes one with the line break after it."""
    out, at = [], 0
    while at < len(payload):
        end = min(len(payload), at + chunk_bytes)
        if (hit := payload.find(_OPEN, at, end + len(_OPEN) - 1)) >= 0:
            end = hit + 4
        end = _before_name(payload, at, end)
        out.append(b"%x\r\n%b\r\n" % (end - at, payload[at:end]))
        at = end
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(out)
        out.append(body[at : at + size])
        if len(out[-1]) != size or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut short")
        at += size + 2


def _record(block: bytes, **headers: object) -> bytes:
    lines = [f"{k.replace('_', '-')}: {v}" for k, v in headers.items() if v is not None]
    return _OPEN + "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block


def _target(url: str | None) -> str:
    """A header's value: no control characters, no line of its own, and not the end of a line that opens a record."""
    value = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    return f"{value.removesuffix(_NAME)}%{ord(_NAME[0]):02X}{_NAME[1:]}" if value.endswith(_NAME) else value


def records(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, *, chunk_bytes: int, segment_bytes: int) -> list[bytes]:
    """A page's records; of a revisit the header only."""
    own = record_id(page_id, digest)
    common = {
        "WARC_Record_ID": own,
        "WARC_Date": "2000-01-01T00:00:00Z",
        "WARC_Target_URI": _target(url),
        "WARC_Payload_Digest": f"sha256:{digest}",
        "X_Page_Id": page_id,
    }
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        more = {"WARC_Profile": profile, "WARC_Refers_To": record_id(refers_to, digest), "X_Refers_To_Page": refers_to}
        return [_record(b"", WARC_Type="revisit", **common, **more)]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    block = head + chunked(payload, chunk_bytes)
    kind = {"Content_Type": "application/http; msgtype=response"}
    if len(block) <= segment_bytes:
        return [_record(block, WARC_Type="response", **common, **kind)]
    parts, at = [], 0
    while at < len(block):
        end = _before_name(block, at, min(len(block), at + segment_bytes))
        parts.append(block[at:end])
        at = end
    out = [_record(parts[0], WARC_Type="response", **common, **kind, WARC_Segment_Number=1)]
    for number, part in enumerate(parts[1:], 2):
        out.append(
            _record(
                part,
                WARC_Type="continuation",
                WARC_Record_ID=record_id(page_id, f"{digest}/{number}"),
                WARC_Segment_Origin_ID=own,
                WARC_Segment_Number=number,
                WARC_Segment_Total_Length=len(block) if number == len(parts) else None,
            )
        )
    return out


def write(
    pages: DataFrame,
    folder: str,
    *,
    least_bytes: int = 100,
    chunk_bytes: int = 4096,
    segment_bytes: int = 32 << 10,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> None:
    """Archives of ``pages`` below ``folder``."""
    payload = F.coalesce(col(pages, html), F.lit("")).cast("binary")
    slim = pages.select(col(pages, page_id).cast("long").alias("page_id"), col(pages, url).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    long = slim.where(F.octet_length("payload") >= least_bytes)
    first = long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
    first = materialize(first.select("digest", "first"), "repeated-payloads")
    if first.count() <= BROADCAST_DIGESTS:
        first = F.broadcast(first)
    later = ~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull() & (F.octet_length("payload") >= least_bytes)
    rows = slim.join(first, "digest", "left").select("page_id", "url", "payload", "digest", F.when(later, F.col("first")).alias("refers_to"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                made = records(*(x.as_py() for x in row), chunk_bytes=chunk_bytes, segment_bytes=segment_bytes)
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["record"])

    made = rows.mapInArrow(make, "record binary")
    # the text writer writes a column's bytes as they are and the end of a record after each
    made.select(F.col("record").cast("string")).write.option("lineSep", _END).option("compression", "gzip").text(folder)


_PARSED = "kind string, id string, origin string, number int, total long, page_id long, digest string, refers_page long, refers_to string, block binary"


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    lines = spark.read.option("lineSep", _OPEN.decode()).text(folder).where(F.octet_length("value") > 0)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in _PARSED.split(", "))])
        number = lambda x: None if x is None else int(x)
        for batch in batches:
            rows = []
            for raw in batch.column(0):
                head, _, rest = raw.as_py().partition(b"\r\n\r\n")
                h = dict(line.split(": ", 1) for line in head.decode().split("\r\n"))
                if int(h["Content-Length"]) + len(_END) != len(rest):
                    raise ValueError(f"record {h.get('WARC-Record-ID')} is not as long as it says")
                rows.append(
                    (
                        h["WARC-Type"], h["WARC-Record-ID"], h.get("WARC-Segment-Origin-ID") or h["WARC-Record-ID"], number(h.get("WARC-Segment-Number")),
                        number(h.get("WARC-Segment-Total-Length")), number(h.get("X-Page-Id")), h.get("WARC-Payload-Digest", "").removeprefix("sha256:"),
                        number(h.get("X-Refers-To-Page")), h.get("WARC-Refers-To"), rest[: -len(_END)],
                    )
                )
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    return lines.select(F.col("value").cast("binary")).mapInArrow(parse, _PARSED)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Responses: ``id, page_id, digest, payload``; revisits have ``refers_page, refers_to`` and no payload."""
    parsed = _parsed(spark, folder)
    segments = parsed.where("number IS NOT NULL").groupBy("origin").agg(
        F.max("page_id").alias("page_id"),
        F.max(F.when(F.col("kind") != "continuation", F.col("digest"))).alias("digest"),
        F.max("total").alias("total"),
        F.count_if(F.col("number") == 1).alias("copies"),
        F.array_sort(F.collect_set(F.struct("number", "block"))).alias("parts"),
    )
    complete = F.forall(F.transform("parts", lambda p, i: p["number"] == i + 1), lambda ok: ok)
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p["block"]))
    bad = F.raise_error(F.concat(F.lit("segments do not make up record "), F.col("origin")))
    parts = F.when(complete & (F.coalesce(F.col("total"), F.lit(-1)) == length) & (F.col("copies") > 0), F.col("parts.block")).otherwise(bad.cast("array<binary>"))
    whole = segments.select(
        F.lit("response").alias("kind"), F.col("origin").alias("id"), "page_id", "digest",
        F.lit(None).cast("long").alias("refers_page"), F.lit(None).cast("string").alias("refers_to"), parts.alias("blocks"), "copies",
    )
    single = parsed.where("number IS NULL").select("kind", "id", "page_id", "digest", "refers_page", "refers_to", F.array("block").alias("blocks"), F.lit(1).cast("long").alias("copies"))
    rows = single.unionByName(whole)
    kinds = "kind string, id string, page_id long, digest string, refers_page long, refers_to string, payload binary, copies long"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = []
            for kind, digest, blocks in zip(*(batch.column(n).to_pylist() for n in ("kind", "digest", "blocks")), strict=True):
                if kind == "revisit":
                    payloads.append(None)
                    continue
                head, _, body = b"".join(blocks).partition(b"\r\n\r\n")
                payloads.append(unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body)
                if digest and hashlib.sha256(payloads[-1]).hexdigest() != digest:
                    raise ValueError("a payload does not have its digest")
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(payloads, pa.binary()), batch.column("copies")], names=[*batch.schema.names[:6], "payload", "copies"])

    read = rows.mapInArrow(decode, kinds)
    return read.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copy", "copies")


def round_trip(pages: DataFrame, **kw) -> DataFrame:
    """``pages`` archived and read back: per page what its record holds."""
    spark = pages.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    folder = scratch_path(spark, "warc")
    write(pages, folder, **kw)
    told = materialize(
        read(spark, folder).select("kind", "id", "page_id", "digest", "refers_page", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes")),
        "warc-records",
    )
    found = told.where("kind = 'response'").select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    origin = told.where("kind = 'response'").select(F.col("id").alias("r_id"), F.col("payload_bytes").alias("r_bytes")).distinct()
    again = told.where("kind = 'revisit'").drop("payload_bytes").join(origin, F.col("refers_to") == F.col("r_id"))
    again = again.select("page_id", F.col("r_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), F.col("refers_page").alias("refers_to"))
    return found.unionByName(again)
