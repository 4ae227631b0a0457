"""WARC archives: writing records, and reading them back with their segments put together.

Writing.  A record per row: a ``response`` whose block is an HTTP message with the payload
in chunked framing, or a ``revisit`` without payload that refers to the response with the
same payload.  A block above ``segment_bytes`` is cut into a first segment and ``continuation``
records (WARC-Segment-Number, -Origin-ID, and -Total-Length on the last).  Chunks also end
inside every version line in a payload, so the bytes that part records occur nowhere else
and archives can be split and read in parallel by Spark's text reader.

Reading.  Records are parsed and held against their Content-Length.  Whole records go on at
once; segments are grouped by origin identifier, put in order of segment number and checked
to be gapless and of the total length stated; only they are shuffled.  Then the HTTP head is
taken off, chunked framing is decoded and the payload is held against its digest.
Damaged records raise an error by default; ``damaged="drop"`` leaves them out.

Null and empty payloads are the empty payload.  Rows with the largest id of a payload are
responses, also if that id is repeated.  A null id is the smallest; if a payload has no other,
all its rows are responses.  Null targets are left out of the headers.  An empty table gives
an archive without records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.scratch import stage

VERSION = "WARC/1.1"
CRLF = "\r\n"
HTTP_HEAD = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             b"Transfer-Encoding: chunked\r\n\r\n")
SEGMENT_BYTES = 64 * 1024
CHUNK_BYTES = 16 * 1024
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD = ("type string, record_id string, id string, target string, digest string, refers_to string, "
          "segment int, origin string, total long, head_bytes int, block binary, fault string")
PAYLOAD = "record_id string, id string, target string, type string, refers_to string, payload binary, digest string, fault string"


def base32_sha1(data: Column) -> Column:
    """The SHA-1 of binary data in upper-case base32, as archives write it."""
    digits = F.sha1(data)
    letters = [F.substring(F.lit(BASE32), F.shiftright(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 10).cast("int"), shift)
                           .bitwiseAND(31) + 1, F.lit(1)) for i in range(8) for shift in (15, 10, 5, 0)]
    return F.concat(*letters)


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing; a chunk also ends inside every version line in the payload."""
    out, start, mark = [], 0, VERSION.encode()
    while start < len(payload):
        end = min(start + size, len(payload))
        at = payload.find(mark, start, end + len(mark))
        if at >= 0:
            end = min(end, at + 4)
        out.append(b"%x\r\n%b\r\n" % (end - start, payload[start:end]))
        start = end
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of chunked framing; extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        out.append(body[line + 2:line + 2 + size])
        at = line + 2 + size + 2
        if len(out[-1]) != size or body[at - 2:at] != b"\r\n":
            raise ValueError("chunk cut short")


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in headers if value is not None]
    lines.append(f"Content-Length: {len(block)}")
    return (CRLF.join(lines) + CRLF + CRLF).encode() + block


def _bracketed(value: str | None) -> str | None:
    """In angle brackets, so that no header line ends like a version line."""
    return None if value is None else "<" + value.replace("\r", "%0D").replace("\n", "%0A") + ">"


def records_of(record: str, id, target, payload: bytes, digest: str, refers_to, segment_bytes: int) -> Iterator[bytes]:
    """The record or records of one row, without their version lines."""
    origin = f"<urn:uuid:{record}>"
    common = [("WARC-Target-URI", _bracketed(target)), ("WARC-Date", "1970-01-01T00:00:00Z"),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Row-ID", _bracketed(id)),
              ("Content-Type", "application/http;msgtype=response")]
    if refers_to is not None:
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", origin), *common,
                       ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                       ("X-Refers-To-Row-ID", _bracketed(refers_to))], HTTP_HEAD)
        return
    block = HTTP_HEAD + chunked(payload)
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        yield _record([("WARC-Type", "response"), ("WARC-Record-ID", origin), *common], block)
        return
    yield _record([("WARC-Type", "response"), ("WARC-Record-ID", origin), ("WARC-Segment-Number", 1), *common], parts[0])
    for number, part in enumerate(parts[1:], 2):
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{origin[:-1]}:{number}>"),
                       ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Segment-Origin-ID", origin), ("WARC-Segment-Number", number),
                       ("WARC-Segment-Total-Length", len(block) if number == len(parts) else None)], part)


def parse_record(data: bytes) -> dict:
    """One record, given without its version line but with what follows its block."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split(CRLF) if ": " in line)
    length = int(fields.get("Content-Length", "-1"))
    bare = {name: fields[name][1:-1] for name in ("WARC-Target-URI", "X-Row-ID", "X-Refers-To-Row-ID") if name in fields}
    found = {"type": fields.get("WARC-Type"), "record_id": fields.get("WARC-Record-ID"), "id": bare.get("X-Row-ID"),
             "target": bare.get("WARC-Target-URI"), "digest": fields.get("WARC-Payload-Digest", "").removeprefix("sha1:"),
             "refers_to": bare.get("X-Refers-To-Row-ID"), "segment": int(fields["WARC-Segment-Number"]) if "WARC-Segment-Number" in fields else None,
             "origin": fields.get("WARC-Segment-Origin-ID"), "head_bytes": len(head),
             "total": int(fields["WARC-Segment-Total-Length"]) if "WARC-Segment-Total-Length" in fields else None,
             "block": rest[:max(length, 0)], "fault": None}
    if not gap or length < 0 or len(rest) < length or rest[length:].strip(b"\r\n"):
        found["fault"] = "length"
    return found


def with_responses(rows: DataFrame, id: str, payload: str) -> DataFrame:
    """``rows`` with ``digest`` and ``refers_to`` (null for a response).

    One row per payload is left after partial aggregation, so copies meet as counts; only
    payloads with several ids are joined back.
    """
    rows = rows.withColumn("digest", base32_sha1(F.col(payload)))
    shared = stage(rows.groupBy("digest").agg(F.max(id).alias("largest"), F.min(id).alias("least"), F.count("*").alias("n"),
                                              F.count(id).alias("ids")).where(
        "ids > 0 AND (least < largest OR ids < n)").select(F.col("digest").alias("shared"), "largest"), "warc-shared")
    joined = rows.join(shared, F.col("digest") == F.col("shared"), "left")
    return joined.withColumn("refers_to", F.when(F.col("largest").isNotNull() & ~F.col(id).eqNullSafe(F.col("largest")),
                                                 F.col("largest"))).drop("shared", "largest")


def write_archives(rows: DataFrame, path: str, id: str, target: str, payload: str,
                   segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write a record per row below ``path``, one archive per partition.

    A revisit names its response by that row's id and by the payload's digest.
    """
    archive = uuid.uuid4()
    plain = rows.select(F.col(id).cast("string").alias("id"), F.col(target).cast("string").alias("target"),
                        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"), F.col(id).alias("order"))
    ready = with_responses(plain, "order", "payload").select(
        "id", "target", "payload", "digest", F.col("refers_to").cast("string").alias("refers_to"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                found = []
                for n, row in enumerate(batch.slice(start, 256).to_pylist(), n + 1):
                    found += records_of(uuid.uuid5(archive, f"{task}-{n}"), row["id"], row["target"], row["payload"],
                                        row["digest"], row["refers_to"], segment_bytes)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["record"])

    # The separator after each row closes its record and opens the next.
    lines = ready.mapInArrow(encode, "record binary").select(F.col("record").cast("string").alias("value"))
    lines.write.option("lineSep", CRLF + CRLF + VERSION + CRLF).text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``, as columns; split and read in parallel."""
    data = spark.read.option("lineSep", VERSION + CRLF).text(path).where(F.length("value") > 0).select(
        F.col("value").cast("binary").alias("data"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("type", pa.string()), ("record_id", pa.string()), ("id", pa.string()), ("target", pa.string()),
                            ("digest", pa.string()), ("refers_to", pa.string()), ("segment", pa.int32()), ("origin", pa.string()),
                            ("total", pa.int64()), ("head_bytes", pa.int32()), ("block", pa.binary()), ("fault", pa.string())])
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                yield pa.RecordBatch.from_pylist([parse_record(v) for v in batch.slice(start, 256).column(0).to_pylist()], schema)

    return data.mapInArrow(parse, RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """Records with the blocks of their segments joined; ``fault`` names what does not add up."""
    kept = ["type", "record_id", "id", "target", "digest", "refers_to", "block", "fault"]
    whole = records.where("segment IS NULL").select(*kept)
    part = F.struct("segment", "block", "total", "type", "id", "target", "digest", "refers_to", "fault")
    grouped = (records.where("segment IS NOT NULL")
               .groupBy(F.when(F.col("segment") == 1, F.col("record_id")).otherwise(F.col("origin")).alias("record_id"))
               .agg(F.array_sort(F.collect_list(part)).alias("parts")))
    first, last = F.col("parts")[0], F.element_at("parts", -1)
    block = F.aggregate("parts", F.lit(b""), lambda joined, p: F.concat(joined, p["block"]))
    gapless = F.forall(F.sequence(F.lit(1), F.size("parts")), lambda i: F.element_at("parts", i)["segment"] == i)
    fault = (F.when(F.exists("parts", lambda p: p["fault"].isNotNull()), "length")
             .when(~gapless | last["total"].isNull(), "segment missing")
             .when(F.octet_length("block") != last["total"], "total length"))
    joined = grouped.select("record_id", "parts", block.alias("block")).select(
        first["type"].alias("type"), "record_id", first["id"].alias("id"), first["target"].alias("target"),
        first["digest"].alias("digest"), first["refers_to"].alias("refers_to"), "block", fault.alias("fault"))
    return whole.unionByName(joined)


def decode(records: DataFrame) -> DataFrame:
    """(record_id, id, target, type, refers_to, payload, digest, fault) of whole records.

    The digest is computed from the payload read; a revisit has no payload and keeps the
    digest it states.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("id", pa.string()), ("target", pa.string()), ("type", pa.string()),
                            ("refers_to", pa.string()), ("payload", pa.binary()), ("digest", pa.string()), ("fault", pa.string())])
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                out = []
                for r in batch.slice(start, 256).to_pylist():
                    payload, fault, digest = None, r["fault"], r["digest"]
                    if r["type"] == "response" and fault is None:
                        head, _, body = r["block"].partition(b"\r\n\r\n")
                        try:
                            payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
                            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                            fault = "digest" if r["digest"] and digest != r["digest"] else None
                        except ValueError:
                            fault = "chunks"
                    out.append({"record_id": r["record_id"], "id": r["id"], "target": r["target"], "type": r["type"],
                                "refers_to": r["refers_to"], "payload": payload, "digest": digest, "fault": fault})
                yield pa.RecordBatch.from_pylist(out, schema)

    return records.mapInArrow(run, PAYLOAD)


def read_archives(spark: SparkSession, path: str, damaged: str = "fail") -> DataFrame:
    """Every response and revisit below ``path`` with its payload (null for revisits).

    A damaged record raises when the result is computed, or is left out with
    ``damaged="drop"``.
    """
    found = decode(reassemble(read_records(spark, path)))
    if damaged == "fail":
        message = F.concat(F.lit("damaged record "), F.coalesce("record_id", F.lit("?")), F.lit(": "), F.col("fault"))
        found = found.withColumn("fault", F.when(F.col("fault").isNotNull(), F.raise_error(message)))
    return found.where("fault IS NULL").drop("fault")


def captures(found: DataFrame) -> DataFrame:
    """``found`` with ``payload_bytes`` of the full payload, for revisits that of their response.

    Responses that something refers to are few beside all records; sizes are joined, not payloads.
    """
    kept = ["id", "target", "payload_bytes", "digest", "type", "refers_to"]
    sizes = stage(found.withColumn("payload_bytes", F.octet_length("payload").cast("long")).select(*kept), "warc-records")
    revisits = sizes.where("type = 'revisit'").drop("payload_bytes")
    wanted = (sizes.where("type = 'response'").join(revisits.select("digest").distinct(), "digest", "left_semi")
              .groupBy("digest").agg(F.first("payload_bytes").alias("payload_bytes")))
    everything = sizes.where("type = 'response'").unionByName(revisits.join(wanted, "digest", "left"))
    return everything.select("id", "target", "payload_bytes", F.col("digest").alias("payload_digest"),
                             F.col("type").alias("record_type"), "refers_to")
