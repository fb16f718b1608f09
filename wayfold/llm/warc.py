"""WARC archives without repeated payloads: revisit records point at the record that holds the body.

Only headers meet by digest; bodies travel once, to the record that is written. Archives go through Spark's text sink,
so a commit is atomic and any store that Spark reaches will do. A record's two closing line ends are the sink's line
separator; a payload may hold the same bytes, so readers put records together by Content-Length, in file order.
Files are gzip streams: Spark never splits them, so one task reads a file from front to back, record by record.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wayfold.session import durable, shared_folder

BREAK = "\r\n\r\n"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "record_id long, record_type string, url string, refers_to long, payload_digest string, payload binary"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of a binary column in upper-case base32: five hexadecimal digits are four base32 characters.

    The digits are a lambda's variable, so that a payload is hashed once and not for each character, in a branch too.
    """

    def spelt(digits: Column) -> Column:
        chars = []
        for k in range(8):
            twenty = F.conv(F.substring(digits, 5 * k + 1, 5), 16, 10).cast("int")
            chars += [F.substring(F.lit(ALPHABET), F.shiftright(twenty, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
        return F.concat(*chars)

    return F.transform(F.array(F.sha1(payload)), spelt)[0]


def resolve(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds ``record_type`` and ``refers_to`` to ``record_id, url, payload`` and keeps ``payload_bytes, payload_digest``.

    Of records with equal payloads of at least ``min_bytes`` bytes the largest id is the response. Null payloads are
    empty ones. Headers alone are combined by digest, before the shuffle, so a body that a third of all records share
    costs one row per task; joining the result back meets one row per digest and a hot digest can be split.
    """
    base = records.selectExpr("cast(record_id as long) record_id", "url", "coalesce(payload, cast('' as binary)) payload")
    headed = base.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"))
    own = headed.groupBy("payload_digest", "payload_bytes").agg(F.max("record_id").alias("holder"))
    out = headed.join(own.where(F.col("payload_bytes") >= min_bytes).select("payload_digest", "holder"), "payload_digest", "left")
    again = F.coalesce(F.col("holder") != F.col("record_id"), F.lit(False))
    return out.select(
        "record_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("holder")).alias("refers_to"),
    )


def write_archives(resolved: DataFrame, path: str, records_per_file: int = 50_000) -> None:
    """Write WARC/1.1 files with fresh headers. A revisit keeps its payload's digest and refers to the response, without body."""
    line = F.lit("\r\n")
    clean = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")
    revisit = F.col("record_type") == "revisit"
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ")
    http = F.concat(http, F.col("payload_bytes").cast("string"), F.lit(BREAK))
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("payload").cast("string")))
    name = lambda c: F.concat(F.lit("<urn:x-record:"), c.cast("string"), F.lit(">"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"), line,
        F.lit("WARC-Record-ID: "), F.coalesce(name(F.col("record_id")), F.lit("<urn:x-record:none>")), line,
        F.lit("WARC-Target-URI: "), clean, line,
        F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest"), line,
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), name(F.col("refers_to")), line)).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length("body").cast("string"), F.lit(BREAK),
    )
    text = resolved.withColumn("body", body).select(F.concat(head, F.col("body")).alias("value"))
    text.write.option("lineSep", BREAK).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def parse(lines, out_schema: pa.Schema):
    """Records from (file, piece) batches, where pieces are what stood between two breaks, in file order."""
    def opened(piece: bytes):
        """A record's fields and the length of its block; none for what stands between a record and the end of the file."""
        if not piece:
            return None, 0
        fields = dict(part.split(b": ", 1) for part in piece.split(b"\r\n")[1:] if b": " in part)
        return fields, int(fields[b"Content-Length"])

    rows: list[tuple] = []
    size = 0
    file = head = None
    have: list[bytes] = []
    got = want = 0
    for batch in lines:
        for name, piece in zip(batch.column("file").to_pylist(), batch.column("value").cast(pa.binary()).to_pylist()):
            if name != file:
                if head is not None:
                    raise ValueError(f"{file} ends inside a record")
                file = name
            if head is None:
                head, want = opened(piece)
                got, have = 0, []
                continue
            got += len(piece) + (4 if have else 0)
            have.append(piece)
            if got < want:
                continue
            block = b"\r\n\r\n".join(have)
            # A block's last line end and the break behind it hold an earlier break: what follows, up to the next one, is the next head.
            block, rest = block[:want], block[want:]
            if rest and not rest.startswith(b"\r\n\r\n"):
                raise ValueError(f"{file} has no break after a block of {want} bytes")
            payload = block.split(b"\r\n\r\n", 1)[1] if b"\r\n\r\n" in block else b""
            number = lambda key: int(v[14:-1]) if (v := head.get(key)) and v != b"<urn:x-record:none>" else None
            rows.append((
                number(b"WARC-Record-ID"), head[b"WARC-Type"].decode(), head.get(b"WARC-Target-URI", b"").decode(), number(b"WARC-Refers-To"),
                head[b"WARC-Payload-Digest"].decode().removeprefix("sha1:"), payload,
            ))
            size += len(payload)
            head, want = opened(rest[4:])
            got, have = 0, []
            if size > 1 << 24 or len(rows) >= 5000:
                yield pa.RecordBatch.from_pydict(dict(zip(out_schema.names, zip(*rows))), schema=out_schema)
                rows, size = [], 0
    if head is not None:
        raise ValueError(f"{file} ends inside a record")
    if rows:
        yield pa.RecordBatch.from_pydict(dict(zip(out_schema.names, zip(*rows))), schema=out_schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``record_id, record_type, url, refers_to, payload_digest, payload`` of every record; a revisit's payload is empty."""
    schema = to_arrow_schema(StructType.fromDDL(RECORD))
    pieces = spark.read.option("lineSep", BREAK).text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    return pieces.mapInArrow(lambda batches: parse(batches, schema), RECORD)


def with_originals(records: DataFrame) -> DataFrame:
    """Join revisits to the responses that they refer to: ``payload_bytes`` and ``payload_digest`` of the full payload.

    The length and digest of responses are taken from the bodies read. A response's side has one row per record id.
    Archives are read once; what meets is headers, from tables, so that the revisits of one hot response can be split.
    """
    full = durable(records.select(
        "record_id", "record_type", "refers_to", "payload_digest",
        F.octet_length("payload").cast("long").alias("own_bytes"), F.when(F.col("record_type") == "response", base32_sha1(F.col("payload"))).alias("own_digest"),
    ), "headers")
    kept = full.where("record_type = 'response' and record_id is not null").groupBy(F.col("record_id").alias("holder")).agg(F.first("own_bytes").alias("held_bytes"), F.first("own_digest").alias("held_digest"))
    out = full.join(durable(kept, "responses"), F.col("refers_to") == F.col("holder"), "left")
    return out.select(
        "record_id", F.coalesce("held_bytes", "own_bytes").alias("payload_bytes"), F.coalesce("held_digest", "own_digest").alias("payload_digest"), "record_type", "refers_to",
    )


def archive_folder(spark: SparkSession) -> str:
    """A new folder for one job's archives in the shared folder."""
    return f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
