"""Web archives: write captures as WARC records, read them back, assemble transactions.

A capture is written as three records: the request, the response (or a revisit, if an
equal payload is already stored), and metadata. Request and metadata name the capture's
record in ``WARC-Concurrent-To``; a revisit names the stored response in
``WARC-Refers-To``. Reading takes the records of all archives as they come and joins
request and metadata to the response or revisit by those identifiers, whatever files
they are in: one nested row per capture.

Archives are written by Spark's text writer, whose line separator is the two line ends
that close a record, in files of a bounded number of captures, optionally compressed.
They are read as binary files, a file per row, and cut by ``Content-Length`` alone, so
payloads may hold anything.

Of equal payloads of at least ``least_bytes`` bytes, the row with the largest id is the
response. Rows are grouped by the SHA-256 of the payload; the group's maximum is a
partial aggregate, and only hashes and ids are shuffled for it.

Defined cases: a null payload counts as empty; a null url is written as empty; null ids
rank below all others; of rows that repeat an id and payload one is the response; an
empty table gives no archives and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import staged
from strata.session import scratch_dir

END = "\r\n"
CLOSE = END + END
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DATE = "2024-01-01T00:00:00Z"

RECORD = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("concurrent_to", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload", T.BinaryType()),
    ]
)


def _record_id(kind: str, id_col: Column, rest: Column) -> Column:
    name = F.concat_ws(":", F.lit(kind), F.coalesce(id_col.cast("string"), F.lit("null")), rest)
    hexed = F.md5(name.cast("binary"))
    parts = [F.substring(hexed, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _base32(hexed: Column) -> Column:
    """Of a 20-byte digest in hex: each 5 bytes are 8 letters of 5 bits."""
    letters = []
    for part in range(4):
        number = F.conv(F.substring(hexed, 10 * part + 1, 10), 16, 10).cast("long")
        for shift in range(35, -1, -5):
            at = F.shiftright(number, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substr(F.lit(_LETTERS), at.cast("int"), F.lit(1)))
    return F.concat(*letters)


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record without the two line ends that close it."""
    lines = [F.lit("WARC/1.1" + END)]
    for name, value in headers:
        line = F.concat(F.lit(name + ": "), value, F.lit(END))
        lines.append(F.when(value.isNotNull(), line).otherwise(F.lit("")))
    length = F.octet_length(block).cast("string")
    return F.concat(*lines, F.lit("Content-Length: "), length, F.lit(CLOSE), block)


def _one_line(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\r\n]", "")


def _numbered(rows: DataFrame) -> DataFrame:
    """Add ``number``: 0, or what tells rows apart that repeat an id and payload.

    Such rows are written with a number each; one of them has 0.
    """
    repeated = rows.groupBy("id", "sha").count().filter("count > 1").select(
        F.col("id").alias("_id"), F.col("sha").alias("_sha")
    )
    repeated = staged(repeated, "warc-repeated")
    if repeated.isEmpty():
        return rows.withColumn("number", F.lit(0).cast("long"))
    same = rows["id"].eqNullSafe(repeated["_id"]) & (rows["sha"] == repeated["_sha"])
    again = rows.join(repeated, same, "left_semi")
    again = staged(again.withColumn("number", F.monotonically_increasing_id()), "warc-again")
    least = again.groupBy(F.col("id").alias("_id"), F.col("sha").alias("_sha")).agg(
        F.min("number").alias("_least")
    )
    same = again["id"].eqNullSafe(least["_id"]) & (again["sha"] == least["_sha"])
    again = again.join(least, same).withColumn("number", F.col("number") - F.col("_least"))
    once = rows.join(
        repeated, rows["id"].eqNullSafe(repeated["_id"]) & (rows["sha"] == repeated["_sha"]),
        "left_anti",
    )
    return once.withColumn("number", F.lit(0).cast("long")).unionByName(
        again.drop("_id", "_sha", "_least")
    )


def captures(
    pages: DataFrame,
    least_bytes: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``value``: the three records of a capture as text, one row per row of ``pages``."""
    rows = pages.select(
        F.col(id_col).alias("id"),
        _one_line(F.col(url_col)).alias("url"),
        F.coalesce(html_col, F.lit("")).alias("html"),
    ).withColumn("sha", F.sha2("html", 256))
    large = F.octet_length("html") >= least_bytes
    first = (
        rows.filter(large)
        .groupBy("sha")
        .agg(F.max("id").alias("first"))
        .withColumnRenamed("sha", "first_sha")
    )
    told = _numbered(rows).join(first, (F.col("sha") == F.col("first_sha")) & large, "left")
    grouped = F.col("first_sha").isNotNull()
    stored = ~grouped | (F.col("id").eqNullSafe(F.col("first")) & (F.col("number") == 0))

    def record_id(kind: str, id_: Column = F.col("id"), number: Column = F.col("number")) -> Column:
        return _record_id(kind, id_, F.concat_ws(":", "sha", number))

    own = record_id("response")
    shared = [("WARC-Date", F.lit(_DATE)), ("WARC-Target-URI", F.col("url"))]
    sha1 = F.concat(F.lit("sha1:"), _base32(F.sha1(F.col("html").cast("binary"))))
    answer = F.lit("HTTP/1.1 200 OK" + END + "Content-Type: text/html; charset=utf-8" + CLOSE)
    response = _record(
        [
            ("WARC-Type", F.when(stored, "response").otherwise("revisit")),
            ("WARC-Record-ID", own),
            *shared,
            (
                "WARC-Refers-To",
                F.when(
                    ~stored,
                    record_id("response", F.col("first"), F.lit(0)),
                ),
            ),
            (
                "WARC-Profile",
                F.when(
                    ~stored,
                    "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                ),
            ),
            ("WARC-Payload-Digest", sha1),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.concat(answer, F.when(stored, F.col("html")).otherwise("")),
    )
    request = _record(
        [
            ("WARC-Type", F.lit("request")),
            ("WARC-Record-ID", record_id("request")),
            ("WARC-Concurrent-To", own),
            *shared,
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.lit("GET / HTTP/1.1" + CLOSE),
    )
    metadata = _record(
        [
            ("WARC-Type", F.lit("metadata")),
            ("WARC-Record-ID", record_id("metadata")),
            ("WARC-Concurrent-To", own),
            *shared,
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        F.when(
            F.col("id").isNotNull(), F.concat(F.lit("capture-id: "), F.col("id"), F.lit(END))
        ).otherwise(""),
    )
    return told.select(F.concat_ws(CLOSE, request, response, metadata).alias("value"))


def write_archives(
    rows: DataFrame, path: str, per_file: int = 2000, compression: str | None = "gzip"
) -> None:
    """Write captures as archives of at most ``per_file`` captures each."""
    writer = rows.write.option("lineSep", CLOSE).option("maxRecordsPerFile", per_file)
    (writer.option("compression", compression) if compression else writer).text(path)


def parse(content: bytes) -> Iterator[dict]:
    """The records of an archive, cut by their lengths; trailing line ends are skipped."""
    at = 0
    while (at := content.find(b"WARC/", at)) >= 0:
        split = content.index(b"\r\n\r\n", at)
        lines = content[at:split].decode("utf-8", "replace").split(END)[1:]
        headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        begin = split + 4
        at = begin + int(headers.get("content-length", 0))
        block = content[begin:at]
        kind = headers.get("warc-type")
        record = {
            "record_id": headers.get("warc-record-id"),
            "type": kind,
            "concurrent_to": headers.get("warc-concurrent-to"),
            "refers_to": headers.get("warc-refers-to"),
            "target_uri": headers.get("warc-target-uri"),
            "digest": headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "payload_bytes": None,
            "fields": {},
            "payload": None,
        }
        if kind == "response":
            payload = block.partition(b"\r\n\r\n")[2]
            record |= {
                "digest": base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                "payload_bytes": len(payload),
                "payload": payload,
            }
        elif kind == "metadata":
            said = (line.partition(": ") for line in block.decode().split(END) if line)
            record["fields"] = {name: value for name, _, value in said}
        yield record


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under ``path``, as they come."""
    import zlib

    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                content = batch[1][row].as_py()
                if batch[0][row].as_py().endswith(".gz"):
                    content = _gunzip(content, zlib)
                held: list[dict] = []
                for record in parse(content):
                    held.append(record)
                    if len(held) == 256:
                        yield pa.RecordBatch.from_pylist(held, _ARROW)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, _ARROW)

    return files.mapInArrow(compute, RECORD)


def _gunzip(content: bytes, zlib) -> bytes:
    """All members of a gzip file, be it one in all or one per record."""
    parts = []
    while content:
        member = zlib.decompressobj(wbits=31)
        parts += [member.decompress(content), member.flush()]
        content = member.unused_data
    return b"".join(parts)


_ARROW = pa.schema(
    [
        ("record_id", pa.string()),
        ("type", pa.string()),
        ("concurrent_to", pa.string()),
        ("refers_to", pa.string()),
        ("target_uri", pa.string()),
        ("digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("fields", pa.map_(pa.string(), pa.string())),
        ("payload", pa.binary()),
    ]
)


def assemble(records: DataFrame) -> DataFrame:
    """One row per response or revisit, with its request and metadata nested.

    Columns: record_id, type, refers_to, target_uri, digest, payload_bytes, payload,
    request (record_id, target_uri), metadata (record_id, fields).
    """
    main = records.filter(F.col("type").isin("response", "revisit"))

    def beside(kind: str, *columns: str) -> DataFrame:
        return records.filter(F.col("type") == kind).select(
            F.col("concurrent_to").alias(f"{kind}_to"), F.struct(*columns).alias(kind)
        )

    request = beside("request", "record_id", "target_uri")
    metadata = beside("metadata", "record_id", "fields")
    return (
        main.join(request, main.record_id == request.request_to, "left")
        .join(metadata, main.record_id == metadata.metadata_to, "left")
        .drop("request_to", "metadata_to", "concurrent_to", "fields")
    )


def resolve_revisits(transactions: DataFrame) -> DataFrame:
    """Give each revisit the digest and length of the payload it stands for.

    Adds ``origin``: the metadata fields of the response referred to.
    """
    stored = transactions.filter("type = 'response'").select(
        F.col("record_id").alias("stored_id"),
        F.struct("digest", "payload_bytes", F.col("metadata.fields").alias("origin")).alias("of"),
    )
    return transactions.join(stored, F.col("refers_to") == F.col("stored_id"), "left").select(
        *[
            F.coalesce(f"of.{name}", name).alias(name) if name in ("digest", "payload_bytes")
            else F.col(name)
            for name in transactions.columns
        ],
        F.col("of.origin").alias("origin"),
    )


def archived(
    pages: DataFrame,
    least_bytes: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and assemble them from there."""
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    write_archives(captures(pages, least_bytes, id_col, url_col, html_col), path)
    return resolve_revisits(assemble(read_records(spark, path)))
