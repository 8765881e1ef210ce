"""WARC archives written from and read back into tables, one nested row for each capture.

Every page becomes a response (or a revisit of an equal payload), a request and a metadata
record; the latter two name the former in WARC-Concurrent-To. Archives are gzipped text files
of whole records, so Spark's own writer and reader reach any store. Reading walks the records
by their Content-Length and joins those of a capture again.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitloom.session import materialise, scratch_path

#: Payloads below this size are stored every time.
LEAST_SHARED = 100
#: Records of one file; a file is read whole by one task.
RECORDS_PER_FILE = 12_000
#: Payload bytes handed on together when archives are read.
BATCH_BYTES = 8 << 20
CAPTURED = "1970-01-01T00:00:00Z"

_CRLF = "\r\n"


def _block(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _record(kind: Column | str, id_: Column, content_type: str, more: Column, block: Column) -> Column:
    """A record without its last line end, which the text writer adds."""
    return _block(
        "WARC/1.1\r\nWARC-Type: ", kind, "\r\nWARC-Record-ID: ", id_, f"\r\nWARC-Date: {CAPTURED}\r\n", more,
        f"Content-Type: {content_type}\r\nContent-Length: ", F.octet_length(block).cast("string"), "\r\n\r\n", block, _CRLF,
    )


def _uri(url: Column) -> Column:
    """A url on one line: white space percent-encoded, a null one as ``urn:none``."""
    safe = F.coalesce(url.cast("string"), F.lit("urn:none"))
    for c, code in ((" ", "%20"), ("\t", "%09"), ("\r", "%0D"), ("\n", "%0A")):
        safe = F.replace(safe, F.lit(c), F.lit(code))
    return safe


def _urn(seed: Column, kind: str) -> Column:
    h = F.sha2(F.concat(seed, F.lit(kind)).cast("binary"), 256)
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return _block("<urn:uuid:", F.concat_ws("-", *cuts), ">")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Write three records for each row of ``pages`` to gzipped archives below ``path``.

    Of rows with equal payloads of LEAST_SHARED bytes or more, those with the smallest id are
    responses and the others revisits of it; rows without an id and smaller payloads are
    always responses. A null payload is empty. The payload itself is shuffled only if the
    table of shared payloads is too large to broadcast.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), _uri(F.col(url_col)).alias("uri"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2(F.col("payload").cast("binary"), 256), "bytes": F.octet_length("payload").cast("long")})
    large = rows.where((F.col("bytes") >= LEAST_SHARED) & F.col("page_id").isNotNull())
    first = F.min(F.struct("page_id", "uri")).alias("first")
    shared = materialise(large.groupBy("digest").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "warc-shared")
    joined = rows.join(shared, "digest", "left").withColumn("n", F.monotonically_increasing_id())
    again = F.coalesce(F.col("first.page_id") < F.col("page_id"), F.lit(False))
    seed = F.concat_ws("/", F.col("page_id").cast("string"), F.col("n").cast("string"))
    marked = joined.withColumns({"again": again, "id": _urn(seed, "capture"), "request_id": _urn(seed, "request"), "metadata_id": _urn(seed, "metadata")})

    target, digest = _block("WARC-Target-URI: ", F.col("uri"), _CRLF), _block("WARC-Payload-Digest: sha256:", F.col("digest"), _CRLF)
    concurrent = _block(target, "WARC-Concurrent-To: ", F.col("id"), _CRLF)
    revisit = _block(
        "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To-Target-URI: ",
        F.col("first.uri"), f"\r\nWARC-Refers-To-Date: {CAPTURED}\r\n",
    )
    head = _block("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ", F.col("bytes").cast("string"), "\r\n\r\n")
    response = _record(
        F.when(F.col("again"), "revisit").otherwise("response"), F.col("id"), "application/http;msgtype=response",
        F.concat(target, digest, F.when(F.col("again"), revisit).otherwise("")), F.concat(head, F.when(F.col("again"), "").otherwise(F.col("payload"))),
    )
    request = _record("request", F.col("request_id"), "application/http;msgtype=request", concurrent, _block("GET ", F.col("uri"), " HTTP/1.1\r\n\r\n"))
    fields = F.concat_ws(
        "", F.concat(F.lit("pageId: "), F.col("page_id").cast("string"), F.lit(_CRLF)), F.lit("payloadBytes: "), F.col("bytes").cast("string"), F.lit(_CRLF),
        F.when(F.col("again"), F.concat(F.lit("refersToPage: "), F.col("first.page_id").cast("string"), F.lit(_CRLF))),
    )
    metadata = _record("metadata", F.col("metadata_id"), "application/warc-fields", concurrent, fields)
    records = marked.select(F.explode(F.array(response, request, metadata)).alias("value"))
    records.write.option("lineSep", _CRLF).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, names in lower case, and block of every record of an archive.

    A record that its length or version line does not fit raises: nothing is left out.
    """
    at = 0
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(fields["content-length"])
        if end + 4 + size > len(data):
            raise ValueError(f"the record at byte {at} is cut off")
        yield fields, data[end + 4 : end + 4 + size]
        at = end + 4 + size


_READ = (
    "record_id string, capture_id string, type string, uri string, date string, told_digest string, "
    "payload_bytes long, payload_digest string, fields map<string,string>, payload binary"
)


def _row(fields: dict[str, str], block: bytes, keep: bool) -> tuple:
    kind = fields.get("warc-type", "")
    body = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
    pairs = []
    if fields.get("content-type") == "application/warc-fields":
        pairs = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n")) if k]
    own = fields.get("warc-record-id")
    told = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
    digest = hashlib.sha256(body).hexdigest()
    return own, fields.get("warc-concurrent-to", own), kind, fields.get("warc-target-uri"), fields.get("warc-date"), told, len(body), digest, list(dict(pairs).items()), body if keep else None


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row for each record of the archives below ``path``.

    ``capture_id`` is the record named by WARC-Concurrent-To, else the record itself;
    ``payload_bytes`` and ``payload_digest`` are those of the stored payload, ``told_digest``
    the one the header states. Without ``payloads`` the payload column is null.
    """
    kinds = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]
    names = [x.split()[0] for x in _READ.replace("map<string,string>", "map").split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for content in files.column(0):
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows, size = [], 0
                for fields, block in parse(data):
                    rows.append(_row(fields, block, payloads))
                    size += len(block) if payloads else 500
                    if size > BATCH_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
                yield batch(rows)

    files = spark.read.format("binaryFile").load(path)
    return files.where("length > 0").select("content").mapInArrow(run, _READ)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row for each capture: ``capture_id, response, request, metadata``.

    Records are joined by ``capture_id``. Where a capture has several records of a kind, the
    largest by record id is taken; a capture without one has a null there. Payloads take no
    part in the grouping; they come back by record id.
    """
    record = F.struct("record_id", "type", "uri", "date", "told_digest", "payload_bytes", "payload_digest", F.map_entries("fields").alias("fields"))
    kinds = {"response": ("response", "revisit"), "request": ("request",), "metadata": ("metadata",)}
    grouped = records.groupBy("capture_id").agg(*[F.max(F.when(F.col("type").isin(*k), record)).alias(name) for name, k in kinds.items()])
    return grouped.withColumns({name: F.col(name).withField("fields", F.map_from_entries(F.col(name)["fields"])) for name in kinds})


def with_payloads(captures: DataFrame, records: DataFrame) -> DataFrame:
    """Captures with the payload of their response."""
    bodies = records.where("type = 'response'").select(F.col("record_id").alias("_id"), "payload")
    return captures.join(bodies, captures.response.record_id == bodies["_id"], "left").drop("_id")


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back and assemble captures.

    Returns ``(page_id, payload_bytes, payload_digest, record_type, refers_to, intact)`` for
    every row of ``pages``. A revisit has no payload of its own: its size and digest are those
    its records state. ``intact`` is false if a stored payload does not fit its stated digest.
    """
    spark, path = pages.sparkSession, scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, id_col, url_col, payload_col)
    captures = assemble(materialise(read_records(spark, path, payloads=False), "warc-records"))
    kind, told = F.col("response.type"), F.col("metadata.fields")
    stored = kind == "response"
    return captures.select(
        told["pageId"].cast("long").alias("page_id"),
        F.when(stored, F.col("response.payload_bytes")).otherwise(told["payloadBytes"].cast("long")).alias("payload_bytes"),
        F.when(stored, F.col("response.payload_digest")).otherwise(F.col("response.told_digest")).alias("payload_digest"),
        kind.alias("record_type"), told["refersToPage"].cast("long").alias("refers_to"),
        (~stored | (F.col("response.payload_digest") == F.col("response.told_digest"))).alias("intact"),
    )
