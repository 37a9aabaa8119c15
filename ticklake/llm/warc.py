"""WARC archives: write captures as records, read them back, assemble transactions.

A capture is three records: the request, the response (or a revisit, when an equal payload
is already the response of another capture) and metadata; request and metadata name the
response in WARC-Concurrent-To. Archives are written by Spark's text writer, whose line
separator is the blank lines that end a record, as gzip files of at most RECORDS_PER_FILE
records, and read as binary files (plain or gzip, unpacked as they are read) whose records
are cut by their Content-Length, so a payload may hold anything.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.common import Scratch, byte_slices, drop_path, scratch_path, utf8

#: Fixed value: the archives' date, so that reruns write the same bytes.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of payloads that a worker composes at once.
SLICE_BYTES = 1 << 20
#: Records of one archive, at most: a reader holds one packed archive and one record.
RECORDS_PER_FILE = 12_000
RECORD = ("record_id string, type string, concurrent_to string, refers_to string, target_uri string, "
          "payload_digest string, payload binary, payload_bytes long, true_digest string, capture_key long")


def digest32(hex_digest: str) -> str:
    """A hexadecimal SHA-1 as bare upper-case base32."""
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _urn(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def _record(kind: str, record_id: str, fields: list[tuple[str, str]], block: str) -> str:
    """Header and block; the writer appends the two line ends after the block."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", DATE), *fields,
            ("Content-Length", str(len(block.encode())))]
    return "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n" + block


def _uri(url: str | None) -> str:
    """A header value on one line: what would break it is percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")


def _transaction(r: dict) -> Iterator[str]:
    """The three records of a capture."""
    first = r["first_key"] == r["capture_key"]
    own = _urn("capture", r["capture_key"])
    uri = [("WARC-Target-URI", _uri(r["url"]))]
    sha = [("WARC-Payload-Digest", "sha1:" + digest32(r["sha"]))]
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {r['size']}\r\n\r\n")
    kind = [("Content-Type", "application/http; msgtype=response")]
    if first:
        yield _record("response", own, uri + sha + kind, http + r["html"])
    else:
        yield _record("revisit", own, uri + sha + kind + [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", _urn("capture", r["first_key"]))], http)
    host, _, path = _uri(r["url"]).partition("://")[2].partition("/")
    yield _record("request", _urn("request", r["capture_key"]), uri + [
        ("WARC-Concurrent-To", own), ("Content-Type", "application/http; msgtype=request")],
        f"GET /{path} HTTP/1.1\r\nHost: {host}\r\n\r\n")
    yield _record("metadata", _urn("metadata", r["capture_key"]), uri + [
        ("WARC-Concurrent-To", own), ("Content-Type", "application/warc-fields")],
        f"capture-key: {r['capture_key']}\r\n")


def _compose(batches):
    for batch in batches:
        # a megabyte of payloads at a time: a batch is never held as Python strings whole
        for i, j in byte_slices(utf8(batch.column("html"))[1], SLICE_BYTES):
            out = [record for r in batch.slice(i, j - i).to_pylist() for record in _transaction(r)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])


def write_archives(captures: DataFrame, path: str, scratch: Scratch, min_bytes: int = 0,
                   records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write (capture_key, order_key, url, html) as archives under ``path``.

    Of captures with equal payloads of at least ``min_bytes`` bytes the one with the least
    ``order_key`` (ties: ``capture_key``) is the response and the others revisit it. Keys
    are unique. A null url is an empty target. An archive holds at most ``records_per_file``
    records.
    """
    rows = captures.withColumns({
        "html": F.coalesce("html", F.lit("")), "size": F.octet_length(F.coalesce("html", F.lit("")))})
    rows = rows.withColumn("sha", F.sha1("html"))
    # (order, key) of the first of each payload; a partial aggregate runs before the shuffle
    first = scratch.keep(rows.where(F.col("size") >= min_bytes).groupBy("sha").agg(
        F.min(F.struct(F.col("order_key").isNull().alias("last"), "order_key", "capture_key")).alias("f"))
        .select("sha", F.col("f.capture_key").alias("first_key")), "first")
    told = rows.join(first, "sha", "left").withColumn("first_key", F.when(
        F.col("size") >= min_bytes, F.col("first_key")).otherwise(F.col("capture_key")))
    # a revisit carries no payload to the worker
    told = told.withColumn("html", F.when(F.col("first_key") == F.col("capture_key"), F.col("html")))
    (told.select("capture_key", "first_key", "url", "html", "size", "sha")
     .mapInArrow(_compose, "value string").write.option("maxRecordsPerFile", records_per_file)
     .option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path))


def records(content: bytes | io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record of an archive, given as
    bytes or as a stream."""
    stream = io.BytesIO(content) if isinstance(content, bytes) else content
    while first := stream.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {first[:40]!r}")
        fields = {}
        while line := stream.readline().rstrip(b"\r\n"):
            name, _, value = line.decode("utf-8").partition(":")
            fields[name.strip().lower()] = value.strip()
        if "content-length" not in fields:
            raise ValueError("a record has no length")
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"a record of {size} bytes does not end there")
        yield fields, block


def _unpacked(content: bytes) -> io.BufferedIOBase:
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 18) if content[:2] == b"\x1f\x8b" else raw


def _parse(with_payload: bool):
    def row(fields: dict[str, str], block: bytes) -> tuple:
        kind = fields["warc-type"]
        payload, key, digest, size = None, None, None, None
        if kind == "response":
            body = block[block.index(b"\r\n\r\n") + 4:]
            digest, size = base64.b32encode(hashlib.sha1(body).digest()).decode(), len(body)
            payload = body if with_payload else None
        elif kind == "metadata":
            key = int(block.decode().partition("capture-key:")[2].strip())
        return (fields["warc-record-id"], kind, fields.get("warc-concurrent-to"),
                fields.get("warc-refers-to"), fields.get("warc-target-uri"),
                fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                payload, size, digest, key)

    types = [pa.string()] * 6 + [pa.binary(), pa.int64(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in RECORD.split(", ")]

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for fields, block in records(_unpacked(content.as_py())):
                    held.append(row(fields, block))
                    size += len(block) if with_payload else 200
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)
    return run


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``; damage is an error."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_parse(with_payload), RECORD)


def assemble(recs: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit joined with the request and
    metadata that name it in WARC-Concurrent-To.

    Columns: record_id, record_type, target_uri, capture_key (of the metadata),
    refers_to (a record id or null), payload_digest, payload, payload_bytes, true_digest
    (the last three of the response's own block, null for a revisit), request and metadata
    (structs, null where the archive has none).
    """
    base = recs.where("type in ('response', 'revisit')").select(
        "record_id", F.col("type").alias("record_type"), "target_uri", "refers_to",
        "payload_digest", "payload", "payload_bytes", "true_digest")
    request = recs.where("type = 'request'").select(
        F.col("concurrent_to").alias("record_id"), F.struct("record_id", "target_uri").alias("request"))
    metadata = recs.where("type = 'metadata'").select(
        F.col("concurrent_to").alias("record_id"), "capture_key",
        F.struct("record_id", "capture_key").alias("metadata"))
    return base.join(request, "record_id", "left").join(metadata, "record_id", "left")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Archive every row of ``pages``, read the archives back, one row per capture:
    (id, payload_bytes, payload_digest, record_type, refers_to).

    payload_bytes and payload_digest are those of the full payload as read back: a revisit
    takes them from the response that it refers to. A null html is an empty payload. Rows
    that share an id are captures of their own; of equal payloads the least id is the
    response (null ids last; of repeated rows any one). An empty table gives an empty
    result. Other columns of ``pages`` are not archived.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark)
    # written once, so the keys of the captures stay what they are
    base = scratch.keep(pages.select(
        F.monotonically_increasing_id().alias("capture_key"), F.col(id_col).alias("order_key"),
        F.col(url_col).alias("url"), F.col(html_col).alias("html")), "captures")
    path = scratch_path(spark, "warc")
    write_archives(base, path, scratch, min_bytes)
    keys = scratch.keep(base.select("capture_key", F.col("order_key").alias("id")), "keys")
    scratch.close(keys)
    flat = read_records(spark, path, with_payload=False)
    got = scratch.keep(assemble(scratch.keep(flat, "records")).drop("payload", "request", "metadata"), "got")
    # keys and sources grow with the pages: shuffle joins at every size, never broadcasts
    own = got.join(keys.hint("merge"), "capture_key")
    # the responses that some revisit refers to
    cited = scratch.keep(got.where("refers_to is not null").select(F.col("refers_to").alias("record_id"))
                         .distinct(), "cited")
    source = scratch.keep(own.join(cited.hint("merge"), "record_id", "left_semi").select(
        F.col("record_id").alias("refers_to"), F.col("id").alias("refers_id"),
        F.col("payload_bytes").alias("b"), F.col("true_digest").alias("d")), "source")
    out = own.join(source.hint("merge"), "refers_to", "left").select(
        F.col("id").alias(id_col), F.coalesce("payload_bytes", "b").alias("payload_bytes"),
        F.coalesce("true_digest", "d").alias("payload_digest"), "record_type",
        F.when(F.col("record_type") == "revisit", F.col("refers_id")).alias("refers_to"))
    out = scratch.keep(out, "captures-read")
    scratch.close(out)
    drop_path(spark, path)
    return out
