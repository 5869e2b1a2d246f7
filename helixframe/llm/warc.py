"""WARC archives: writing captures, reading archives back, transaction assembly.

A capture is three records: request, response (or revisit) and metadata. The request and the metadata name the capture's
response by WARC-Concurrent-To; reading joins them on that identifier and emits one nested row per capture. Payloads
equal to an earlier capture's are revisits that refer to it.

Archives follow WARC 1.1: each file opens with a warcinfo record, each record is a gzip member of its own, responses hold an
HTTP head and the payload, digests of block and payload are stated, and a file is closed once it has `archive_bytes`. Tasks
write and read through pyarrow's file systems (local, HDFS, object stores), one record in memory at a time. A task names its
files by its attempt; the list of the files of the attempts that counted is written last, and only those are read, so a
repeated or lost attempt leaves nothing behind in a result.

Defined cases: a null payload is empty; null urls become "urn:none"; page_ids are the key, of repeated rows with the same
page_id each is a capture of its own; a page without page_id revisits an equal page that has one; an empty table gives an
empty result; very long pages are single records; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import fresh_path, skewed_join, slices, table
from helixframe.sources.binary import open_fs

CRLF = "\r\n"
#: Fixed values of RFC 4648: the base-32 alphabet.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "record_id string, warc_type string, target string, concurrent_to array<string>, refers_to string, refers_to_id string, page_id long, http_head string, block binary, payload_bytes long, payload_digest string, head string"
NAMES = [x.strip().split(" ")[0] for x in RECORD.split(",")]
TYPES = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "block": pa.binary(), "concurrent_to": pa.list_(pa.string())}
ARCHIVE_BYTES = 256 << 20
STAMP = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base-32 SHA-1: ten hexadecimal digits are eight letters. The digest is bound as a lambda's variable,
    so it is computed once a row."""

    def letters(d: Column) -> Column:
        return F.translate(F.concat(*(F.lpad(F.conv(F.substring(d, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4))), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)

    return F.transform(F.array(F.sha1(payload)), letters)[0]


def sha1_32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def captures(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload, digest (hexadecimal), and of the capture that it revisits, if there is one: page_id, url, and
    whether that page_id has one row alone. Payloads of fewer than `least` bytes revisit nothing. Pages are shuffled once;
    a payload that very many pages share is dealt over several tasks."""
    html = F.coalesce(F.col("html"), F.lit(""))
    url = F.coalesce("url", F.lit("urn:none"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), html.alias("payload"), F.sha1(F.encode(html, "UTF-8")).alias("digest"))
    counted = rows.where(F.octet_length("payload") >= least).groupBy("digest", "page_id").agg(F.count("*").alias("n"), F.min("url").alias("url"))
    named = F.col("page_id").isNotNull()
    first = F.min(F.when(named, F.struct("page_id", "n", "url")))
    copies = counted.groupBy("digest").agg(first.alias("first"), F.sum("n").alias("copies")).where("copies > 1 and first is not null")
    told = copies.select("digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"), (F.col("first.n") == 1).alias("alone"))
    joined = skewed_join(rows, told, ["digest"], ["page_id", "url"], "left")
    again = F.col("first_id").isNotNull() & ~F.coalesce(F.col("page_id") == F.col("first_id"), F.lit(False))
    mine = F.coalesce(F.col("page_id") == F.col("first_id"), F.lit(False))
    # a record's id can be told from its page alone where no other row has the same page_id and payload
    return joined.select("page_id", "url", "payload", "digest", *(F.when(again, F.col(c)).alias(c) for c in ("first_id", "first_url")), F.coalesce(F.when(again, F.col("alone")), F.lit(False)).alias("linked"), F.when(mine, F.col("alone")).otherwise(F.col("first_id").isNull() & named).alias("plain"))


def member(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record as a gzip member; headers without a value are left out."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None) + f"Content-Length: {len(block)}\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(head.encode("utf-8", "surrogatepass")) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def one_line(text: str) -> str:
    return text.replace("\r", "%0D").replace("\n", "%0A")


def records_of(page_id: int | None, url: str, payload: str, digest: str, first_id: int | None, first_url: str | None, linked: bool, plain: bool, run: str, place: str, stamp: str) -> bytes:
    """The three records of a capture."""
    data = payload.encode("utf-8", "surrogatepass")
    name = lambda kind, *key: f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5('|'.join(map(str, (run, kind, *key))).encode()).digest())}>"
    key = (page_id, digest) if plain else (place,)
    own = name("response", *key)
    sha = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    target = one_line(url)
    common = [("WARC-Date", stamp), ("WARC-Target-URI", target), ("X-Page-Id", None if page_id is None else str(page_id))]
    host = target.partition("://")[2].partition("/")[0]
    asked = f"GET / HTTP/1.1\r\nHost: {host}\r\n\r\n".encode("utf-8", "surrogatepass")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(data)}\r\n\r\n".encode()
    again = first_id is not None
    block = head if again else head + data
    refers = [
        ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", name("response", first_id, digest) if linked else None), ("WARC-Refers-To-Target-URI", one_line(first_url or "")),
        ("WARC-Refers-To-Date", stamp), ("X-Refers-To-Page", str(first_id)),
    ] if again else []
    told = f"payloadBytes: {len(data)}\r\n".encode()
    return b"".join([
        member([("WARC-Type", "request"), ("WARC-Record-ID", name("request", *key)), *common, ("WARC-Concurrent-To", own), ("WARC-Block-Digest", f"sha1:{sha1_32(asked)}"), ("Content-Type", "application/http;msgtype=request")], asked),
        member([("WARC-Type", "revisit" if again else "response"), ("WARC-Record-ID", own), *common, ("WARC-Payload-Digest", sha), ("WARC-Block-Digest", f"sha1:{sha1_32(block)}"), *refers, ("Content-Type", "application/http;msgtype=response")], block),
        member([("WARC-Type", "metadata"), ("WARC-Record-ID", name("metadata", *key)), *common, ("WARC-Concurrent-To", own), ("WARC-Concurrent-To", name("request", *key)), ("Content-Type", "application/warc-fields")], told),
    ])


def write_archives(pages: DataFrame, path: str, least: int = 0, stamp: str = STAMP, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write request, response or revisit, and metadata of every capture under `path`, and last the list of the files."""
    spark, run_id = pages.sparkSession, uuid.uuid4().hex
    fs, root = open_fs(path)
    fs.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        own, folder = open_fs(path)
        out, done, n, size, row = None, [], 0, 0, 0

        def told() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([done[-1]], pa.string()), pa.array([n], pa.int64()), pa.array([size], pa.int64())], names=["name", "records", "bytes"])

        for b in slices(batches, 64):
            for values in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    done.append(f"part-{task.partitionId():06d}-{len(done):04d}-{task.taskAttemptId()}.warc.gz")
                    out = own.open_output_stream(f"{folder}/{done[-1]}", compression=None)
                    info = b"software: helixframe\r\nformat: WARC File Format 1.1\r\n"
                    size = out.write(member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", stamp), ("WARC-Filename", done[-1]), ("Content-Type", "application/warc-fields")], info))
                    n = 1
                data = records_of(*values, run_id, f"{task.partitionId()}-{row}", stamp)
                out.write(data)
                n, size, row = n + 3, size + len(data), row + 1
                if size >= archive_bytes:
                    yield told()
                    out = None
        if out is not None:
            yield told()

    files = captures(pages, least).mapInArrow(run, "name string, records long, bytes long").collect()  # a row for each archive
    spark.createDataFrame(files, "name string, records long, bytes long").coalesce(1).write.mode("overwrite").parquet(f"{path}/_files")


def members(stream, piece: int = 1 << 20) -> Iterator[bytes]:  # noqa: ANN001
    """The records of an archive, one after another; a gzip member holds one."""
    z, held, rest = zlib.decompressobj(31), [], b""
    while data := rest or stream.read(piece):
        held.append(z.decompress(data))
        rest = z.unused_data
        if z.eof:
            yield b"".join(held)
            z, held = zlib.decompressobj(31), []
    if any(held):
        raise ValueError("truncated archive")


def parse(data: bytes) -> tuple[dict[str, list[str]], bytes, str]:
    """Headers by lower-case name (each may come more than once), block and head of a record."""
    end = data.index(b"\r\n\r\n")
    head = data[:end].decode("utf-8", "surrogatepass")
    fields: dict[str, list[str]] = {}
    for line in head.split(CRLF)[1:]:
        k, _, v = line.partition(":")
        fields.setdefault(k.strip().lower(), []).append(v.strip())
    n = int(fields["content-length"][0])
    block = data[end + 4 : end + 4 + n]
    if len(block) != n:
        raise ValueError("truncated record")
    return fields, block, head


def row_of(fields: dict[str, list[str]], block: bytes, head: str, blocks: bool) -> tuple:
    """A record's row in the order of RECORD. Size and digest of a response are those of the payload as read, and must be
    the digest that the record states; a revisit has the digest that it states."""
    one = lambda k: fields.get(k, [None])[0]
    kind, http = one("warc-type"), None
    if (one("content-type") or "").startswith("application/http") and (cut := block.find(b"\r\n\r\n")) >= 0:
        http, block = block[: cut + 4].decode("latin-1"), block[cut + 4 :]
    stated = (one("warc-payload-digest") or "").removeprefix("sha1:") or None
    measured = kind == "response"
    digest = sha1_32(block) if measured else stated
    if stated and digest != stated:
        raise ValueError(f"payload of {one('warc-record-id')} differs from its digest")
    page = one("x-page-id")
    return (one("warc-record-id"), kind, one("warc-target-uri"), fields.get("warc-concurrent-to"), one("x-refers-to-page"), one("warc-refers-to"), int(page) if page else None, http if blocks else None, block if blocks or not measured else None, len(block) if measured else None, digest, head if blocks else None)


def read_records(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """One row per record of the archives that `path` lists, but for warcinfo. Without `blocks`, payloads and heads are
    dropped once measured."""
    listed = spark.read.schema("name string, records long, bytes long").parquet(f"{path}/_files")
    n = max(1, listed.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, TYPES.get(x, pa.string())) for x, c in zip(NAMES, zip(*rows, strict=True), strict=True)], names=NAMES)

        own, folder = open_fs(path)
        for b in batches:
            for name in b.column(0).to_pylist():
                rows, held = [], 0
                with own.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for data in members(stream):
                        fields, block, head = parse(data)
                        if fields["warc-type"] == ["warcinfo"]:
                            continue
                        rows.append(row_of(fields, block, head, blocks))
                        held += len(block) if blocks else 0
                        if held > 8_000_000 or len(rows) == 4096:
                            yield out(rows)
                            rows, held = [], 0
                if rows:
                    yield out(rows)

    return listed.select("name").repartition(n, "name").mapInArrow(run, RECORD)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, and the requests and metadata that name it in one of their
    concurrent-to identifiers (arrays by record id, empty where there are none)."""
    own = F.struct(*(c for c in records.columns if c != "concurrent_to"))
    is_main = F.col("warc_type").isin("response", "revisit")
    of = F.when(is_main, F.array("record_id")).otherwise(F.array_distinct("concurrent_to"))
    named = records.where(is_main | F.col("warc_type").isin("request", "metadata")).select(F.explode(of).alias("capture_id"), "warc_type", own.alias("r"))
    side = lambda kind: F.sort_array(F.collect_list(F.when(F.col("warc_type") == kind, F.col("r")))).alias(kind)
    main = F.any_value(F.when(F.col("warc_type").isin("response", "revisit"), F.col("r")), ignoreNulls=F.lit(True)).alias("response")
    return named.groupBy("capture_id").agg(side("request"), main, side("metadata")).where("response is not null").select("capture_id", "request", "response", "metadata")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    t = transactions(read_records(spark, path, blocks=False))
    size = F.regexp_extract(F.decode(F.get("metadata", F.lit(0))["block"], "UTF-8"), "payloadBytes: ([0-9]+)", 1).cast("long")
    return t.select(
        F.col("response.page_id").alias("page_id"),
        F.coalesce("response.payload_bytes", size).alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.warc_type").alias("record_type"),
        F.col("response.refers_to").cast("long").alias("refers_to"),
    )


#: The 160 bits of the digest as text, five at a time; a group's five bits index the alphabet.
OP4_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hex FROM p),
b AS (SELECT *, array_to_string(list_transform(range(40), lambda i:
  substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (instr('0123456789abcdef', substr(hex, i + 1, 1)) - 1) + 1, 4)), '') AS bits FROM h),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('{BASE32}', 1
  + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT)
  + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT) + CAST(substr(bits, 5 * i + 5, 1) AS INT), 1)), '') AS payload_digest FROM b),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d GROUP BY payload_digest)
SELECT d.page_id, CAST(d.payload_bytes AS BIGINT) AS payload_bytes, d.payload_digest,
  CASE WHEN d.page_id = f.first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN d.page_id = f.first_id THEN NULL ELSE f.first_id END AS refers_to
FROM d JOIN f USING (payload_digest)
"""
