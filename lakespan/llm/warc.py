"""WARC archives with content-addressed payloads.

An archive is a folder. Payload bytes stand once under their SHA-256 in `payloads`, a table bucketed by it; record
headers stand in `headers`, exactly as they are in the files; `warc` has the files themselves, named .warc.gz, each
record a gzip member of its own; `index` tells file, offset and length of each record's member. The join that puts
records together moves headers only, and checks each payload against its address. Tasks write their files to the
shared folder through Arrow's file systems; those of lost attempts are none of the index's and are deleted.

reconstruct() gives every page's full record back by joining headers with payloads. read() reads the files as
streams: it cuts records by Content-Length over the decompressed bytes and checks every payload against its SHA-1;
resolve() finds what revisits stand for by a join with the responses.

Defined cases: a null payload is empty; a null url leaves the target header out; control characters in a url
are percent-encoded; rows that tie for the largest page_id of a payload are all responses; a row without
page_id is a revisit where its payload has a response with an id, else a response; payloads may end in any way and be
as long as a row can be; other columns are left out; an empty table gives an archive without records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakespan.llm.scratch import Scratch

LEAST_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
#: A file is closed when it has that many bytes.
FILE_BYTES = 128_000_000
_END = b"\r\n\r\n"


def _lines(*parts):
    """The parts that aren't null, each with its line end."""
    return F.concat(*(F.coalesce(F.concat(*(F.lit(x) if isinstance(x, str) else x for x in p), F.lit("\r\n")), F.lit("")) for p in parts))


def _uri(c):
    return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))


def addressed(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) with payload, bytes, sha1 and address."""
    rows = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("payload"))
    raw = F.col("payload").cast("binary")
    return rows.select("*", F.octet_length("payload").cast("long").alias("bytes"), F.sha1(raw).alias("sha1"), F.sha2(raw, 256).alias("address"))


def headers(rows: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, address, header, stored): exact headers of rows that have their payload's response_id."""
    revisit = (F.col("bytes") >= least_bytes) & F.col("response_id").isNotNull() & ~F.col("response_id").eqNullSafe(F.col("page_id"))
    rows = rows.withColumn("revisit", revisit)
    own = F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("bytes"))
    http = _lines(("HTTP/1.1 200 OK",), ("Content-Type: text/html; charset=utf-8",), ("Content-Length: ", own.cast("string")))
    rows = rows.withColumn("http", http)
    head = _lines(
        ("WARC/1.1",),
        ("WARC-Type: ", F.when(F.col("revisit"), "revisit").otherwise("response")),
        ("WARC-Record-ID: ", _uri(F.col("page_id"))),
        ("WARC-Date: ", DATE),
        ("WARC-Target-URI: ", F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")),
        ("WARC-Payload-Digest: sha1:", F.col("sha1")),
        ("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", F.when(F.col("revisit"), "")),
        ("WARC-Refers-To: ", F.when(F.col("revisit"), _uri(F.col("response_id")))),
        ("Content-Type: application/http;msgtype=response",),
        ("Content-Length: ", (F.octet_length("http") + 2 + own).cast("string")),
    )
    return rows.select("page_id", "url", "address", F.concat(head, F.lit("\r\n"), F.col("http"), F.lit("\r\n")).alias("header"), (~F.col("revisit")).alias("stored"))


def _files(path: str):
    """Arrow's file system of a path or URI, and the path there."""
    return FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def write(pages: DataFrame, scratch: Scratch, least_bytes: int = LEAST_BYTES, file_bytes: int = FILE_BYTES) -> str:
    """Write pages as an archive; its folder."""
    spark, out = pages.sparkSession, scratch.path("archive")
    n, blobs = int(spark.conf.get("spark.sql.shuffle.partitions")), f"lakespan_blobs_{uuid.uuid4().hex[:12]}"
    rows = addressed(pages)
    # Copies of a payload melt into one row before anything is shuffled, and the bytes are shuffled this once.
    store = rows.groupBy("address").agg(F.first("payload").alias("payload"), F.max("page_id").alias("response_id"))
    try:
        store.write.bucketBy(n, "address").option("compression", "zstd").option("path", f"{out}/payloads").format("parquet").saveAsTable(blobs)
        light = rows.drop("payload").join(spark.table(blobs).select("address", "response_id"), "address")
        headers(light, least_bytes).write.parquet(f"{out}/headers")
        heads = spark.read.parquet(f"{out}/headers")
        stored = heads.where("stored").join(spark.table(blobs).select("address", F.col("payload").cast("binary").alias("payload")), "address").select("page_id", "header", "address", "payload")
        records = stored.unionByName(heads.where("not stored").select("page_id", "header"), allowMissingColumns=True)
        fs, folder = _files(out)
        fs.create_dir(f"{folder}/warc")
        records.mapInArrow(_writer(f"{out}/warc", file_bytes), "page_id long, file string, offset long, length long").write.parquet(f"{out}/index")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {blobs}")  # the files stay
    known = spark.read.parquet(f"{out}/index").select("file").distinct()
    lost = files(spark, out).select(F.substring_index("path", "/", -1).alias("file")).join(known, "file", "left_anti")
    for r in lost.toLocalIterator():
        fs.delete_file(f"{folder}/warc/{r['file']}")
    return out


def _writer(folder: str, most: int):
    """A function of batches (page_id, header, address, payload) that writes records to files and tells where each is."""

    def run(batches):
        fs, at = _files(folder)
        part, name, f, offset = TaskContext.get().partitionId(), None, None, 0
        for b in batches:
            rows = []
            for page, head, address, payload in zip(*b.columns, strict=True):
                payload = payload.as_py() or b""
                if address.is_valid and hashlib.sha256(payload).hexdigest() != address.as_py():
                    raise ValueError(f"page {page}: payload doesn't match its address")
                if f is None:
                    name, offset = f"part-{part:05d}-{uuid.uuid4().hex[:12]}.warc.gz", 0
                    f = fs.open_output_stream(f"{at}/{name}", compression=None)
                z = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = z.compress(head.as_py().encode()) + z.compress(payload) + z.compress(_END) + z.flush()
                f.write(member)
                rows.append((page.as_py(), name, offset, len(member)))
                offset += len(member)
                if offset >= most:
                    f.close()
                    f = None
            yield _batch(rows, [("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
        if f is not None:
            f.close()

    return run


def _batch(rows: list, fields: list) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields, strict=True)], [n for n, _ in fields])


def reconstruct(spark: SparkSession, archive: str) -> DataFrame:
    """(page_id, url, header, payload) of every record, revisits with the payload they stand for."""
    fail = F.raise_error(F.lit("a payload doesn't match its address")).cast("binary")
    kept = spark.read.parquet(f"{archive}/payloads").select("address", F.col("payload").cast("binary").alias("payload"))
    kept = kept.withColumn("payload", F.when(F.sha2("payload", 256) == F.col("address"), F.col("payload")).otherwise(fail))
    return spark.read.parquet(f"{archive}/headers").join(kept, "address").select("page_id", "url", "header", "payload")


def inflated(f, size: int = 1 << 20):
    """The decompressed bytes of a stream of gzip members, in pieces."""
    z = zlib.decompressobj(31)
    while data := f.read(size):
        while data:
            yield z.decompress(data)
            data = z.unused_data
            if z.eof:
                z = zlib.decompressobj(31)
    yield z.flush()


def parse(pieces):
    """(header fields, payload) of the records in pieces of bytes; fails on broken ones.

    A block is as long as its Content-Length, whatever its bytes say, and CR LF CR LF is behind it."""
    it, held, ended = iter(pieces), bytearray(), False

    def more() -> bool:
        nonlocal ended
        piece = next(it, None)
        ended = piece is None
        held.extend(piece or b"")
        return not ended

    while True:
        at = held.find(_END)
        while at < 0 and more():
            at = held.find(_END)
        if at < 0:
            if held:
                raise ValueError(f"the file ends within a header: {bytes(held[:60])!r}")
            return
        if not held.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {bytes(held[:60])!r}")
        fields = dict(x.split(b": ", 1) for x in bytes(held[:at]).split(b"\r\n")[1:])
        first, size = at + 4, int(fields[b"Content-Length"])
        while len(held) < first + size + 4 and more():
            pass
        if held[first + size : first + size + 4] != _END:
            raise ValueError(f"record {fields[b'WARC-Record-ID']!r} doesn't end after {size} bytes")
        yield fields, bytes(held[first : first + size]).partition(_END)[2]
        del held[: first + size + 4]


def files(spark: SparkSession, archive: str) -> DataFrame:
    """(path) of an archive's files; their bytes aren't read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(f"{archive}/warc").select("path")


def read(spark: SparkSession, archive: str, payloads: bool = False) -> DataFrame:
    """Records of an archive: page_id, url, record_type, refers_to, payload_bytes, payload_digest (of what is
    stored; null for revisits), declared_digest, and the payload if asked for."""
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("declared_digest", pa.string())] + [("payload", pa.binary())] * payloads

    def number(x: bytes | None):
        x = (x or b"<urn:page:none>")[10:-1]
        return None if x == b"none" else int(x)

    def records(path: str):
        fs, at = _files(path)
        with fs.open_input_stream(at, compression=None) as f:
            yield from parse(inflated(f))

    def run(batches):
        rows, held = [], 0
        for f, payload in (r for b in batches for path in b.column(0).to_pylist() for r in records(path)):
            kind, said = f[b"WARC-Type"].decode(), f[b"WARC-Payload-Digest"].decode()[5:]
            own = None if kind == "revisit" else hashlib.sha1(payload).hexdigest()
            if own not in (None, said):
                raise ValueError(f"record {f[b'WARC-Record-ID']!r}: payload doesn't match its digest")
            url = f.get(b"WARC-Target-URI")
            rows.append((number(f[b"WARC-Record-ID"]), url and url.decode(), kind, number(f.get(b"WARC-Refers-To")), len(payload) if own else None, own, said) + (payload,) * payloads)
            held += len(payload) * payloads
            if len(rows) >= 5000 or held > 16_000_000:
                yield _batch(rows, fields)
                rows, held = [], 0
        if rows:
            yield _batch(rows, fields)

    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, declared_digest string" + ", payload binary" * payloads
    return files(spark, archive).mapInArrow(run, schema)


def resolve(records: DataFrame) -> DataFrame:
    """Records with the size and digest of the full payload, revisits through the response they refer to."""
    to = records.where("record_type = 'response' and page_id is not null").select(F.col("page_id").alias("to"), F.col("payload_bytes").alias("b"), F.col("payload_digest").alias("d")).dropDuplicates(["to", "d"])
    same = (records["refers_to"] == to["to"]) & (records["declared_digest"] == to["d"])
    return records.join(to, same, "left").select("page_id", F.coalesce("payload_bytes", "b").alias("payload_bytes"), F.coalesce("payload_digest", "d").alias("payload_digest"), "record_type", "refers_to")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Scratch(spark, "warc")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    records = s.cut(read(spark, write(pages, s)), "records")
    return resolve(records)


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
q AS (SELECT page_id, n, sha1(html) AS d, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
FROM q
"""
