"""Content-addressed WARC archive.

An archive is two tables in a folder. `payloads` has the bytes of each distinct payload once, compressed, under its SHA-256; lengths and
a second hash of all copies are compared while it is built, so two payloads under one digest stop the job. Payloads are compressed
before they are shuffled, and what is grouped and joined otherwise is digests. `headers` has a row per record: the
exact WARC and HTTP header bytes and the digest of its payload. A join of the two gives the original records back, byte for byte.
Revisit records carry no payload in WARC form; theirs comes from the record they refer to, by the same join.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_size, written

END = "\r\n"
_FACTS = "id long, url string, strong string, digest string, bytes long, second long"


def _digested(pages: DataFrame, pack: bool) -> DataFrame:
    """_FACTS of each row of pages(id, url, payload); with pack also the compressed payload, and less else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard

        packer = zstandard.ZstdCompressor(level=3)
        for b in (part for batch in batches for part in by_size(batch, 2)):
            bodies = [x.as_py() for x in b.column(2)]
            strong = pa.array([hashlib.sha256(x).hexdigest() for x in bodies], pa.string())
            if pack:
                yield pa.RecordBatch.from_arrays([b.column(0), strong, pa.array([packer.compress(x) for x in bodies], pa.binary())], names=["id", "strong", "packed"])
            else:
                digest = [base64.b32encode(hashlib.sha1(x).digest()).decode() for x in bodies]
                second = [xxhash.xxh64_intdigest(x) - (1 << 63) for x in bodies]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), strong, pa.array(digest, pa.string()), pa.array(map(len, bodies), pa.int64()), pa.array(second, pa.int64())], names=["id", "url", "strong", "digest", "bytes", "second"])

    return pages.mapInArrow(run, "id long, strong string, packed binary" if pack else _FACTS)


def _uuid(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws("\n", *parts).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line; none where the value is null. Control characters in values are percent-encoded, so a line stays a line."""
    clean = F.regexp_replace(F.regexp_replace(value.cast("string"), "\r", "%0D"), "\n", "%0A")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(END)), F.lit(""))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a record per row of pages: payload column as UTF-8 (binary as it is), null as empty.

    Of records with equal payloads of at least least_bytes, that with the largest id is the response and the others revisit it;
    smaller ones are all responses. Rows that repeat an id and its payload are copies of one record and have its type. A null id
    is smaller than any other. Payloads are taken whole, however long. An empty table makes an empty archive. Other columns are ignored.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    facts = _digested(rows, False)
    one = facts.groupBy("strong").agg(F.max(F.struct("id", "url")).alias("first"), F.min("bytes").alias("b0"), F.max("bytes").alias("b1"), F.min("second").alias("s0"), F.max("second").alias("s1"))
    clash = F.when((F.col("b0") != F.col("b1")) | (F.col("s0") != F.col("s1")), F.raise_error(F.lit("two payloads have one digest")).cast("string"))
    # Written, so that the records of a frequent digest join a plain table and Spark can split them.
    one = written(one.select("strong", F.col("first.id").alias("first_id"), F.col("first.url").alias("first_url"), clash.alias("clash")), "digests")

    packed = _digested(rows, True)
    stored = packed.join(one.select("strong", "first_id"), (packed["strong"] == one["strong"]) & packed["id"].eqNullSafe(one["first_id"]), "left_semi")
    stored.dropDuplicates(["strong", "id"]).select("strong", "packed").write.option("compression", "uncompressed").parquet(f"{path}/payloads")

    named = facts.join(one, "strong").where(F.col("clash").isNull())
    response = F.col("id").eqNullSafe(F.col("first_id")) | (F.col("bytes") < least_bytes)
    http = F.concat(F.lit("HTTP/1.1 200 OK" + END + "Content-Type: text/html; charset=utf-8" + END), _field("Content-Length", F.col("bytes")), F.lit(END))
    block = F.octet_length("http") + F.when(F.col("response"), F.col("bytes")).otherwise(F.lit(0))
    target = F.when(~F.col("response"), F.col("first_id"))
    warc = F.concat(
        F.lit("WARC/1.1" + END),
        _field("WARC-Type", F.when(F.col("response"), "response").otherwise("revisit")),
        _field("WARC-Record-ID", _uuid(F.coalesce(F.col("id").cast("string"), F.lit("-")), F.col("strong"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Page-ID", F.col("id")),
        _field("WARC-Profile", F.when(~F.col("response"), "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _field("WARC-Refers-To", F.when(~F.col("response"), _uuid(F.coalesce(F.col("first_id").cast("string"), F.lit("-")), F.col("strong")))),
        _field("WARC-Refers-To-Target-URI", F.when(~F.col("response"), F.col("first_url"))),
        _field("WARC-Refers-To-Page-ID", target),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.lit("Content-Type: application/http; msgtype=response" + END),
        _field("Content-Length", block),
        F.lit(END),
    )
    heads = named.withColumn("response", response).withColumn("http", http)
    heads.select("strong", F.concat(warc, F.col("http")).cast("binary").alias("header")).write.parquet(f"{path}/headers")


def _header(name: str) -> Column:
    """The value of a header line, empty too; null without the line."""
    header, line = F.col("header").cast("string"), rf"(?:^|\r\n){name}: ([^\r\n]*)\r\n"
    return F.when(header.rlike(line), F.regexp_extract(header, line, 1))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """A row per record, read from the stored bytes: page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri.

    Length and digest are taken from the stored payload, which must match the digest that it is stored under. Null ids and urls come back as null;
    repeated records come as often as they were written; an empty archive gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            facts = [(len(x), base64.b32encode(hashlib.sha1(x).digest()).decode()) for x in _unpacked(b.column(0), b.column(1))]  # one payload at a time
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([n for n, _ in facts], pa.int64()), pa.array([d for _, d in facts], pa.string())], names=["strong", "payload_bytes", "payload_digest"])

    held = spark.read.parquet(f"{path}/payloads").select("strong", "packed").mapInArrow(run, "strong string, payload_bytes long, payload_digest string")
    heads = spark.read.parquet(f"{path}/headers").select(
        "strong",
        _header("WARC-Page-ID").cast("long").alias("page_id"),
        _header("WARC-Type").alias("record_type"),
        _header("WARC-Refers-To-Page-ID").cast("long").alias("refers_to"),
        _header("WARC-Target-URI").alias("target_uri"),
    )
    return heads.join(held, "strong").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri")


def _unpacked(strong: pa.Array, packed: pa.Array) -> Iterator[bytes]:
    """The payloads of a batch, one after the other, each checked against its digest."""
    import zstandard

    opener = zstandard.ZstdDecompressor()
    for digest, x in zip(strong, packed):
        body = opener.decompress(x.as_py())
        if hashlib.sha256(body).hexdigest() != digest.as_py():
            raise ValueError("a stored payload does not match its digest")
        yield body


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload and record: the exact bytes of each WARC record, headers, block and closing blank lines. A revisit has its response's payload
    and an empty block; an empty archive gives no row."""
    heads = spark.read.parquet(f"{path}/headers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bodies, size, at = [], 0, 0
            for i, body in enumerate(_unpacked(b.column(1), b.column(2))):
                bodies.append(body)
                size += len(body)
                if size >= 8 << 20 or i + 1 == b.num_rows:
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(bodies)), pa.array(bodies, pa.binary())], names=["header", "payload"])
                    bodies, size, at = [], 0, i + 1

    packed = heads.join(spark.read.parquet(f"{path}/payloads"), "strong")
    whole = packed.select("header", "strong", "packed").mapInArrow(run, "header binary, payload binary")
    empty = F.lit("").cast("binary")
    block = F.when(_header("WARC-Type") == "response", F.col("payload")).otherwise(empty)
    return whole.select(_header("WARC-Page-ID").cast("long").alias("page_id"), "payload", F.concat("header", block, F.lit(END * 2).cast("binary")).alias("record"))


def export_warc(spark: SparkSession, path: str, out: str, rows_per_file: int = 10_000) -> None:
    """Plain gzipped WARC files of an archive: a record ends in two line ends, which Spark's text writer puts after each row."""
    rows = reconstruct(spark, path).select(F.expr("cast(substring(record, 1, octet_length(record) - 4) as string)").alias("value"))
    rows.write.option("lineSep", END * 2).option("compression", "gzip").option("maxRecordsPerFile", rows_per_file).text(out)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of gzipped WARC files, cut by Content-Length: path, offset, header (STRING), block (BINARY). A file is read in one task, and whole, as gzip has no
    places to begin at: export_warc keeps files small. An empty archive gives no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data, at = gzip.decompress(content.as_py()), 0
                while at < len(data):
                    end = data.index(b"\r\n\r\n", at) + 4
                    header = data[at:end].decode("utf-8", "replace")
                    size = next(int(x.split(":", 1)[1]) for x in header.split("\r\n") if x.lower().startswith("content-length:"))
                    yield pa.RecordBatch.from_pydict({"path": [name], "offset": pa.array([at], pa.int64()), "header": [header], "block": pa.array([data[end : end + size]], pa.binary())})
                    at = end + size + 4

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(run, "path string, offset long, header string, block binary")
