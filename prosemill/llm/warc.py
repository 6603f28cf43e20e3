"""WARC archives: monolithic gzip files normalised to one gzip member per record, with an index.

`write_monolithic` writes pages as WARC/1.1 records; every part file is a single gzip stream, as
whole-file compression leaves it, and bounded in records and in bytes.  `normalise` inflates each such stream once, record by record, and
rewrites every record as a gzip member of its own; a sidecar index gives archive, offset and length
of each member.  `read_all` reads whole archives back; `read_indexed` reads chosen records at their
places in the index.

Writing goes through Spark's text writer, whose rows are the raw bytes: the record end supplies the
line end of a monolithic file, and in a normalised file an empty gzip member ends each row, which
readers skip.  So files are committed as any Spark output is, on any file system, and a task that
runs again leaves nothing behind.

Of pages with equal payloads of at least `least` bytes the one with the smallest id is a response
record, the others are revisits, whose records have the digest and length but no block.  Digests are
grouped with map-side counts and only repeated digests are joined back, so a payload that a third of
all pages share is no hot group.

Defined results: null html is an empty payload.  A null id counts as larger than any; rows with
equal id and payload are alike (all response, or all revisit).  Line ends in a URL are written
percent-encoded.  Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill.session import scratch_path

LEAST = 100  # payload bytes from which equal payloads are revisits
RECORDS_PER_FILE = 2000
FILE_BYTES = 256 << 20  # of the records of a raw file, before compression
BLOCK = 1 << 20
EMPTY_MEMBER = zlib.compressobj(9, zlib.DEFLATED, 31).flush()
END = b"\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def payloads(pages: DataFrame, least: int = LEAST, id_col: str = "page_id", url_col: str = "url",
             html_col: str = "html") -> DataFrame:
    """(page_id, url, html, payload_bytes, payload_digest, record_type, refers_to)."""
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    rows = rows.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn(
        "payload_digest", F.sha2(F.col("html"), 256)
    )
    first = (
        rows.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (
        rows.join(first, "payload_digest", "left")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisit, F.col("first")))
        .drop("first")
    )


def _record(r: str = "") -> Column:
    """A record without its last byte, which the writer's line end supplies."""
    is_response = F.col("record_type") == "response"
    uri = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    size = F.octet_length(F.lit(HTTP)) + F.when(is_response, F.col("payload_bytes")).otherwise(0)

    def header(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))).otherwise("")

    return F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
        header("WARC-Target-URI", uri),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        header("X-Payload-Length", F.col("payload_bytes")),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", size),
        F.lit("\r\n" + HTTP),
        F.when(is_response, F.col("html")).otherwise(""),
        F.lit("\r\n\r"),
    )


def write_monolithic(
    records: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE, file_bytes: int = FILE_BYTES
) -> None:
    """WARC files of at most `records_per_file` records and `file_bytes` bytes, each one gzip stream.

    Bytes are counted before compression; a longer record is a file of its own.  Records go into a folder
    by how many of their size, rounded up to a power of two, fit into a file (`room`).  Where that is
    fewer than `records_per_file`, a task's rows are cut by their place into runs of that many (`run`).
    """
    row = records.select(_record().alias("value"))
    longest = F.pow(F.lit(2.0), F.ceil(F.log2(F.octet_length("value") + 1)))
    room = F.greatest(F.lit(1), F.least(F.lit(records_per_file), F.floor(F.lit(file_bytes) / longest))).cast("int")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # within the task
    run = F.when(F.col("room") < records_per_file, F.floor(F.col("place") / F.col("room"))).otherwise(0)
    (
        row.withColumn("place", place)
        .withColumn("room", room)
        .select("value", "room", run.cast("long").alias("run"))
        .write.partitionBy("room", "run")
        .option("compression", "gzip")
        .option("lineSep", "\n")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def _head_end(data: bytearray) -> int:
    return data.find(b"\r\n\r\n")


def inflate_records(packed: memoryview) -> Iterator[bytes]:
    """The records of a gzip stream (or members), inflated once, a block at a time."""
    inflater, held, need, at = zlib.decompressobj(31), bytearray(), -1, 0
    while True:
        while True:
            if need < 0:
                end = _head_end(held)
                if end < 0:
                    break
                length = 0
                for line in bytes(held[:end]).split(b"\r\n")[1:]:
                    name, _, value = line.partition(b":")
                    if name.lower() == b"content-length":
                        length = int(value)
                need = end + 4 + length + len(END)
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = -1
        if at >= len(packed) and not inflater.unconsumed_tail:
            break
        if inflater.eof:  # a further member
            rest = inflater.unused_data
            at -= len(rest)
            inflater = zlib.decompressobj(31)
        block = inflater.unconsumed_tail
        if not block:
            block = packed[at : at + BLOCK]
            at += len(block)
        held += inflater.decompress(block, 4 * BLOCK)
    if held:
        raise ValueError(f"{len(held)} bytes after the last whole record")


def _rows(batches: Iterator[tuple], schema: pa.Schema, width) -> Iterator[pa.RecordBatch]:
    """Arrow batches of bounded bytes from tuples; `width` tells a tuple's bytes."""
    rows, size = [], 0
    for row in batches:
        rows.append(row)
        size += width(row)
        if size > 4 * BLOCK or len(rows) >= 10_000:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema
            )
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema
        )


_MEMBERS = pa.schema([("archive", pa.string()), ("record", pa.int64()), ("member", pa.binary())])


def _archive_name(path: str, root: str) -> str:
    """A file's path below `root` as a folder name; other paths give other names."""
    return re.sub(r"[^A-Za-z0-9-]", lambda m: f"_{ord(m[0]):x}_", path.removeprefix(root + "/").removesuffix(".gz"))


def _members(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    def each():
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                archive = _archive_name(path, root)
                for k, record in enumerate(inflate_records(memoryview(content.as_buffer()))):
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    yield archive, k, packer.compress(record) + packer.flush()

    return _rows(each(), _MEMBERS, lambda r: len(r[2]))


def walk_members(packed: memoryview) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each gzip member that has content."""
    at = 0
    while at < len(packed):
        inflater, parts, end = zlib.decompressobj(31), [], at
        while not inflater.eof:
            block = packed[end : end + BLOCK]
            if not block:
                raise ValueError("the archive ends inside a member")
            parts.append(inflater.decompress(block))
            end += len(block) - len(inflater.unused_data)
        content = b"".join(parts)
        if content:
            yield at, end - at, content
        at = end


def _files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true").load(path)
    )


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Rewrites the archives under `source` to `target`/archives, with `target`/index beside them.

    index: archive, record, offset, length of every record, as the written files have them.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(source)
    root = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    members = _files(spark, source, "*.gz").select("path", "content").mapInArrow(
        lambda batches: _members(batches, root), "archive string, record long, member binary"
    )
    (
        members.sortWithinPartitions("archive", "record")
        .select("archive", F.col("member").cast("string").alias("value"))
        .write.partitionBy("archive")
        .option("encoding", "ISO-8859-1")
        .option("lineSep", EMPTY_MEMBER.decode("latin-1"))
        .text(f"{target}/archives")
    )
    archives(spark, target).mapInArrow(
        _placer, "archive string, record long, offset long, length long"
    ).write.parquet(f"{target}/index")


def archives(spark: SparkSession, target: str) -> DataFrame:
    """(archive, content): the normalised files."""
    return _files(spark, f"{target}/archives", "*.txt").select(
        F.regexp_extract("path", r"archive=([^/]*)/", 1).alias("archive"), "content"
    )


_PLACES = pa.schema(
    [("archive", pa.string()), ("record", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())]
)


def _placer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def each():
        for batch in batches:
            for archive, content in zip(batch.column("archive").to_pylist(), batch.column("content")):
                for k, (at, length, _) in enumerate(walk_members(memoryview(content.as_buffer()))):
                    yield archive, k, at, length

    return _rows(each(), _PLACES, lambda r: 0)


_READ = (
    "page_id long, url string, record_type string, refers_to long, header_digest string, "
    "header_bytes long, payload binary"
)


def _urn(value: bytes | None) -> int | None:
    return None if value is None else int(value.removeprefix(b"<urn:page:").removesuffix(b">"))


def parse_record(record: bytes) -> tuple:
    """(page_id, url, record_type, refers_to, header_digest, header_bytes, payload)."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b": ")
        fields[name] = value
    block = block[: int(fields[b"Content-Length"])]
    return (
        _urn(fields.get(b"WARC-Record-ID")),
        fields[b"WARC-Target-URI"].decode("utf-8", "replace"),
        fields[b"WARC-Type"].decode(),
        _urn(fields.get(b"WARC-Refers-To")),
        fields[b"WARC-Payload-Digest"].decode().removeprefix("sha256:"),
        int(fields[b"X-Payload-Length"]),
        block.partition(b"\r\n\r\n")[2],
    )


_FIELDS = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
     ("refers_to", pa.int64()), ("header_digest", pa.string()), ("header_bytes", pa.int64()),
     ("payload", pa.binary())]
)


def _read_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def each():
        for batch in batches:
            for content in batch.column("content"):
                for _, _, record in walk_members(memoryview(content.as_buffer())):
                    yield parse_record(record)

    return _rows(each(), _FIELDS, lambda r: len(r[-1]))


def _read_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def each():
        for batch in batches:
            for content, places in zip(batch.column("content"), batch.column("places").to_pylist()):
                packed = memoryview(content.as_buffer())
                for place in places:
                    at = place["offset"]
                    yield parse_record(zlib.decompress(packed[at : at + place["length"]], 31))

    return _rows(each(), _FIELDS, lambda r: len(r[-1]))


def read_all(spark: SparkSession, target: str) -> DataFrame:
    """All records of the normalised archives, each archive read from its start to its end."""
    return archives(spark, target).select("content").mapInArrow(_read_all, _READ)


def read_indexed(spark: SparkSession, target: str, wanted: DataFrame) -> DataFrame:
    """The records at the given rows of the index, each inflated alone at its place."""
    places = wanted.groupBy("archive").agg(
        F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("places")  # of one file at most
    )
    return (
        archives(spark, target).join(places, "archive").select("content", "places")
        .mapInArrow(_read_places, _READ)
    )


def round_trip(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Pages written, normalised and read back: what `read_all` gives."""
    spark = pages.sparkSession
    at = scratch_path(spark, "warc")
    place = spark._jvm.org.apache.hadoop.fs.Path(at)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    write_monolithic(payloads(pages, least), f"{at}/raw")
    normalise(spark, f"{at}/raw", f"{at}/packed")
    return read_all(spark, f"{at}/packed")
