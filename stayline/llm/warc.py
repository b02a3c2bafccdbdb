"""WARC archives: a deterministic sharded writer, and a reader of what it committed.

Pages are cut into ranges of ``page_id`` by their exact ranks and sorted; each range is one
shard, written by one task as a series of files that roll at a compressed size. Rows of one
id, or without any, are ordered by a hash of their content, so a hot id has shards of its own. Every record is its own gzip
member without a time stamp; headers, ids and digests are made anew from the page, so the
same pages give the same bytes. A task writes under a temporary name and renames a finished
file, so a repeated attempt replaces a file by an equal one. A manifest, written by Spark
after all shards, names the files that count, with their sizes and hashes; the reader opens
those only.

Of records with equal payloads the one with the smallest page_id is the response, and the
others revisit it. A null payload is empty. A null page_id sorts first and is always a
response; rows that repeat a page_id and payload are all responses, or all revisits. Pages
without rows give a manifest without files. Columns besides ``page_id``, ``url`` and
``html`` are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stayline.operators.running import running_sums
from stayline.session import stage

SHARD_ROWS = 2048
MOST_SHARDS = 131_072  # their bounds are a constant of the plan; beyond it shards hold more rows each
ROLL_BYTES = 256 << 20
DATE = "2000-01-01T00:00:00Z"  # of the headers; a parameter, so that a rerun gives the same bytes
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format

MANIFEST = "shard int, roll int, file string, records bigint, bytes bigint, sha256 string, first_id bigint, last_id bigint"
RECORDS = (
    "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _position(page_id: Column, key: Column, url: Column) -> Column:
    """Place in the order of the shards: the id, then 40 bits of a hash. Null ids come before all others."""
    tie = F.when(page_id.isNull(), F.xxhash64(key, url)).otherwise(F.xxhash64(key)).bitwiseAND(F.lit(2**40 - 1))
    number = F.coalesce(page_id.cast("decimal(20,0)"), F.lit(str(-(2**63) - 1)).cast("decimal(20,0)"))
    return (number * F.lit(str(2**40)).cast("decimal(13,0)") + tie.cast("decimal(13,0)")).cast("decimal(36,0)")


def shard_bounds(positions: DataFrame, shard_rows: int = SHARD_ROWS) -> list[int]:
    """The first position ``at`` of every shard, ascending, from exact ranks of all positions.

    Rows of equal positions stay in one shard. At most ``MOST_SHARDS`` numbers reach the driver.
    """
    counted = running_sums(positions.groupBy("at").agg(F.count(F.lit(1)).alias("n")), "at", ["n"])
    total = positions.count()
    per_shard = max(shard_rows, -(-total // MOST_SHARDS))
    rank = F.floor((F.lit(total) - F.col("cum_n")) / per_shard)  # of the rows before this position
    return sorted(int(r.at) for r in counted.groupBy(rank.alias("shard")).agg(F.min("at").alias("at")).collect())


def shard_of(at: Column, bounds: list[int]) -> Column:
    """Number of the last bound that is not above ``at``, by binary search in a constant array."""
    firsts = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<decimal(36,0)>")
    steps = [1 << b for b in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda low, step: F.when(F.get(firsts, low + step) <= at, low + step).otherwise(low),
    )


def _uri(folder: str) -> str:
    """The name under which Arrow knows a folder of Hadoop's."""
    if folder.startswith("file:/") and not folder.startswith("file:///"):
        return "file:///" + folder[len("file:/") :].lstrip("/")
    scheme, mark, rest = folder.partition("://")
    return f"s3://{rest}" if mark and scheme in ("s3a", "s3n") else folder


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(_uri(folder))


def _clean(value: str) -> str:
    """A header value on one line."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id, url, payload: bytes, first, date: str) -> bytes:
    """One record; ``first`` is the page_id of the response it revisits, or None."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {date}", f"WARC-Target-URI: {_clean(url or f'urn:page:{page_id}')}", f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if first is not None:
        head += [f"WARC-Refers-To: {_record_id(first, digest)}", f"X-Refers-To-Page-ID: {first}", f"WARC-Profile: {REVISIT}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Roller:
    """Writes the members of one shard to files that roll by compressed size."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.fs, self.path = _open(folder)
        self.shard, self.most, self.roll, self.out, self.done = shard, roll_bytes, 0, None, []

    def write(self, page_id, member: bytes) -> None:
        if self.out is not None and self.size + len(member) > self.most:
            self.close()
        if self.out is None:
            self.name = f"shard-{self.shard:05d}-{self.roll:05d}.warc.gz"
            self.temporary = f"{self.path}/_temporary/{self.name}.{uuid.uuid4().hex}"
            self.fs.create_dir(f"{self.path}/_temporary", recursive=True)
            self.out, self.size, self.n, self.sha, self.first = self.fs.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256(), page_id
        self.out.write(member)
        self.size, self.n, self.last = self.size + len(member), self.n + 1, page_id
        self.sha.update(member)

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.fs.move(self.temporary, f"{self.path}/{self.name}")
        self.done.append((self.shard, self.roll, self.name, self.n, self.size, self.sha.hexdigest(), self.first, self.last))
        self.out, self.roll = None, self.roll + 1


def write_archives(
    pages: DataFrame, folder: str, shard_rows: int = SHARD_ROWS, roll_bytes: int = ROLL_BYTES, date: str = DATE
) -> DataFrame:
    """Write all pages below ``folder`` and return the committed manifest."""
    spark = pages.sparkSession
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("key", F.unhex(F.sha2("html", 256)))
    rows = rows.withColumn("at", _position(F.col("page_id"), F.col("key"), F.col("url")))

    # First page of each repeated payload, then a marker row for every page that revisits it.
    # Only ids and hashes are shuffled here; a hot payload's rows are split by the skew join.
    slim = stage(rows.select("page_id", "key", "at"), "warc-pages")
    firsts = slim.groupBy("key").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "first")
    markers = slim.join(firsts, "key").where("page_id > first").select(
        "page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "key", "at", "first"
    )
    # A marker sorts just before its page, so that payloads are shuffled once.
    bounds = shard_bounds(slim.select("at"), shard_rows)
    shards = max(len(bounds), 1)
    sorted_rows = (
        rows.withColumn("first", F.lit(None).cast("bigint")).unionByName(markers)
        .withColumn("shard", shard_of(F.col("at"), bounds) if bounds else F.lit(0))
        .repartitionById(shards, "shard")
        .sortWithinPartitions("shard", "at", "page_id", "key", F.col("first").desc_nulls_last(), "url")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, marked = None, (None, None, None)
        done = []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "key", "first", "url", "html", "shard")]
            for page_id, key, first, url, html, number in zip(*columns):
                if html is None:
                    marked = (page_id, key, first)
                    continue
                if roller is None or roller.shard != number:
                    if roller:
                        roller.close()
                        done += roller.done
                    roller = _Roller(folder, number, roll_bytes)
                to = marked[2] if page_id is not None and marked[:2] == (page_id, key) else None
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                roller.write(page_id, packer.compress(record(page_id, url, html.encode(), to, date)) + packer.flush())
        if roller:
            roller.close()
            done += roller.done
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        names = [c.split()[0] for c in MANIFEST.split(", ")]
        columns = list(zip(*done)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    sorted_rows.mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(f"{folder}/_manifest")
    _remove_temporary(spark, folder)
    return read_manifest(spark, folder)


def _remove_temporary(spark: SparkSession, folder: str) -> None:
    filesystem, path = _open(folder)
    if filesystem.get_file_info(f"{path}/_temporary").type == pafs.FileType.Directory:
        filesystem.delete_dir(f"{path}/_temporary")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def members(stream) -> Iterator[bytes]:
    """Decompressed gzip members of a stream, one at a time."""
    engine, parts, data = zlib.decompressobj(31), [], b""
    while data or (data := stream.read(1 << 16)):
        parts.append(engine.decompress(data))
        data = b""
        if engine.eof:
            data = engine.unused_data
            yield b"".join(parts)
            engine, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the archive ends within a record")


def _headers(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = block.partition(b"\r\n\r\n")
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:]), rest


def parse(member: bytes) -> tuple:
    """(page_id, url, type, payload size, payload digest, page revisited, payload or None); digests are checked."""
    warc, rest = _headers(member)
    block = rest[: int(warc["Content-Length"])]
    http, payload = _headers(block)
    if f"sha1:{base32_sha1(block)}" != warc["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {warc['WARC-Record-ID']} does not match")
    revisit = warc["WARC-Type"] == "revisit"
    digest = warc["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and base32_sha1(payload) != digest:
        raise ValueError(f"payload digest of {warc['WARC-Record-ID']} does not match")
    page, to = warc.get("X-Page-ID"), warc.get("X-Refers-To-Page-ID")
    return (
        None if page is None else int(page), warc["WARC-Target-URI"], warc["WARC-Type"], int(http["Content-Length"]), digest,
        None if to is None else int(to), None if revisit else payload,
    )


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Every record of the committed files. ``payloads=False`` leaves the payload column null."""
    manifest = read_manifest(spark, folder)
    shards = (manifest.agg(F.max("shard")).first()[0] or 0) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        names = [c.split()[0] for c in RECORDS.split(", ")]

        def packed(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for name in batch.column("file").to_pylist():
                filesystem, path = _open(folder)
                rows, held = [], 0
                with filesystem.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for member in members(stream):
                        row = parse(member)
                        rows.append(row if payloads else (*row[:-1], None))
                        held += len(row[-1] or b"") * payloads + 200
                        if held > 4 << 20:
                            yield packed(rows)
                            rows, held = [], 0
                if rows:
                    yield packed(rows)

    return manifest.select("shard", "file").repartitionById(shards, "shard").mapInArrow(run, RECORDS)


def digest(records: DataFrame) -> DataFrame:
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
