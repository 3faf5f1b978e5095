"""Deterministic sharded WARC archives: write pages, read records back."""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findlark.config import fresh_path
from findlark.llm.common import running_sums, ship, unpack_bytes

ship(__name__)

SHARD_BYTES = 32 << 20
FILE_BYTES = 16 << 20
MIN_REVISIT = 100
# weight of a record's headers, so that records without payload are dealt over shards too
HEADER_BYTES = 500
DATE = "1970-01-01T00:00:00Z"
SPACE = uuid.UUID("5ee2fd1c-7b9e-4bd0-9b50-9d7ad2f0c011")

RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
PACKED = "shard long, page_id long, member binary"
MANIFEST = "shard long, file string, records long, bytes long, sha256 string"


def described(pages: DataFrame, min_revisit: int, shard_bytes: int) -> DataFrame:
    """Narrow rows, one per page id and digest: kind of record, page it repeats, shard.

    Payloads are compared by SHA-256. Counts are combined before they are shuffled and only
    digests that occur twice are joined, so one payload on a third of all pages is one row there.
    """
    rows = pages.groupBy("page_id", "payload_digest").agg(
        F.max("payload_bytes").alias("payload_bytes"), F.count("*").alias("n")
    )
    repeated = (
        rows.where(F.col("payload_bytes") >= min_revisit)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_page"), F.count("*").alias("ids"))
        .where("ids > 1")
        .select(F.col("payload_digest").alias("_digest"), "first_page")
    )
    rows = rows.join(repeated, F.col("payload_digest") == F.col("_digest"), "left")
    later = F.col("first_page").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    rows = rows.select(
        "page_id", "payload_digest",
        F.when(later, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(later, F.col("first_page")).alias("refers_to"),
        (F.when(later, F.lit(0)).otherwise(F.col("payload_bytes")) + HEADER_BYTES).alias("each"), "n",
    )
    rows = rows.select(
        "page_id", "payload_digest", "record_type", "refers_to", (F.col("each") * F.col("n")).cast("long").alias("stored")
    )
    placed = running_sums(rows, [F.col("page_id"), F.col("payload_digest")], ["stored"], "warc-rows")
    shard = F.floor(F.col("before_stored") / F.lit(shard_bytes)).cast("long")
    return placed.select(
        F.col("page_id").alias("_page_id"), F.col("payload_digest").alias("_digest"), "record_type", "refers_to",
        shard.alias("shard"),
    )


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{page_id}:{digest}')}>"


def record(row: dict, date: str) -> bytes:
    """One record: headers made anew from the row, then the payload of a response."""
    body = row["payload"] if row["record_type"] == "response" else b""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {record_id(row['page_id'], row['payload_digest'])}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        f"X-Payload-Length: {row['payload_bytes']}",
    ]
    if row["page_id"] is not None:
        lines.append(f"X-Page-Id: {row['page_id']}")
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + json.dumps(row["url"])[1:-1])
    if row["record_type"] == "revisit":
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(row['refers_to'], row['payload_digest'])}",
            f"X-Refers-To-Page: {row['refers_to']}",
        ]
    else:
        lines += [f"WARC-Block-Digest: sha256:{row['payload_digest']}", "Content-Type: text/html"]
    lines.append(f"Content-Length: {len(body)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member with neither time nor name, so equal input gives equal bytes."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Roll:
    """The files of one shard: written under temporary names, renamed when complete."""

    def __init__(self, folder: str, shard: int, limit: int):
        from pyarrow import fs

        self.files, self.root = fs.FileSystem.from_uri(folder)
        self.shard, self.limit, self.number, self.out = shard, limit, 0, None

    def add(self, data: bytes) -> Iterator[tuple]:
        if self.out is not None and self.size + len(data) > self.limit:
            yield self.close()
        if self.out is None:
            self.name = f"shard-{self.shard:08d}-{self.number:05d}.warc.gz"
            # unique to this attempt: a second attempt of the task never meets it
            self.temporary = f"{self.root}/_temporary-{uuid.uuid4().hex}-{self.name}"
            self.out = self.files.open_output_stream(self.temporary, compression=None)
            self.size, self.count, self.digest = 0, 0, hashlib.sha256()
            self.number += 1
        self.out.write(data)
        self.digest.update(data)
        self.size, self.count = self.size + len(data), self.count + 1

    def close(self) -> tuple:
        self.out.close()
        self.out = None
        # every attempt writes the same bytes, so replacing a file of the same name is harmless
        self.files.move(self.temporary, f"{self.root}/{self.name}")
        return self.shard, self.name, self.count, self.size, self.digest.hexdigest()


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
    min_revisit: int = MIN_REVISIT,
    level: int = 6,
    date: str = DATE,
) -> tuple[str, DataFrame]:
    """Write ``pages`` (page_id, url, html) as archives; returns the folder and the manifest.

    Records are sorted by page id. A shard holds the records that begin in the same multiple of
    ``shard_bytes`` of all bytes written before them (payloads, and a fixed size for headers), so which record is in which shard
    and file depends on the data alone, not on partitions. Shards are found on narrow rows. Inside a shard a file is
    closed before its compressed size exceeds ``file_bytes``. Files appear by a rename when they
    are complete; the manifest (one row per file with counts and digest) is written last, and
    readers only open files it names.

    Null html is an empty payload, null ids sort first and carry no id header. Of records with
    equal payloads of ``min_revisit`` bytes or more, the one with the smallest page id is the
    response; rows repeated with that same id are responses too. Without rows the manifest is
    empty. Other columns are not written.
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"

    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.select(
        "page_id", "url", "payload", F.length("payload").cast("long").alias("payload_bytes"),
        F.unhex(F.sha2("payload", 256)).alias("payload_digest"),
    )
    narrow = described(rows.drop("payload", "url"), min_revisit, shard_bytes)

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 3)
        for batch in batches:
            at = batch.schema.get_field_index("payload")
            small = pa.array([codec.compress(p.as_buffer(), asbytes=True) for p in batch.column(at)], pa.binary())
            yield batch.set_column(at, "payload", small)

    # payloads travel compressed
    rows = rows.mapInArrow(squeeze, rows.schema)
    same = F.col("page_id").eqNullSafe(F.col("_page_id")) & (F.col("payload_digest") == F.col("_digest"))
    rows = rows.join(narrow, same).drop("_page_id", "_digest")
    # what a revisit repeats is not written again, so it need not travel either
    rows = rows.withColumn("payload", F.when(F.col("record_type") == "response", F.col("payload")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = batch.to_pylist()
            for row in made:
                row["payload_digest"] = row["payload_digest"].hex()
                row["payload"] = unpack_bytes(row["payload"], row["payload_bytes"])
            kept = batch.select(["shard", "page_id"])
            members = pa.array([member(record(row, date), level) for row in made], pa.binary())
            yield pa.RecordBatch.from_arrays([*kept.columns, members], [*kept.schema.names, "member"])

    # records are compressed before they are sorted into shards
    packed = rows.mapInArrow(pack, PACKED)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = packed.repartition(tasks, "shard").sortWithinPartitions("shard", "page_id", "member")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, done = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if roll is None or roll.shard != row["shard"]:
                    if roll is not None:
                        done.append(roll.close())
                    roll = Roll(uri, row["shard"], file_bytes)
                done += roll.add(row["member"])
        if roll is not None:
            done.append(roll.close())
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*done)], ["shard", "file", "records", "bytes", "sha256"]
            )

    make_folder(spark, folder)
    manifest = f"{folder}/_manifest"
    placed.mapInArrow(write, MANIFEST).write.parquet(manifest)
    return uri, spark.read.schema(MANIFEST).parquet(manifest)


def make_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def parse(stream, block: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file of gzip members, one member in memory."""
    left, ended = b"", False
    while True:
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if not left:
                left = stream.read(block)
                ended = not left
                if ended:
                    break
            parts.append(inflate.decompress(left))
            left = inflate.unused_data if inflate.eof else b""
        if ended:
            if parts:
                raise ValueError("an archive ends inside a record")
            return
        head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        yield headers, rest[: int(headers["Content-Length"])]


def read_archives(spark: SparkSession, uri: str, manifest: DataFrame) -> DataFrame:
    """Records of all files the manifest names; a digest that differs from its header is an error."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(uri)
        schema = pa.schema([
            ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
        ])
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for headers, body in parse(stream):
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                        kind, page = headers["WARC-Type"], headers.get("X-Page-Id")
                        if kind == "response" and hashlib.sha256(body).hexdigest() != digest:
                            raise ValueError(f"{name}: payload of page {page} does not match its digest")
                        refers = headers.get("X-Refers-To-Page")
                        url = headers.get("WARC-Target-URI")
                        rows.append((
                            None if page is None else int(page), int(headers["X-Payload-Length"]), digest, kind,
                            None if refers is None else int(refers), None if url is None else json.loads(f'"{url}"'),
                        ))
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    # manifests are small, files are not: deal the names out evenly
    spread = manifest.select("file").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spread.mapInArrow(read, RECORDS)


SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (
  SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM f
"""
