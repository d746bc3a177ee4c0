"""A deterministic sharded WARC writer, and its reader.

Records are sorted by range of (page_id, payload digest), so each task writes one stretch of the order. The ranges are quantiles of a
sample that a hash of the key chooses, so they follow from the rows alone: files and digests are the same in every run. A task streams its
records into gzip members, one per record, rolls to a new file when the compressed size passes a bound, and makes headers
and digests anew from the payload. A file is written under a temporary name and renamed when complete; a retried or
speculative task makes the same bytes under the same name, so the rename may happen twice. The list of files (with sizes,
digests and record counts) is the manifest, itself a table that Spark commits; readers open only files it lists, so files
of a failed job are never read.

Equal payloads: of those of at least `revisit_bytes` bytes the one with the smallest page_id is the response, the others are
revisit records that name it. Which pages are revisits is found from digests alone; the payload is shuffled once.

Defined edge cases: a null html is an empty payload; a null url is an empty one, and control characters and blanks in a url
are percent-encoded; among repeated rows of the smallest page_id one is the response, and the others revisit it; a null
page_id is below all others; rows that share page_id and payload lie in one shard, and a record is held whole, one at a
time, however long; temporary files of failed attempts stay until the folder goes; an empty table gives an empty manifest and no records; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathomline.llm.files import open_folder
from fathomline.session import Stages, remove_path, scratch_path

REVISIT_BYTES = 100
SAMPLE = 256  # keys per shard, about, from which shard bounds are taken
RECORD_BYTES = 512  # of a record beside its payload, about: the weight of a page is its payload and this
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

MANIFEST = "file string, bytes long, sha256 string, records long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record_id(page: object, digest: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{digest}/{kind}')}>"


def safe_url(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)


def record(page: int | None, url: str, payload: bytes, digest: str, first: int | None, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record. Page ids travel in extension fields; the lengths and digests are those of the full payload."""
    kind = "revisit" if revisit else "response"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page, digest, kind)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {safe_url(url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        f"X-Page-Id: {'' if page is None else page}",
        "Content-Type: application/http;msgtype=response",
    ]
    block = HTTP % len(payload)
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(first, digest, 'response')}"]
        head += [f"X-Refers-To-Page-Id: {'' if first is None else first}"]
    else:
        block += payload
    head += [f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without time or name, so that equal data make equal bytes."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Roller:
    """Writes records to files of one task; holds one record at a time."""

    def __init__(self, folder: str, part: int, roll_bytes: int):
        (self.fs, self.folder), self.part, self.roll = open_folder(folder), part, roll_bytes
        self.out, self.n, self.done = None, 0, []

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.name = f"part-{self.part:06d}-{self.n:05d}.warc.gz"
            self.temporary = f"{self.folder}/_temporary-{self.name}-{uuid.uuid4().hex}"
            self.out, self.size, self.count, self.sha = self.fs.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256()
        packed = member(data)
        self.out.write(packed)
        self.sha.update(packed)
        self.size, self.count = self.size + len(packed), self.count + 1
        if self.size >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.temporary, f"{self.folder}/{self.name}")
            self.done.append((self.name, self.size, self.sha.hexdigest(), self.count))
            self.out, self.n = None, self.n + 1


def _writer(folder: str, roll_bytes: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        roller = _Roller(folder, TaskContext.get().partitionId(), roll_bytes)
        # a plan row (kind 0) comes before the pages (kind 1) of its key and says how many of them revisit what
        key, first, responses = None, None, 0
        for batch in batches:
            columns = [batch.column(n) for n in ("page_id", "digest", "kind", "first", "url", "html")]
            for i in range(batch.num_rows):
                page, digest, kind, at, url, html = (c[i].as_py() for c in columns)
                if kind == 0:
                    key, first, responses = (page, digest), at, int(page == at)
                    continue
                payload = html or b""
                revisit = (page, digest) == key and responses <= 0
                if (page, digest) == key:
                    responses -= 1
                roller.add(record(page, url or "", payload, digest, first, revisit, date))
        roller.close()
        if roller.done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*roller.done), (pa.string(), pa.int64(), pa.string(), pa.int64()))],
                names=["file", "bytes", "sha256", "records"],
            )

    return write


def shard_bounds(seen: DataFrame, shards: int) -> Column:
    """Where each shard but the first begins, as a sorted array of runs of sorted keys (two steps find a key's shard). One key per
    shard passes through the driver and becomes a constant of the plan.

    seen: page_id, digest, n, length, one row per key. The bounds are quantiles of bytes over the keys that a hash of their own
    chooses, SAMPLE per shard or so, or over all where there are fewer. They depend on the rows alone: not on how the input is
    split, on a seed or on the session, so reruns and retries deal the same rows to the same shard."""
    keys = seen.count()
    share = min(1.0, SAMPLE * shards / max(keys, 1))
    drawn = F.shiftrightunsigned(F.xxhash64("page_id", "digest"), 11).cast("double") / float(1 << 53)
    weight = F.col("n") * (F.col("length") + RECORD_BYTES)
    sample = seen.filter(drawn < share).select(F.struct("page_id", "digest").alias("key"), weight.cast("decimal(38,0)").alias("weight"))
    order = Window.orderBy("key")  # over the sample
    placed = sample.withColumn("before", F.sum("weight").over(order) - F.col("weight")).withColumn("total", F.sum("weight").over(Window.partitionBy()))
    shard = F.floor(F.col("before") * shards / F.col("total")).cast("int")
    begins = placed.groupBy(shard.alias("shard")).agg(F.min("key").alias("key")).filter("shard > 0").select("key")
    runs = begins.withColumn("run", F.floor((F.row_number().over(order) - 1) / max(1, math.isqrt(shards))).cast("int"))
    runs = runs.groupBy("run").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    text = runs.agg(F.to_json(F.sort_array(F.collect_list("keys")))).first()[0]
    return F.from_json(F.lit(text), "array<array<struct<page_id:bigint,digest:string>>>")


def shard_of(key: Column, runs: Column) -> Column:
    """The number of shard beginnings at or below a key."""
    run = F.size(F.filter(runs, lambda keys: F.get(keys, F.lit(0)) <= key))  # 1-based; 0 before all
    within = F.size(F.filter(F.get(runs, run - 1), lambda k: k <= key))
    length = F.size(F.get(runs, F.lit(0)))  # all runs but the last have the length of the first
    return F.when(run > 0, (run - 1) * length + within).otherwise(0).cast("int")


def write_archives(
    pages: DataFrame, folder: str, shards: int, roll_bytes: int = 64 << 20, date: str = "1970-01-01T00:00:00Z", stages: Stages | None = None
) -> DataFrame:
    """Write one record per row of pages (page_id, url, html) to files under `folder`; returns the manifest, which is
    committed as a table in `folder`/_manifest. Reruns over the same files make the same archives."""
    spark = pages.sparkSession
    stages = stages or Stages(spark)
    place, path = open_folder(folder)
    place.create_dir(path)
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest")
    )
    # digests alone: the smallest page of each repeated payload, and from it one plan row per page that shares it
    length = F.octet_length("html").cast("long")
    seen = rows.groupBy("page_id", "digest").agg(F.count(F.lit(1)).alias("n"), F.max(length).alias("length"))
    seen = stages.write(seen, "warc-keys")
    bounds = shard_bounds(seen, shards)
    seen = seen.filter(F.col("length") >= REVISIT_BYTES)
    shared = seen.groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNotNull(), "page_id"))["page_id"].alias("first"), F.sum("n").alias("n"))
    shared = stages.write(shared.filter("n > 1").drop("n"), "warc-shared")
    plan = seen.join(shared, "digest").select(
        "page_id", "digest", F.lit(0).alias("kind"), "first", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("html")
    )
    every = rows.select("page_id", "digest", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("first"), "url", "html")
    numbered = plan.unionByName(every).withColumn("shard", shard_of(F.struct("page_id", "digest"), bounds))
    dealt = numbered.repartitionById(shards, "shard").drop("shard").sortWithinPartitions("page_id", "digest", "kind", "url")
    manifest = dealt.mapInArrow(_writer(folder, roll_bytes, date), MANIFEST)
    target = folder.rstrip("/") + "/_manifest"
    manifest.write.mode("errorifexists").json(target)
    return spark.read.schema(MANIFEST).json(target)


def records(data: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record in a stream of uncompressed bytes; holds one record at a time."""
    kept = b""
    for chunk in data:
        kept += chunk
        while (end := kept.find(b"\r\n\r\n")) >= 0:
            lines = kept[:end].decode().split("\r\n")
            fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
            size = int(fields["Content-Length"])
            if len(kept) < end + 8 + size:
                break
            if kept[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
                raise ValueError("a record does not end where its length says")
            yield fields, kept[end + 4 : end + 4 + size]
            kept = kept[end + 8 + size :]
    if kept:
        raise ValueError("an archive ends within a record")


def unpacked(source: pa.NativeFile, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The data of consecutive gzip members, one member at a time."""
    unpack, out, rest = zlib.decompressobj(31), [], b""
    while data := rest or source.read(chunk):
        out.append(unpack.decompress(data))
        rest = unpack.unused_data
        if unpack.eof:
            yield b"".join(out)
            unpack, out = zlib.decompressobj(31), []


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, path = open_folder(folder)
        number = lambda s: int(s) if s else None
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                with place.open_input_stream(f"{path}/{name}", compression=None) as source:
                    for fields, block in records(unpacked(source)):
                        digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
                        size = int(fields["X-Payload-Length"])
                        if kind == "response":
                            payload = block[block.index(b"\r\n\r\n") + 4 :]
                            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                        rows.append((number(fields["X-Page-Id"]), size, digest, kind, number(fields.get("X-Refers-To-Page-Id", ""))))
                        if len(rows) >= 10_000:
                            yield _rows(rows)
                            rows = []
                if rows:
                    yield _rows(rows)

    return read


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    names = [c.split()[0] for c in RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def read_archives(manifest: DataFrame, folder: str, tasks: int) -> DataFrame:
    """The records of all files in the manifest: ids, sizes, digests (of responses: taken from the payload read), types."""
    files = manifest.select("file").repartition(tasks, "file")
    return files.mapInArrow(_reader(folder), RECORD)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back; one row per page."""
    stages = Stages(spark)
    folder = scratch_path(spark, "warc")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    manifest = write_archives(pages, folder, tasks, stages=stages)
    out = stages.write(read_archives(manifest, folder, tasks), "warc-read")
    remove_path(spark, folder)
    return out


#: The same result in DuckDB.
SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first < page_id THEN first END AS refers_to FROM f
"""
