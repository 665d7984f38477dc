"""WARC archives from a chunked record table, and back.

A payload becomes rows (record, chunk number, bytes) of at most CHUNK bytes, cut by Spark where it is scanned; the writer
and the reader hold one chunk at a time and carry the record's SHA-1 from chunk to chunk. Equal payloads are stored once:
the record with the smallest page_id is a `response`, the others are `revisit` records without a payload.

Digests alone say which page is the first of its payload. Chunks meet these firsts by page_id and digest, so that a
payload which many pages share is no hot group, and no row that is dealt out holds more than a chunk.

Archives are gzip members, one a record, in the shared folder. A task writes under a temporary name and renames when the
archive is complete; only the manifest of finished tasks says which archives exist. What lost tasks left is deleted once
the manifest is written.

Defined cases: a null html is an empty payload; a null url leaves out the target URI; rows that repeat page_id and
payload are responses like the first; a null page_id is a record that comes after all others; no rows: no records. Columns
other than page_id, url and html are not looked at, whatever their names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop, materialize, scratch, small_batches, workspace

CHUNK = 1 << 18
#: Uncompressed bytes after which a task begins a new archive.
ROLL = 1 << 28
LEVEL = 1
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space for URLs of RFC 4122
_DATE = "2024-01-01T00:00:00Z"  # the tables hold no capture time


def _payload() -> dict[str, Column]:
    payload = F.coalesce("html", F.lit("")).cast("binary")
    return {"payload": payload, "n_bytes": F.octet_length(payload).cast("long"), "sha": F.sha1(payload)}


def record_rows(pages: DataFrame) -> DataFrame:
    """(page_id, url, n_bytes, sha, first_id) of each page; first_id is the smallest page_id with an equal payload."""
    rows = pages.select("page_id", "url", *(c.alias(n) for n, c in _payload().items() if n != "payload"))
    firsts = rows.groupBy("sha", "n_bytes").agg(F.min("page_id").alias("first_id"))
    return rows.join(firsts, ["sha", "n_bytes"]).select("page_id", "url", "n_bytes", "sha", "first_id")


def chunk_rows(pages: DataFrame, records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The chunked record table: (page_id, url, n_bytes, sha, first_id, chunk_no, chunks, data); a record's rows are adjacent.

    records: those of record_rows(). Revisits have one row without data, and so have empty payloads.
    """
    n = F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / chunk)).cast("int")
    cut = F.substring(F.col("payload"), F.col("chunk_no") * chunk + 1, F.lit(chunk))
    rows = pages.select("page_id", "url", F.monotonically_increasing_id().alias("row"), *(c.alias(n) for n, c in _payload().items()))
    rows = rows.withColumn("chunks", n).withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("page_id", "url", "n_bytes", "sha", "row", "chunk_no", "chunks", cut.alias("data"))
    stored = F.col("page_id").eqNullSafe(F.col("first_id"))
    firsts = records.where(stored).select("first_id", F.col("sha").alias("first_sha"), F.col("n_bytes").alias("first_bytes")).distinct()
    same = stored & (F.col("sha") == F.col("first_sha")) & (F.col("n_bytes") == F.col("first_bytes"))
    columns = ["page_id", "url", "n_bytes", "sha", "first_id", "chunk_no", "chunks", "data"]
    responses = rows.join(firsts, same).sortWithinPartitions("row", "chunk_no").select(*columns)
    revisits = records.where(~stored).withColumns({"chunk_no": F.lit(0), "chunks": F.lit(1), "data": F.lit(None).cast("binary")})
    return responses.unionByName(revisits.select(*columns))


def _id(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'page:{page}')}>"


def _head(row: dict) -> bytes:
    revisit = row["page_id"] != row["first_id"]
    digest = base64.b32encode(bytes.fromhex(row["sha"])).decode()
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _id(row["page_id"])), ("WARC-Date", _DATE)]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", row["url"].replace("\r", "%0D").replace("\n", "%0A")))
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-X-Payload-Length", row["n_bytes"])]
    if row["page_id"] is not None:
        fields.append(("WARC-X-Page-Id", row["page_id"]))
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _id(row["first_id"])), ("WARC-X-Refers-To-Page", row["first_id"])]
    fields += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", 0 if revisit else row["n_bytes"])]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


class _Archive:
    """One archive in the making: gzip members go to a temporary name, done() renames it."""

    def __init__(self, folder: str):
        self.fs, at = pafs.FileSystem.from_uri(folder)
        name = uuid.uuid4().hex
        self.path, self.temp = f"{at}/{name}.warc.gz", f"{at}/_{name}.tmp"
        self.uri = f"{folder}/{name}.warc.gz"
        self.fs.create_dir(at, recursive=True)
        self.out, self.bytes, self.records = self.fs.open_output_stream(self.temp, compression=None), 0, 0

    def begin(self, head: bytes) -> None:
        self.member, self.hash = gzip.GzipFile(fileobj=self.out, mode="wb", compresslevel=LEVEL, mtime=0), hashlib.sha1()
        self.member.write(head)

    def add(self, data: bytes) -> None:
        self.hash.update(data)
        self.member.write(data)
        self.bytes += len(data)

    def end(self) -> None:
        self.member.write(b"\r\n\r\n")
        self.member.close()
        self.records += 1

    def done(self) -> tuple[str, int, int]:
        self.out.close()
        self.fs.move(self.temp, self.path)
        return self.uri, self.records, self.bytes


def _only(spark: SparkSession, folder: str, manifest: DataFrame) -> None:
    """Deletes what the manifest does not name: archives of tasks that were lost or ran twice."""
    named = {r.path.rsplit("/", 1)[1] for r in manifest.select("path").toLocalIterator()}  # one for each ROLL bytes
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    files = fs.listStatusIterator(at) if fs.exists(at) else None
    while files and files.hasNext():
        file = files.next().getPath()
        if file.getName() not in named:
            fs.delete(file, False)


def write_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Writes the chunked record table to an own folder; returns the manifest (path, records, bytes), already written itself."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, made = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk_no"] == 0:
                    if archive and archive.bytes >= ROLL:
                        made.append(archive.done())
                        archive = None
                    archive = archive or _Archive(folder)
                    archive.begin(_head(row))
                if row["data"]:
                    archive.add(row["data"])
                if row["chunk_no"] + 1 == row["chunks"]:
                    if row["page_id"] == row["first_id"] and archive.hash.hexdigest() != row["sha"]:
                        raise ValueError(f"page {row['page_id']}: the chunks do not make up the payload")
                    archive.end()
        if archive:
            made.append(archive.done())
        yield pa.RecordBatch.from_pylist([dict(zip(("path", "records", "bytes"), m)) for m in made], pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    small_batches(chunks.sparkSession)
    manifest = materialize(chunks.mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")
    _only(chunks.sparkSession, folder, manifest)
    return manifest


def _records(stream: BinaryIO) -> Iterator[dict]:
    """Parses an archive, a chunk at a time: its header fields, and the length and digest of what the block held."""
    while (line := stream.readline()) != b"":
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            key, _, value = line.rstrip(b"\r\n").partition(b": ")
            fields[key.decode()] = value.decode()
        left, digest = int(fields["Content-Length"]), hashlib.sha1()
        got = left
        while left:
            data = stream.read(min(left, CHUNK))
            if not data:
                raise ValueError("the archive ends within a record")
            digest.update(data)
            left -= len(data)
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield fields | {"got": got, "digest": base64.b32encode(digest.digest()).decode()}


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, archive string"


def read_archives(manifest: DataFrame) -> DataFrame:
    """A row a record of the archives of a manifest; a response's length and digest are those of the bytes read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in READ.split(", ")]
        schema = pa.schema([(x.split()[0], pa.int64() if x.split()[1] == "long" else pa.string()) for x in READ.split(", ")])
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs, path = pafs.FileSystem.from_uri(uri)
                rows: list[tuple] = []
                with fs.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for f in _records(stream):
                        kind, stated = f["WARC-Type"], f["WARC-Payload-Digest"].removeprefix("sha1:")
                        length = int(f["WARC-X-Payload-Length"])
                        if kind == "response" and (f["digest"], f["got"]) != (stated, length):
                            raise ValueError(f"{uri}: record {f['WARC-Record-ID']} does not have its digest")
                        as_int = lambda k: int(f[k]) if k in f else None
                        rows.append((as_int("WARC-X-Page-Id"), length, stated, kind, as_int("WARC-X-Refers-To-Page"), f.get("WARC-Target-URI"), uri))
                        if len(rows) >= 1000:
                            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)
                            rows = []
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)

    # one archive is at most ROLL bytes and one record long, so dealing out archives deals out the work
    tasks = max(1, min(manifest.count(), 100_000))
    return manifest.select("path").repartition(tasks).mapInArrow(read, READ)


def round_trip(spark: SparkSession, pages: DataFrame, chunk: int = CHUNK, folder: str | None = None) -> DataFrame:
    """Writes all pages to archives and reads these back. Archives stay in `folder`; without one they go after the reading."""
    with workspace() as w:
        records = materialize(record_rows(pages), "warc-records")
        at = folder or scratch(spark, "warc")
        try:
            return w.result(read_archives(write_archives(chunk_rows(pages, records, chunk), at)), "warc-read")
        finally:
            if folder is None:
                drop(spark, at)


def oracle() -> str:
    """The records' fields in DuckDB's SQL; base32 from the hexadecimal digest, 5 bits a sign."""
    signs = [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((('0x' || substr(h, {1 + 10 * (i // 8)}, 10))::BIGINT >> {35 - 5 * (i % 8)}) & 31) AS BIGINT) + 1, 1)" for i in range(32)]
    return f"""
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h, payload_bytes) AS first_id FROM p)
SELECT page_id, payload_bytes, {" || ".join(signs)} AS payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM f
"""
