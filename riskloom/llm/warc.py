"""WARC archives: a deterministic sharded writer and a reader.

Pages are cut into ranges of page_id (shards), sorted inside each and written as gzip members, one
per record; a file is closed when its compressed size reaches a limit. The shards' bounds come from
page ids picked by their hash, so the same pages give the same files byte for byte, whatever tasks
write them. A task writes under a temporary name and renames when the file is complete; a repeated
task writes the same bytes to the same name. The manifest is renamed into place last, and readers
only open files that it lists.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm.common import stored, table, text_of
from riskloom.session import shared_dir

#: Payloads from this size on are stored once; raw bytes that a shard aims at; shards at most (larger
#: archives get larger shards); page ids picked per shard to find the bounds; file size.
DEDUP_BYTES, SHARD_BYTES, MAX_SHARDS, PICKED, FILE_BYTES = 100, 4 << 20, 20_000, 32, 64 << 20
DATE = "2020-01-01T00:00:00Z"
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CHUNK = 1 << 20


def _uri(spark: SparkSession, path: str) -> str:
    """The path with the scheme that all executors resolve alike."""
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    full = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    return re.sub(r"^file:/+", "file:///", full)


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def record_id(page: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{digest}')}>"


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    fields = [*fields, ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page, url, html: str | None, size: int, digest: str, first) -> bytes:
    """Record of one page: a response with its payload, or a revisit that names the first page."""
    name = "" if page is None else str(page)
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{name}"
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", record_id(name, digest)), ("WARC-Date", DATE),
        ("WARC-Target-URI", target), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Page-ID", name),
    ]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if first is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(str(first), digest)), ("X-Refers-To-Page-ID", str(first))]
        return _record(fields, block)
    return _record(fields, block + html.encode("utf-8"))


class _File:
    """One archive file under its temporary name."""

    def __init__(self, uri: str, name: str, attempt: str):
        self.fs, self.folder = _open(uri)
        self.name, self.part = name, f"{self.folder}/.{name}.{attempt}"
        self.out, self.sum, self.size, self.records = self.fs.open_output_stream(self.part, compression=None), hashlib.sha256(), 0, 0
        self.add(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name, "info")), ("WARC-Date", DATE), ("WARC-Filename", name),
                          ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))

    def add(self, record: bytes) -> None:
        self.out.write(record)
        self.sum.update(record)
        self.size += len(record)
        self.records += 1

    def close(self) -> tuple:
        self.out.close()
        self.fs.move(self.part, f"{self.folder}/{self.name}")
        return self.name, self.records, self.size, self.sum.hexdigest()


def shard_of(pages: DataFrame, facts: DataFrame, shard_bytes: int):
    """Number of shards, and the column that gives each page's. `facts`: page_id, size."""
    total = facts.agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).first()
    shards = max(1, min(MAX_SHARDS, math.ceil((total["size"] or 0) / shard_bytes)))
    every = max(1, total["n"] // (PICKED * shards))
    picked = facts.where(F.col("page_id").isNotNull() & (F.pmod(F.xxhash64("page_id"), F.lit(every)) == 0)).select("page_id").toPandas()["page_id"]
    bounds = np.sort(picked.to_numpy(np.int64))
    bounds = np.unique(bounds[np.arange(1, shards) * len(bounds) // shards]) if len(bounds) else bounds

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        found = np.searchsorted(bounds, ids.fillna(0).to_numpy(np.int64), "right")
        return pd.Series(np.where(ids.isna(), len(bounds), found).astype(np.int32))

    return len(bounds) + 1, place


def write(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archive all pages (page_id, url, html) in `folder`; gives the manifest: file, records, bytes,
    sha256.

    Of equal payloads of at least DEDUP_BYTES bytes the smallest page_id is a response, greater and
    null ids are revisits; rows that repeat the smallest id are responses too, and so are all rows of
    a group without ids. Null html is an empty payload, null url a URN of the id. Other columns are
    ignored. An empty table gives an empty manifest.
    """
    spark, html = pages.sparkSession, text_of("html")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"),
        F.octet_length(html).cast("long").alias("size"), F.sha2(html, 256).alias("digest"),
    )
    facts = stored(rows.select("page_id", "size", "digest"), "page_facts")
    groups = facts.where(F.col("size") >= DEDUP_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = stored(groups.where("n > 1 AND first IS NOT NULL").select("digest", "first"), "page_groups")
    shards, place = shard_of(pages, facts, shard_bytes)
    again = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    marked = rows.join(groups, "digest", "left").select(
        "page_id", "url", F.when(F.col("first").isNull() | ~again, F.col("html")).alias("html"), "size", "digest",
        F.when(again, F.col("first")).alias("first"), place("page_id").alias("shard"),
    )
    dealt = marked.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", F.col("page_id").asc_nulls_last(), "digest", F.col("url").asc_nulls_last())
    uri = _uri(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt, done, file, at = str(TaskContext.get().taskAttemptId()), [], None, (-1, 0)
        fs, path = _open(uri)
        fs.create_dir(path, recursive=True)
        for batch in batches:
            for page, url, body, size, digest, first, shard in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file is None or shard != at[0] or file.size >= file_bytes:
                    if file is not None:
                        done.append(file.close())
                    at = (shard, at[1] + 1 if shard == at[0] else 0)
                    file = _File(uri, f"pages-{at[0]:06d}-{at[1]:05d}.warc.gz", attempt)
                file.add(page_record(page, url, body, size, digest, first))
        if file is not None:
            done.append(file.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["file", "records", "bytes", "sha256"])

    manifest, part = f"{folder}/manifest", f"{folder}/.manifest-{uuid.uuid4().hex}"
    dealt.mapInArrow(run, "file string, records long, bytes long, sha256 string").write.parquet(part)
    path = spark._jvm.org.apache.hadoop.fs.Path
    path(part).getFileSystem(spark._jsc.hadoopConfiguration()).rename(path(part), path(manifest))
    return spark.read.parquet(manifest)


def _records(stream) -> Iterator[bytes]:
    """Each gzip member of an archive, unpacked."""
    left = b""
    while True:
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            left = left or stream.read(_CHUNK)
            if not left:
                if parts:
                    raise ValueError("archive ends inside a record")
                return
            parts.append(unpacker.decompress(left))
            left = unpacker.unused_data
        yield b"".join(parts)


def parse(record: bytes) -> tuple | None:
    """page_id, url, record_type, payload_bytes, payload_digest, refers_to and payload of a page's
    record; None for other records. Raises if lengths or digests don't hold."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if len(rest) != len(block) + 4 or fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    if fields["WARC-Type"] == "warcinfo":
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    whole = fields["WARC-Type"] == "response"
    if whole and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload {fields['WARC-Record-ID']}")
    number = lambda k: int(fields[k]) if fields.get(k) else None
    return number("X-Page-ID"), fields["WARC-Target-URI"], fields["WARC-Type"], size, digest, number("X-Refers-To-Page-ID"), payload.decode("utf-8") if whole else None


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All page records that the manifest of `folder` lists, checked against their digests."""
    uri = _uri(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(uri)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for record in _records(stream):
                        row = parse(record)
                        if row:
                            rows.append((*row, name))
                            size += len(record)
                        if size >= 4 * _CHUNK:
                            yield _batch(rows)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows)

    files = spark.read.parquet(f"{folder}/manifest").select("file")
    files = files.repartition(max(1, files.count()), "file")
    return files.mapInArrow(run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, html string, file string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "html", "file"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "llm", "warc")
    write(table(spark, sf_dir, "pages"), folder)
    return read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


CHECK = f"""
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT *, CASE WHEN payload_bytes >= {DEDUP_BYTES} THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM sized
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM firsts
"""
