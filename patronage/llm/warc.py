"""Deterministic sharded WARC writer and a reader for its archives.

Records are ordered by (key, digest, URI) and dealt to shards by fixed key bounds, which come from the keys whose hash is
small: the same rows give the same shards however the input is split. A task writes the shards it gets, a new file whenever
the compressed size reaches the limit, each record as a gzip member of its own with regenerated headers and digests. Files
are written under names of the attempt; the rows of the successful attempts, stored by Spark's own commit, list them; a
second pass renames them and the manifest is written last. Readers only open files of a manifest, so lost executors, repeated
attempts and broken runs leave nothing that counts.

Of records with equal payloads of at least ``least`` bytes the one with the smallest key is the response and the others
revisit it. Rows that share that smallest key are all responses.

Edge cases: a NULL payload is empty; a NULL URI writes no target header; NULL keys come last in order, are dealt by digest,
and are responses only where no equal payload has a key; repeated rows become repeated records; an empty table writes an
empty manifest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator
from uuid import NAMESPACE_URL, uuid5

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import open_store, ship, tasks_for

VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
STORED = "shard long, seq long, temporary string, name string, records long, bytes long, sha256 string"


def prepared(pages: DataFrame, key: str, uri: str, payload: str, least: int = 100) -> DataFrame:
    """(key, uri, payload, digest, bytes, record_type, refers_to). Only keys and digests are shuffled to find the first of
    equal payloads, and both sides of that join are stored or scanned, so a hot payload is split by the skew join."""
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(uri).alias("uri"),
                        F.coalesce(F.encode(F.col(payload), "UTF-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("long")})
    shared = (rows.where(F.col("bytes") >= least).groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("digest", "first"))
    joined = rows.join(materialize(shared, "shared-payloads"), "digest", "left")
    revisit = F.col("first").isNotNull() & (F.col("key").isNull() | (F.col("key") > F.col("first")))
    return joined.select("key", "uri", "payload", "digest", "bytes", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                         F.when(revisit, F.col("first")).alias("refers_to"))


def shard_bounds(rows: DataFrame, shard_bytes: int, per_shard: int = 64) -> list[int]:
    """Key bounds of about ``shard_bytes`` of payload each, from ``per_shard`` keys a shard, picked by hash."""
    total = rows.agg(F.sum("bytes").alias("b"), F.count("key").alias("n")).first()
    shards = max(1, -(-(total["b"] or 0) // shard_bytes))
    if shards == 1 or not total["n"]:
        return []
    share = min(1.0, per_shard * shards / total["n"])
    limit = int((share - 0.5) * (1 << 64)) if share < 1 else (1 << 63) - 1
    picked = sorted(r["key"] for r in rows.where(F.xxhash64("key") <= F.lit(min(limit, (1 << 63) - 1))).select("key").distinct().collect()
                    if r["key"] is not None)
    return sorted({picked[len(picked) * i // shards] for i in range(1, shards)}) if picked else []


def with_shards(rows: DataFrame, bounds: list[int]) -> DataFrame:
    """``rows`` with the number of bounds that are not above the key; rows without key are dealt by digest."""
    if not bounds:
        return rows.withColumn("shard", F.lit(0).cast("long"))
    edges = F.lit(bounds)
    # binary search: as many halvings as the number of bounds has bits
    halves = [1 << b for b in reversed(range(len(bounds).bit_length()))]
    low = F.lit(0)
    for half in halves:
        step = F.get(edges, low + F.lit(half - 1))
        low = F.when(step.isNotNull() & (step <= F.col("key")), low + F.lit(half)).otherwise(low)
    return rows.withColumn("shard", F.when(F.col("key").isNull(), F.pmod(F.xxhash64("digest"), F.lit(len(bounds) + 1))).otherwise(low.cast("long")))


def record(kind: str, key: int | None, uri: str | None, payload: bytes, digest: str, refers_to: int | None, least: int) -> bytes:
    """One record with headers made anew from its contents. A revisit holds no payload, only its digest and size."""
    sha = base64.b32encode(bytes.fromhex(digest)).decode()
    name = uuid5(NAMESPACE_URL, f"{key}:{uri}:{digest}")
    block = payload if kind != "revisit" else b""
    headers = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", DATE)]
    if uri is not None:
        headers.append(("WARC-Target-URI", "".join(c if 32 < ord(c) else f"%{ord(c):02X}" for c in uri)))
    headers += [("WARC-Payload-Digest", f"sha256:{sha}"),
                ("WARC-Block-Digest", f"sha256:{base64.b32encode(hashlib.sha256(block).digest()).decode()}")]
    if kind == "revisit":
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To-Key", str(refers_to)), ("WARC-Payload-Length", str(len(payload)))]
    if key is not None:
        headers.append(("WARC-Source-Key", str(key)))
    headers += [("Content-Type", "text/html"), ("Content-Length", str(len(block)))]
    return "".join([f"{VERSION}\r\n", *(f"{k}: {v}\r\n" for k, v in headers), "\r\n"]).encode() + block + b"\r\n\r\n"


def write(pages: DataFrame, folder: str, key: str = "page_id", uri: str = "url", payload: str = "html", shard_bytes: int = 1 << 26,
          file_bytes: int = 1 << 24, least: int = 100) -> DataFrame:
    """Write the archives under ``folder`` and return the manifest that was written there: (shard, seq, name, records, bytes, sha256)."""
    spark = pages.sparkSession
    rows = prepared(pages, key, uri, payload, least)
    bounds = shard_bounds(rows.select("key", "bytes"), shard_bytes)
    dealt = with_shards(rows, bounds)
    order = ["shard", F.col("key").asc_nulls_last(), "digest", F.col("uri").asc_nulls_first()]
    ordered = dealt.repartitionByRange(len(bounds) + 1, "shard").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        store.create_dir(f"{base}/_temporary", recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        done: list[tuple] = []
        out, shard, seq, records, size, digest, temporary = None, None, 0, 0, 0, None, ""

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                done.append((shard, seq, temporary, f"part-{shard:06d}-{seq:05d}.warc.gz", records, size, digest.hexdigest()))
                out = None

        try:
            for batch in batches:
                for at, k, u, body, sha, kind, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is not None and (at != shard or size >= file_bytes):
                        close()
                        seq = seq + 1 if at == shard else 0
                    if out is None:
                        seq = seq if at == shard else 0
                        shard, records, size, digest = at, 0, 0, hashlib.sha256()
                        temporary = f"_temporary/{attempt}-{shard:06d}-{seq:05d}"
                        out = store.open_output_stream(f"{base}/{temporary}", compression=None)
                    packed = gzip.compress(record(kind, k, u, body, sha, refers, least), 6, mtime=0)
                    out.write(packed)
                    digest.update(packed)
                    size, records = size + len(packed), records + 1
            close()
        finally:
            if out is not None:
                out.close()
        if done:
            yield batch_of(done, STORED)

    columns = ("shard", "key", "uri", "payload", "digest", "record_type", "refers_to")
    stored = materialize(ordered.select(*columns).mapInArrow(run, STORED), "warc-attempts")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                target, source = f"{base}/{row['name']}", f"{base}/{row['temporary']}"
                # a repeated attempt finds the file in place already
                if store.get_file_info(source).type != type(store.get_file_info(source).type).NotFound:
                    store.move(source, target)
                elif store.get_file_info(target).size != row["bytes"]:
                    raise OSError(f"{row['name']} is neither committed nor waiting")
            yield batch.drop_columns(["temporary"])

    manifest = f"{folder}/manifest"
    listed = STORED.replace("temporary string, ", "")
    stored.repartition(file_tasks(stored), "shard", "seq").mapInArrow(commit, listed).write.parquet(manifest)
    return spark.read.schema(listed).parquet(manifest)


def file_tasks(files: DataFrame) -> int:
    """Tasks for files listed with their ``bytes``."""
    total, count = files.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count(F.lit(1))).first()
    return tasks_for(files.sparkSession, total, count)


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)],
                                      names=[n for n, _ in fields])


def records_of(source, chunk: int = 1 << 16) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a file of gzip members, with one record in memory at a time."""
    data, inflate, buffer = b"", zlib.decompressobj(31), io.BytesIO()
    while True:
        if not data:
            data = source.read(chunk)
            if not data:
                if buffer.tell():
                    raise ValueError("the archive ends inside a record")
                return
        buffer.write(inflate.decompress(data))
        data = inflate.unused_data
        if inflate.eof:
            head, _, rest = buffer.getvalue().partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            if lines[0] != VERSION:
                raise ValueError(f"not a record: {lines[0]!r}")
            headers = dict(line.split(": ", 1) for line in lines[1:])
            size = int(headers["Content-Length"])
            if len(rest) != size + 4:
                raise ValueError("a block's length differs from its header")
            yield headers, rest[:size]
            inflate, buffer = zlib.decompressobj(31), io.BytesIO()


READ = ("key long, uri string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, "
        "file string, record long")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archives in the manifest of ``folder``. Block digests are checked; a revisit's payload is NULL and
    its payload digest and length are those it states."""
    listed = spark.read.parquet(f"{folder}/manifest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{base}/{name}", compression=None) as source:
                    for number, (headers, block) in enumerate(records_of(source)):
                        if base64.b32decode(headers["WARC-Block-Digest"].removeprefix("sha256:")) != hashlib.sha256(block).digest():
                            raise ValueError(f"{name}, record {number}: the block does not match its digest")
                        revisit = headers["WARC-Type"] == "revisit"
                        key, refers = headers.get("WARC-Source-Key"), headers.get("WARC-Refers-To-Key")
                        rows.append((key and int(key), headers.get("WARC-Target-URI"), headers["WARC-Type"], refers and int(refers),
                                     int(headers["WARC-Payload-Length"]) if revisit else len(block),
                                     base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha256:")).hex(),
                                     None if revisit else block, name, number))
                        held += len(block)
                        if held > 1 << 22 or len(rows) >= 1024:
                            yield batch_of(rows, READ)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows, READ)

    return listed.select("name", "bytes").repartition(file_tasks(listed), "name").select("name").mapInArrow(run, READ)


ship(__name__)
