"""Deterministic sharded WARC archives.

Payloads are grouped by digest and length for their smallest page_id, which becomes the response that the others
revisit.  Pages are dealt to shards by ranges of page_id, whose borders come from a byte histogram over equal ranges
of ids (an overfull range is dealt on by hash); a shard is sorted by page_id and rolled into files by compressed
size.  Headers, digests, record ids and gzip members depend on the row alone, so that a task that runs again writes
the same bytes.  Files are written under a temporary name and renamed; each shard hands back a manifest row per file
(name, bytes, records, digest), and readers take only files of the manifest, which is written last.

Null html: an empty payload.  Null url: a urn.  A page_id that repeats within one payload: every row of the smallest
id is a response.  A null page_id never makes a response where another page has one.  Payloads under 100 bytes are
never revisited.  Names of the input's other columns do not matter.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import stage
from snapstats.session import scratch_path

LEAST, ROLL_BYTES, SHARD_BYTES, RANGES = 100, 16 << 20, 32 << 20, 4096
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "file string, bytes long, records long, sha256 string"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, position long"


def payloads(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, its digest and size."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"))
    return rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})


def revisits(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, digest, refers_to) of what repeats an earlier payload; payloads themselves are not moved."""
    narrow = rows.where(F.col("size") >= least).select("page_id", "digest", "size")
    first = narrow.groupBy("digest", "size").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    later = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return narrow.join(first, ["digest", "size"]).where(later).select("page_id", "digest", "refers_to").distinct()


def shard_borders(rows: DataFrame, shard_bytes: int = SHARD_BYTES, ranges: int = RANGES) -> tuple[int, int, list[tuple[int, int]]]:
    """(lowest id, width, [(first shard, number of shards) per range]) from at most ``ranges`` sums."""
    low, high = rows.agg(F.min("page_id"), F.max("page_id")).first()
    low, high = (0, 0) if low is None else (low, high)
    width = (high - low) // ranges + 1
    cell = F.coalesce(F.expr(f"cast((cast(page_id as decimal(20,0)) - {low}) div {width} as int)"), F.lit(0))
    sizes = dict(rows.groupBy(cell.alias("cell")).agg(F.sum(F.col("size") + 400).alias("b")).collect())
    borders, shard, filled = [], 0, 0
    for k in range((high - low) // width + 1):
        own = sizes.get(k, 0)
        if filled and filled + own > shard_bytes:
            shard, filled = shard + 1, 0
        parts = -(-own // shard_bytes) or 1
        borders.append((shard, parts))
        shard, filled = (shard + parts, 0) if parts > 1 else (shard, filled + own)
    return low, width, borders


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One gzip member: a response with its payload, or a revisit without."""
    name = lambda i: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{i}:{digest}')}>"
    safe = "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in url) if url is not None else f"urn:page:{page_id}"
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", name(page_id)), ("WARC-Date", date),
            ("WARC-Target-URI", safe), ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Payload-Length", len(payload))]
    if page_id is not None:
        head.append(("WARC-Page-ID", page_id))
    if refers_to is not None:
        head += [("WARC-Refers-To", name(refers_to)), ("WARC-Refers-To-Page-ID", refers_to),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return gzip.compress(text.encode() + block + b"\r\n\r\n", mtime=0)


def write_archives(pages: DataFrame, target: str, roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write below ``target`` (a URI that pyarrow opens); the manifest, also kept as ``target/manifest``."""
    rows = payloads(pages)
    low, width, borders = shard_borders(rows, shard_bytes)
    cell = F.coalesce(F.expr(f"cast((cast(page_id as decimal(20,0)) - {low}) div {width} as int)"), F.lit(0))
    places = F.from_json(F.lit(json.dumps([{"first": s, "n": n} for s, n in borders])), "array<struct<first:int,n:int>>")
    place = F.get(places, cell)
    shard = (place["first"] + F.pmod(F.xxhash64("page_id", "digest"), place["n"])).cast("int")
    # a mark comes to the shard of its page, just before it
    marks = revisits(rows).withColumns({"url": F.lit(None).cast("string"), "payload": F.lit(None).cast("binary"), "body": F.lit(0)})
    every = rows.drop("size").withColumns({"refers_to": F.lit(None).cast("long"), "body": F.lit(1)}).unionByName(marks)
    dealt = every.withColumn("shard", shard)
    ordered = dealt.repartitionById(borders[-1][0] + borders[-1][1], F.col("shard")).sortWithinPartitions(
        "shard", "page_id", "digest", "body", "url")

    def write(batches):
        files, root = pafs.FileSystem.from_uri(target)
        files.create_dir(root, recursive=True)
        task, out, number = TaskContext.get().taskAttemptId(), None, {}

        def close():
            name, raw, n = out
            body = raw.getvalue()
            temporary = f"{root}/_{name}.{task}.tmp"
            with files.open_output_stream(temporary, compression=None) as f:
                f.write(body)
            files.move(temporary, f"{root}/{name}")
            return name, len(body), n, hashlib.sha256(body).hexdigest()

        def frame(done):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                ["file", "bytes", "records", "sha256"])

        current, marked = None, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("body", "refers_to", "shard", "page_id", "url", "payload", "digest")]
            for body, refers_to, shard, *row in zip(*columns, strict=True):
                if not body:
                    marked = (row[0], row[3], refers_to)
                    continue
                refers_to = marked[2] if marked and marked[:2] == (row[0], row[3]) else None
                if out and (shard != current or out[1].tell() >= roll_bytes):
                    yield frame([close()])
                    out = None
                current = shard
                if out is None:
                    number[shard] = number.get(shard, -1) + 1
                    out = [f"shard-{shard:05d}-{number[shard]:05d}.warc.gz", io.BytesIO(), 0]
                out[1].write(record(*row, refers_to))
                out[2] += 1
        if out:
            yield frame([close()])

    manifest = stage(ordered.mapInArrow(write, MANIFEST), "warc-manifest")
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{target}/manifest")
    return manifest


def members(raw: bytes):
    """The records of an archive, one gzip member at a time: (position, headers, block)."""
    at = 0
    while at < len(raw):
        zip_ = zlib.decompressobj(wbits=31)
        data = zip_.decompress(raw[at:at + (1 << 20)] if len(raw) - at > (1 << 20) else raw[at:])
        fed = min(len(raw), at + (1 << 20))
        while not zip_.eof and fed < len(raw):
            data += zip_.decompress(raw[fed : fed + (1 << 20)])
            fed += 1 << 20
        head, _, rest = data.partition(b"\r\n\r\n")
        headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield at, headers, rest[: int(headers["Content-Length"])]
        at = min(len(raw), fed) - len(zip_.unused_data)


def read_archives(manifest: DataFrame, target: str) -> DataFrame:
    """Every record of the manifest's files; sizes and digests are those of the files, and are checked."""
    spark = manifest.sparkSession
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.warc.gz").load(target).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    wanted = files.join(manifest.select("file", "sha256"), "file")

    def parse(batches):
        for batch in batches:
            out = []
            for name, raw, digest in zip(*(batch.column(c).to_pylist() for c in ("file", "content", "sha256")), strict=True):
                if hashlib.sha256(raw).hexdigest() != digest:
                    raise ValueError(f"{name} is not the file of the manifest")
                for at, h, block in members(raw):
                    page, refers = (int(h[k]) if k in h else None for k in ("WARC-Page-ID", "WARC-Refers-To-Page-ID"))
                    known, size = h["WARC-Payload-Digest"].removeprefix("sha256:"), int(h["WARC-Payload-Length"])
                    if h["WARC-Type"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        size, got = len(payload), hashlib.sha256(payload).hexdigest()
                        if got != known:
                            raise ValueError(f"{name} at {at}: payload does not match its digest")
                    out.append((page, size, known, h["WARC-Type"], refers, name, at))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                             [f.split()[0] for f in RECORDS.split(", ")])

    return wanted.mapInArrow(parse, RECORDS)


def round_trip(pages: DataFrame, roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Archives below the shared folder, written and read back."""
    target = scratch_path(pages.sparkSession, "warc")
    uri = target if "://" in target or target.startswith("file:") else f"file://{target}"
    return read_archives(write_archives(pages, uri, roll_bytes, shard_bytes), uri)
