"""WARC archives: a writer and a sequential reader, one gzip member per record.

The reader inflates incrementally in small pieces, frames every block by its
``Content-Length`` and verifies the digests in the header, so neither an archive nor a
record need fit in memory (a record's payload is kept only when asked for).

Defined cases: null html is an empty payload; a null url gives a record without target; a
null page id is written as ``null`` and read back as null (it refers to others like any
id, and is the response only in a group that has no other id); rows that repeat both page
id and payload get records of the same type; empty tables give no archive and no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store
from .common import col, drop_path, join_groups, scratch_path, ship, stage, table

DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
URN = "urn:gridloom:page:"
MOST_HEADER = 1 << 20


def member(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, level: int = 6) -> bytes:
    """One record as one gzip member.  A revisit record carries no block."""
    block = b"" if revisit else HTTP % len(payload) + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{URN}{'null' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}"] if url is not None else []),
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"X-Payload-Length: {len(payload)}",
        *(["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{URN}{'null' if refers_to is None else refers_to}>"] if revisit else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


class _Record:
    """Parses one record from inflated pieces."""

    def __init__(self, keep: bool):
        self.head: dict[str, str] | None = None
        self.pending = b""
        self.block, self.payload = hashlib.sha256(), hashlib.sha256()
        self.left = self.payload_bytes = 0
        self.in_payload = False
        self.tail = b""
        self.kept: list[bytes] | None = [] if keep else None

    def feed(self, data: bytes) -> None:
        if self.head is None:
            self.pending += data
            end = self.pending.find(b"\r\n\r\n")
            if end < 0:
                if len(self.pending) > MOST_HEADER:
                    raise ValueError("a record's header does not end")
                return
            lines = self.pending[:end].decode().split("\r\n")
            if not lines[0].startswith("WARC/1."):
                raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
            self.head = dict(x.split(": ", 1) for x in lines[1:])
            self.left = int(self.head["Content-Length"])
            data, self.pending = self.pending[end + 4 :], b""
        mine, rest = data[: self.left], data[self.left :]
        self.left -= len(mine)
        if mine:
            self.block.update(mine)
            self._payload(mine)
        self.tail += rest
        if len(self.tail) > 4:
            raise ValueError("a record's length does not match its frame")

    def _payload(self, data: bytes) -> None:
        if not self.in_payload:
            self.pending += data
            end = self.pending.find(b"\r\n\r\n")
            if end < 0:
                if len(self.pending) > MOST_HEADER:
                    raise ValueError("a response's header does not end")
                return
            data, self.pending, self.in_payload = self.pending[end + 4 :], b"", True
        self.payload.update(data)
        self.payload_bytes += len(data)
        if self.kept is not None:
            self.kept.append(data)

    def done(self) -> dict:
        h = self.head
        if h is None or self.left or self.tail != b"\r\n\r\n":
            raise ValueError("a record's length does not match its frame")
        if h["WARC-Block-Digest"] != f"sha256:{self.block.hexdigest()}":
            raise ValueError(f"block digest of {h['WARC-Record-ID']} does not match")
        digest, size = h["WARC-Payload-Digest"].removeprefix("sha256:"), int(h["X-Payload-Length"])
        if h["WARC-Type"] == "response" and (digest, size) != (self.payload.hexdigest(), self.payload_bytes):
            raise ValueError(f"payload digest of {h['WARC-Record-ID']} does not match")
        return {
            "page_id": _page(h["WARC-Record-ID"]),
            "url": h.get("WARC-Target-URI"),
            "payload_bytes": size,
            "payload_digest": digest,
            "record_type": h["WARC-Type"],
            "refers_to": _page(h["WARC-Refers-To"]) if "WARC-Refers-To" in h else None,
            "payload": b"".join(self.kept) if self.kept is not None and h["WARC-Type"] == "response" else None,
        }


def _page(uri: str) -> int | None:
    x = uri.strip("<>").removeprefix(URN)
    return None if x == "null" else int(x)


def read_records(stream, keep_payload: bool = False, chunk: int = 1 << 16) -> Iterator[dict]:
    """Records of an archive in order; raises where framing or digests do not hold."""
    data = stream.read(chunk)
    while data:
        z, record = zlib.decompressobj(31), _Record(keep_payload)
        while not z.eof:
            if not data:
                raise ValueError("the archive ends inside a record")
            record.feed(z.decompress(data, 4 * chunk))
            data = z.unconsumed_tail or (stream.read(chunk) if not z.eof else b"")
        yield record.done()
        data = z.unused_data or stream.read(chunk)


def plan_records(pages: DataFrame, min_bytes: int = 100, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Rows to write: page_id, url, payload, digest, refers_to, revisit.

    Only ids and digests are grouped by digest; payloads travel keyed by (id, digest).
    """
    payload = F.coalesce(col(pages, payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(col(pages, id_col).cast("long").alias("page_id"), col(pages, url_col).cast("string").alias("url"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    keys = stage(rows.select("page_id", "digest", F.octet_length("payload").alias("n")), "warc-keys").where(F.col("n") >= min_bytes)
    first = stage(keys.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies")).where("copies > 1"), "warc-groups")
    again = join_groups(keys, first, "digest", "copies", keys.count()).where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "refers_to").distinct()
    joined = rows.join(again, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest")), "left")
    return joined.select("page_id", "url", "payload", "digest", "refers_to", F.col("again_digest").isNotNull().alias("revisit"))


def write_archives(rows: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Write one archive per partition; returns the staged manifest (path, records)."""
    ship(rows.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, n, batch = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz", 0, next(batches, None)
        if batch is None:
            return
        with store.create(path) as f:
            while batch is not None:
                for at in range(0, batch.num_rows, 256):
                    for r in batch.slice(at, 256).to_pylist():
                        f.write(member(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"], r["revisit"], level))
                        n += 1
                batch = next(batches, None)
        yield pa.RecordBatch.from_pydict({"path": [path], "records": [n]})

    return stage(rows.mapInArrow(write, "path string, records long"), "warc-manifest")


def read_archives(manifest: DataFrame, keep_payload: bool = False) -> DataFrame:
    """Records of all archives of a manifest, read one archive after another in each task."""
    ship(manifest.sparkSession)
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for entry in batch.to_pylist():
                n, rows = 0, []
                with store.reading(entry["path"]) as f:
                    for record in read_records(f, keep_payload):
                        n += 1
                        rows.append(record)
                        if len(rows) == 512:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                if n != entry["records"]:
                    raise ValueError(f"{entry['path']} holds {n} records, not {entry['records']}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = max(1, manifest.count())
    return manifest.repartition(files).mapInArrow(read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary").select(*names)


def _verified(records: DataFrame) -> DataFrame:
    """The records; raises where a revisit's digest or length is not that of the response it
    names (or that is missing)."""
    there = records.where("record_type = 'response'").groupBy(F.col("page_id").alias("named"), F.col("payload_digest").alias("named_digest"), F.col("payload_bytes").alias("named_bytes")).agg(F.lit(True).alias("there"))
    revisits = records.where("record_type = 'revisit'").groupBy("refers_to", "payload_digest", "payload_bytes").agg(F.count(F.lit(1)).alias("n"))
    lost = revisits.join(there, F.col("refers_to").eqNullSafe(F.col("named")) & (F.col("payload_digest") == F.col("named_digest")) & (F.col("payload_bytes") == F.col("named_bytes")), "left_anti")
    if not lost.isEmpty():
        raise ValueError("a revisit does not agree with the response that it names")
    return records


def round_trip(pages: DataFrame, min_bytes: int = 100, keep_payload: bool = False, **columns: str) -> DataFrame:
    folder = scratch_path(pages.sparkSession, "warc")
    manifest = write_archives(plan_records(pages, min_bytes, **columns), folder)
    out = stage(read_archives(manifest, keep_payload), "warc-records")
    drop_path(pages.sparkSession, folder)
    return _verified(out)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = round_trip(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT *, strlen(h) AS n, min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM g
"""
