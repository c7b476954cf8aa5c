"""Token-id files: independent zstandard frames with a trailing seek table.

Layout of a file (all integers little-endian):

* one zstandard frame per document, holding its ids as unsigned 32-bit integers, with
  zstandard's own content checksum;
* a skippable frame (0x184D2A50): version, document count, then per document its id (64
  bit) and a flag byte (1: the id is null);
* a skippable frame (0x184D2A5E) in the public seekable format: per frame its compressed
  and decompressed size and the low 32 bits of the xxh64 of its content, then the frame
  count, the descriptor 0x80 and the magic 0x8F92EAB1.

A reader takes the table from the end of the file and then inflates only the frames of the
documents asked for, checking each.  Files follow ascending document ids.

Defined cases: a null text is empty, an empty text has only the end id; null ids come
first; rows that repeat an id follow each other in the order of a checksum of their ids;
the name of a special token inside a text is encoded as that token, as the library does;
extra columns are ignored; an empty table gives no file and no rows.
"""

from __future__ import annotations

import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import store
from .common import Staged, col, drop_path, scratch_path, ship, stage, table
from .tokens import VOCABULARY, crc, encoder, pieces

DIRECTORY, SEEK, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1


class Writer:
    def __init__(self, stream, level: int = 3):
        self.stream = stream
        self.zip = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.ids, self.nulls = array("q"), bytearray()
        self.table = array("I")
        self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.add_frame(doc_id, self.zip.compress(ids), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF)

    def add_frame(self, doc_id: int | None, frame: bytes, size: int, checksum: int) -> None:
        """A document whose frame is made already: ``size`` bytes of ids with that checksum."""
        self.stream.write(frame)
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.table.extend((len(frame), size, checksum))
        self.tokens += size // 4

    def close(self) -> None:
        n = len(self.ids)
        body = struct.pack("<II", 1, n) + self.ids.tobytes() + bytes(self.nulls)
        self.stream.write(struct.pack("<II", DIRECTORY, len(body)) + body)
        body = self.table.tobytes() + struct.pack("<IBI", n, 0x80, SEEKABLE)
        self.stream.write(struct.pack("<II", SEEK, len(body)) + body)


class Reader:
    """Random access to the documents of one file."""

    def __init__(self, stream):
        self.stream = stream
        stream.seek(0, 2)
        end = stream.tell()
        stream.seek(end - 9)
        n, descriptor, magic = struct.unpack("<IBI", stream.read(9))
        if magic != SEEKABLE or descriptor != 0x80:
            raise ValueError("no seek table at the end of the file")
        stream.seek(end - 9 - 12 * n - 8)
        if struct.unpack("<II", stream.read(8)) != (SEEK, 12 * n + 9):
            raise ValueError("the seek table's frame does not match its size")
        entries = array("I", stream.read(12 * n))
        self.sizes, self.lengths, self.sums = entries[0::3], entries[1::3], entries[2::3]
        at = end - 9 - 12 * n - 8 - (9 * n + 8) - 8
        stream.seek(at)
        head = struct.unpack("<IIII", stream.read(16))
        if head != (DIRECTORY, 9 * n + 8, 1, n):
            raise ValueError("the directory does not match the seek table")
        ids = array("q", stream.read(8 * n))
        nulls = stream.read(n)
        self.ids = [None if z else i for i, z in zip(ids, nulls, strict=True)]
        self.places, where = array("Q"), 0
        for x in self.sizes:
            self.places.append(where)
            where += x
        if where != at:
            raise ValueError("the frames do not fill the file")
        self.zip = zstandard.ZstdDecompressor()

    def read(self, k: int) -> bytes:
        """Ids of the file's document ``k``, checked."""
        self.stream.seek(self.places[k])
        ids = self.zip.decompress(self.stream.read(self.sizes[k]))
        if len(ids) != self.lengths[k] or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"frame {k} does not match its checksum")
        return ids

    def find(self, doc_id: int | None) -> list[bytes]:
        return [self.read(k) for k, x in enumerate(self.ids) if x == doc_id]


def frames(docs: DataFrame, end_id: int, vocabulary: str, id_col: str, text_col: str, level: int = 3) -> DataFrame:
    """doc_id, frame, size, checksum: every document encoded and compressed where it lies."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, zipper = encoder(vocabulary), zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        for batch in batches:
            for part in pieces(batch):
                ids, offsets = enc.encode(part.column("text"), end_id)
                each = [ids[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
                sums = np.fromiter((xxhash.xxh64_intdigest(x) & 0xFFFFFFFF for x in each), np.int64, len(each))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([zipper.compress(x) for x in each], pa.binary()), pa.array(4 * np.diff(offsets)), pa.array(sums)], ["doc_id", "frame", "size", "checksum"])

    rows = docs.select(col(docs, id_col).cast("long").alias("doc_id"), col(docs, text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, frame binary, size long, checksum long")


def write_token_files(docs: DataFrame, folder: str, end_id: int = 0, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode where texts lie, range-partition the frames by id, write a file per partition;
    returns the manifest (path, part, documents, tokens, start)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, batch = TaskContext.get().partitionId(), next(batches, None)
        if batch is None:
            return
        path, n = f"{folder}/part-{part:06d}.tok.zst", 0
        with store.create(path) as f:
            w = Writer(f)
            while batch is not None:
                for doc_id, frame, size, checksum in zip(*(batch.column(c) for c in ("doc_id", "frame", "size", "checksum")), strict=True):
                    w.add_frame(doc_id.as_py(), frame.as_buffer(), size.as_py(), checksum.as_py())
                    n += 1
                batch = next(batches, None)
            w.close()
        yield pa.RecordBatch.from_pydict({"path": [path], "part": [part], "documents": [n], "tokens": [w.tokens]})

    made = Staged(frames(docs, end_id, vocabulary, id_col, text_col), "token-frames")
    rows = made.df.withColumn("n", F.monotonically_increasing_id())  # so that rows which repeat an id may lie in several files
    rows = rows.repartitionByRange("doc_id", "checksum", "n").sortWithinPartitions("doc_id", "checksum", "n").drop("n")
    files = stage(rows.mapInArrow(write, "path string, part long, documents long, tokens long"), "token-manifest")
    made.drop()
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    ship(manifest.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for entry in batch.to_pylist():
                start, rows = entry["start"], []
                with store.reading(entry["path"]) as f:
                    file = Reader(f)
                    for k, doc_id in enumerate(file.ids):
                        ids = file.read(k)
                        rows.append({"doc_id": doc_id, "start": start, "n_tokens": len(ids) // 4, "ids_crc32": crc(ids)})
                        start += len(ids) // 4
                        if len(rows) == 2048:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                if start - entry["start"] != entry["tokens"]:
                    raise ValueError(f"{entry['path']} holds another number of ids")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = max(1, manifest.count())
    return manifest.repartition(files).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    manifest = write_token_files(table(spark, sf_dir, "documents"), folder)
    out = stage(read_token_files(manifest), "token-documents")
    drop_path(spark, folder)
    return out
