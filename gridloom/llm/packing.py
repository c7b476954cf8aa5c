"""Packing documents into sequences by large-item matching and best fit.

Pieces of equal length are interchangeable, so the plan is made on the histogram of piece
lengths (at most ``capacity`` entries, whatever the corpus size) and works with bin classes
``(pattern, number of bins)`` instead of single bins:

* items above a third of the capacity meet at most twice in a bin: from the largest down,
  each is matched with the largest other one that still fits;
* smaller items, from the largest down, go to the bins whose gap fits them best.

The pieces are then numbered inside their length (in two levels, so a frequent length is
no hot group) and looked up in the table of slots.

Documents longer than the capacity are cut into full pieces, the first piece taking the
remainder.  Defined cases: null and empty texts are the end id alone; the name of a special
token inside a text is encoded as that token, as the library does; rows that repeat a
document are packed each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textual
from .common import col, ranked, ship, stage, table
from .tokens import VOCABULARY, crc, encoder


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))] if n else []


def pack_histogram(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Bin classes: (run-length pattern, number of such bins) that use up ``counts``."""
    left = [0] * (capacity + 1)
    for length, n in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit")
        left[length] = n
    gaps: dict[int, list[tuple[list[tuple[int, int]], int]]] = defaultdict(list)
    open_gaps = 0  # bit g is set where bins with gap g exist

    def put(pattern: list[tuple[int, int]], n: int, gap: int) -> None:
        nonlocal open_gaps
        gaps[gap].append((pattern, n))
        open_gaps |= 1 << gap

    third = capacity // 3
    present = sum(1 << x for x in range(third + 1, capacity + 1) if left[x])
    for big in range(capacity, third, -1):
        while left[big]:
            fits = present & ((1 << max(capacity - big + 1, 0)) - 1)
            mate = fits.bit_length() - 1
            if mate == big and left[big] == 1:
                fits &= ~(1 << big)
                mate = fits.bit_length() - 1
            if mate <= third:
                put([(big, 1)], left[big], capacity - big)
                left[big] = 0
            elif mate == big:
                put([(big, 2)], left[big] // 2, capacity - 2 * big)
                left[big] %= 2
            else:
                n = min(left[big], left[mate])
                put([(big, 1), (mate, 1)], n, capacity - big - mate)
                left[big] -= n
                left[mate] -= n
                if not left[mate]:
                    present &= ~(1 << mate)
            if not left[big]:
                present &= ~(1 << big)
    for small in range(third, 0, -1):
        while left[small]:
            usable = open_gaps >> small
            if not usable:
                each = capacity // small
                bins, rest = divmod(left[small], each)
                if bins:
                    put([(small, each)], bins, capacity - each * small)
                if rest:
                    put([(small, rest)], 1, capacity - rest * small)
                break
            gap = small + (usable & -usable).bit_length() - 1
            pattern, bins = gaps[gap].pop()
            if not gaps[gap]:
                open_gaps &= ~(1 << gap)
            n = min(bins, left[small])
            if n < bins:
                put(pattern, bins - n, gap)
            more = [*pattern[:-1], (small, pattern[-1][1] + 1)] if pattern[-1][0] == small else [*pattern, (small, 1)]
            put(more, n, gap - small)
            left[small] -= n
    return [x for classes in gaps.values() for x in classes]


def slot_table(classes: list[tuple[list[tuple[int, int]], int]]) -> dict[int, np.ndarray]:
    """Per length rows (first rank, bins, first sequence, offset), by rising first rank."""
    rows, taken, sequence = defaultdict(list), defaultdict(int), 0
    for pattern, bins in classes:
        offset = 0
        for length, each in pattern:
            rows[length].append((taken[length], bins, sequence, offset))
            taken[length] += bins * each
            offset += length * each
        sequence += bins
    return {k: np.array(v, dtype=np.int64) for k, v in rows.items()}


def pieces(docs: DataFrame, capacity: int = 1024, end_id: int = 2, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    ship(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            for part in textual.pieces(batch):
                ids, offsets = enc.encode(part.column("text"), end_id)
                places = [cut(int(n), capacity) for n in np.diff(offsets)]
                per_text = np.fromiter(map(len, places), np.int64, len(places))
                start, length = np.array([x for p in places for x in p], np.int64).reshape(-1, 2).T
                text = np.repeat(np.arange(len(places)), per_text)
                nth = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
                at = offsets[text] + start
                sums = np.fromiter((crc(ids[a : a + n]) for a, n in zip(at.tolist(), length.tolist())), np.int64, len(at))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(text)), pa.array(nth, pa.int32()), pa.array(start), pa.array(length), pa.array(sums)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(col(docs, id_col).cast("long").alias("doc_id"), col(docs, text_col).cast("string").alias("text"))
    return rows.mapInArrow(encode, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, capacity: int = 1024, end_id: int = 2, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces with sequence_id and offset."""
    spark = docs.sparkSession
    items = stage(pieces(docs, capacity, end_id, vocabulary, id_col, text_col), "pack-pieces")
    counts = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    slots = spark.sparkContext.broadcast(slot_table(pack_histogram(counts, capacity)))
    cells = max(1, math.isqrt(sum(counts.values())))
    keyed = items.withColumn("key", F.xxhash64("doc_id", "piece", "start", "ids_crc32"))
    numbered = ranked(keyed, ["length"], "key", ["doc_id", "piece", "start", "ids_crc32"], cells).drop("key")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            sequence, offset = np.empty_like(ranks), np.empty_like(ranks)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                rows = slots.value[int(length)]
                rows = rows[np.searchsorted(rows[:, 0], ranks[at], "right") - 1]
                nth, which = np.divmod(ranks[at] - rows[:, 0], rows[:, 1])
                sequence[at] = rows[:, 2] + which
                offset[at] = rows[:, 3] + nth * length
            keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(sequence), pa.array(offset)], [*keep, "sequence_id", "offset"])

    columns = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return columns.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
