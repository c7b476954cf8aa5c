"""MinHash near-dedup: universal hash minima, banding, verification, components.

1. Every whole text gives its set of distinct word shingles (64-bit hashes); many
   multiply-shift universal hashes give the minima, kept as the signature.  Texts with equal
   sets form a class, represented by its smallest document id.
2. Bands of the signature put classes into buckets.  A bucket never emits its pairs.  First
   each member is compared with the bucket's least id.  What is still split into several
   components then meets centres (members of the smallest components first), streamed past
   ``CENTRES`` of them at a time in blocks of about ``BLOCK`` members, so a task's memory is
   bounded.  Centres leave the bucket, and each round takes twice as many, so a bucket of
   ``m`` members takes ``log2(m / CENTRES)`` rounds at most; it is settled as soon as what is
   left belongs to one component.  A
   pair is thus skipped only when a chain of links joins it already, so the components are
   those of all links among the buckets' pairs.  A pair that shares several buckets is
   compared in the first of them.
3. Comparisons are screened by size and by signature agreement (a margin of 0.25, seven
   standard deviations, below the threshold) and confirmed on the full sets; only links
   that join two components leave the task.
4. Components by alternating large-star and small-star.

With 24 bands of 4 a pair at the threshold of 0.85 shares no band with a chance of 2e-8
(0.8: 3e-6).

Defined cases: null and empty texts and texts without words have an empty set, linked with
nothing; shorter texts than a shingle count as one shingle; rows without an id are linked
with nothing and are their own (null) component; rows that repeat an id are one node;
empty tables give no rows; extra columns are ignored (``drop_near_copies`` carries them).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import col, fresh, ship, stage, table
from .components import components
from .textual import ascii_words, pieces

BANDS, ROWS = 24, 4
BLOCK, CENTRES = 2048, 256
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], dtype=np.uint64)


def _final(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x9FB21C651E98DF25)
    x ^= x >> np.uint64(32)
    return x


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its word shingles."""
    parts = ascii_words(texts)
    names = parts.distinct.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names))[parts.codes]
    n = np.diff(parts.offsets)
    width = np.minimum(n, size)
    count = np.where(n > 0, np.maximum(1, n - size + 1), 0)
    ends = np.cumsum(count)
    at = np.arange(int(count.sum())) + np.repeat(parts.offsets[:-1] - (ends - count), count)
    short = bool((width < size).any())
    wide = np.repeat(width, count) if short else None
    out = np.repeat(width, count).astype(np.uint64)
    for k in range(size if len(out) else 0):
        if short:
            real = wide > k
            out[real] = _final(out[real] * _MIX[k % 7] + h[at[real] + k])
        else:
            out = _final(out * _MIX[k % 7] + h[at + k])
    return [np.unique(out[x:y]) for x, y in zip(ends - count, ends)]


def hash_family(n: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 64, n, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 64, n, dtype=np.uint64)


def minima(s: np.ndarray, a: np.ndarray, b: np.ndarray, piece: int = 2048) -> np.ndarray:
    """High halves of ``a*x + b`` (mod 2^64), least over the set, per hash."""
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(s), piece):
        x = a[:, None] * s[None, at : at + piece]
        x += b[:, None]
        np.minimum(out, (x.min(1) >> np.uint64(32)).astype(np.uint32), out=out)
    return out


def signatures(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, cls (digest of the set), sig (little-endian 32-bit minima)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = hash_family(BANDS * ROWS)
        for batch in batches:
            for part in pieces(batch):
                sets = shingle_sets(part.column("text"), size)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                        "cls": pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        "sig": pa.array([minima(s, a, b).tobytes() for s in sets], pa.binary()),
                    }
                )

    return _rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_shingles long, cls binary, sig binary")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(col(docs, id_col).cast("long").alias("doc_id"), col(docs, text_col).cast("string").alias("text"))


def _sets(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                yield pa.RecordBatch.from_pydict({"rep": part.column("doc_id"), "set": pa.array([s.tobytes() for s in shingle_sets(part.column("text"), size)], pa.binary())})

    return docs.mapInArrow(run, "rep long, set binary")


def _screen(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b")]
            yield batch.select(["a", "b"]).filter(pa.array((x[0] == x[1]).mean(1) >= least))

    return run


def _confirm(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = batch.column("set_a"), batch.column("set_b")
            keep = []
            for x, y in zip(xs, ys, strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _only(big: DataFrame, key: str, ids: DataFrame, limit: int = 200_000) -> DataFrame:
    """Rows of ``big`` whose key is among ``ids``; ids are broadcast only if so many at most."""
    ids = ids.distinct()
    if ids.limit(limit + 1).count() <= limit:
        ids = F.broadcast(ids)
    return big.join(ids, key, "left_semi")


def verified(pairs: DataFrame, sigs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""

    def side(t: DataFrame, x: str) -> DataFrame:
        return t.select(*[F.col(c).alias(x if c == "rep" else f"{c}_{x}") for c in t.columns])

    near = pairs.join(side(sigs, "a"), "a").join(side(sigs, "b"), "b")
    near = near.where((F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num)).select("a", "b", "sig_a", "sig_b")
    near = stage(near.mapInArrow(_screen(num / den - 0.25), "a long, b long"), "near-pairs")
    xs = _only(side(sets, "a"), "a", near.select("a"))
    ys = _only(side(sets, "b"), "b", near.select("b"))
    return near.join(ys, "b").join(xs, "a").select("a", "b", "set_a", "set_b").mapInArrow(_confirm(num, den), "a long, b long")


def _meet(num: int, den: int):
    """Streams members past the centres of their block; rows are sorted by (key, block,
    kind), centres (kind 0) first."""
    least = num / den - 0.25

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, centres, parent = None, {}, {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        def arrays(part: pa.RecordBatch) -> dict:
            sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint32).reshape(part.num_rows, -1)
            return {"sig": sig, "rep": part.column("rep").to_pylist(), "comp": part.column("comp").to_pylist(), "n": part.column("n").to_numpy(), "set": [np.frombuffer(x.as_buffer(), np.uint64) for x in part.column("set")]}

        def compared(x: dict, band: int) -> list[tuple[int, int]]:
            same = x["sig"][:, None] == centres["sig"][None]
            shared = same.reshape(*same.shape[:2], BANDS, ROWS).all(-1)
            ok = (same.mean(-1) >= least) & (shared.argmax(-1) == band)
            ok &= np.array(x["comp"])[:, None] != np.array(centres["comp"])[None]
            ok &= np.minimum(x["n"][:, None], centres["n"][None]) * den >= np.maximum(x["n"][:, None], centres["n"][None]) * num
            found = []
            for i, j in zip(*np.nonzero(ok), strict=True):
                ri, rj = root(x["comp"][i]), root(centres["comp"][j])
                if ri == rj:
                    continue
                a, b = x["set"][i], centres["set"][j]
                both = len(np.intersect1d(a, b, assume_unique=True))
                if den * both >= num * (len(a) + len(b) - both):
                    parent[max(ri, rj)] = min(ri, rj)
                    found.append((centres["rep"][j], x["rep"][i]))
            return found

        for batch in batches:
            key, block, kind = (batch.column(c).to_numpy() for c in ("key", "block", "kind"))
            edges = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1]) | (kind[1:] != kind[:-1])]) if len(key) else []
            found = []
            for lo, hi in zip(edges, [*edges[1:], len(key)], strict=True):
                if at != (key[lo], block[lo]):
                    at, centres, parent = (key[lo], block[lo]), {}, {}
                band = batch.column("band")[int(lo)].as_py()
                for k in range(lo, hi, 128):
                    x = arrays(batch.slice(k, min(128, hi - k)))
                    if kind[lo] == 0:
                        centres = {c: np.concatenate((centres[c], v)) if c in ("sig", "n") else centres[c] + v for c, v in x.items()} if centres else x
                    else:
                        found += compared(x, band)
            if found:
                yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    return run


def near_groups(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    sig = stage(signatures(docs, size, id_col, text_col), "signatures")
    classes = sig.where("n_shingles > 0 and doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    classes = stage(classes, "classes")
    band = F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.xxhash64(F.lit(b), F.substring("sig", 4 * ROWS * b + 1, 4 * ROWS)).alias("key")) for b in range(BANDS)]))
    entries = classes.select("rep", band.alias("e")).select("rep", "e.band", "e.key").distinct()
    shared = entries.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("key", "lo")
    entries = stage(entries.join(shared, "key"), "buckets")
    involved = stage(entries.select("rep").distinct(), "involved")
    sigs = stage(_only(classes.select("rep", "n", "sig"), "rep", involved).dropDuplicates(["rep"]), "involved-signatures")
    texts = _only(_rows(docs, id_col, text_col).withColumnRenamed("doc_id", "rep"), "rep", involved)
    sets = stage(_sets(texts.withColumnRenamed("rep", "doc_id"), size).dropDuplicates(["rep"]), "involved-sets")

    pairs = stage(entries.where("rep <> lo").select(F.col("lo").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    links = verified(pairs, sigs, sets, num, den)
    labels = components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))).df.select(F.col("u").alias("rep"), F.col("v").alias("comp"))
    rest = entries.where("rep <> lo").select("key", "band", "rep")
    for turn in count():
        named = rest.join(labels, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
        parts = named.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("in_comp"))
        mixed = parts.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.sum("in_comp").alias("members")).where("lo < hi").select("key", "members", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
        open_ = stage(named.join(mixed, "key").join(parts, ["key", "comp"]), "open-buckets")
        if open_.limit(1).count() == 0:
            break
        order = W.partitionBy("key").orderBy("in_comp", "comp", "rep")
        chosen = stage(open_.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= CENTRES << turn), "centres")
        chunks = F.least(F.lit(1 << turn), F.ceil(F.col("members") / CENTRES)).cast("int")
        data = _only(sigs.join(sets, "rep"), "rep", open_.select("rep"))
        cell = F.col("chunk") * F.col("blocks") + F.col("block")  # each chunk of centres meets each block of members
        rows = open_.select("key", "band", "rep", "comp", "blocks", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"), F.lit(1).alias("kind"))
        past = chosen.select("key", "band", "rep", "comp", "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.floor((F.col("nth") - 1) / CENTRES).cast("int").alias("chunk"), F.lit(0).alias("kind"))
        rows = rows.unionByName(past).withColumn("block", cell).drop("chunk", "blocks")
        rows = rows.join(data, "rep").repartition("key", "block").sortWithinPartitions("key", "block", "kind", "rep")
        links = stage(rows.select("key", "block", "kind", "band", "rep", "comp", "n", "sig", "set").mapInArrow(_meet(num, den), "a long, b long"), "links")
        if links.limit(1).count():
            ends = links.join(labels.select(F.col("rep").alias("a"), F.col("comp").alias("ca")), "a", "left").join(labels.select(F.col("rep").alias("b"), F.col("comp").alias("cb")), "b", "left")
            merged = components(ends.select(F.coalesce("ca", "a").alias("u"), F.coalesce("cb", "b").alias("v"))).df
            moved = labels.join(merged.select(F.col("u").alias("comp"), F.col("v").alias("to")), "comp", "left").select("rep", F.coalesce("to", "comp").alias("comp"))
            new = merged.select(F.col("u").alias("rep"), F.col("v").alias("comp")).join(labels, "rep", "left_anti")
            labels = stage(moved.unionByName(new), "labels")
        rest = stage(open_.join(chosen.select("key", "rep"), ["key", "rep"], "left_anti").select("key", "band", "rep"), "rest")
    named = classes.join(labels, "rep", "left").select("cls", F.coalesce("comp", "rep").alias("comp"))
    out = sig.select("doc_id", "n_shingles", "cls").join(named, "cls", "left")
    single = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    component = F.when(single, F.col("doc_id")).otherwise(F.col("comp"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_copies(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group stays, with all its columns."""
    (own,) = fresh(docs, "kept_id")
    kept = near_groups(docs, size, num, den, id_col, text_col).where("kept").select(F.col("doc_id").alias(own)).distinct()
    return docs.join(kept, col(docs, id_col).cast("long").eqNullSafe(F.col(own)), "left_semi")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), size=3, num=85, den=100)
