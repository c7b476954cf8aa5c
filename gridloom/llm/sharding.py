"""Sharding by proportional stratified interleaving, in DataFrame functions only.

Rows of each source are shuffled by a seeded hash and ranked; row ``r`` of a source with
``n`` rows gets the fractional rank ``(r - 1/2) / n``; all rows are sorted by fractional
rank and cut into equal runs, so every shard holds each source in the corpus proportion.

No source is ever sorted in one task: a hash of ``sqrt(N)`` buckets splits every source,
ranks inside a bucket are local, and bucket offsets come from a table of counts.  The
global order is ranked in the same two levels over buckets of the fractional rank.

Defined cases: null source is a source of its own, null text has size 0 + 8 and crc 0,
empty tables give empty tables, rows alike in all used columns are interchangeable.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import col, stage, table, unit


def interleave(docs: DataFrame, shards: int = 24, seed: int = 20240607, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id, source, size, crc, shard, slot (law: row counts)."""
    text = F.coalesce(col(docs, text_col).cast("string"), F.lit(""))
    base = docs.select(
        col(docs, id_col).alias("id"),
        col(docs, source_col).isNull().alias("no_source"),
        F.coalesce(col(docs, source_col).cast("string"), F.lit("")).alias("source"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
    ).withColumn("key", F.xxhash64(F.lit(seed), "id", "crc", "size"))
    base = stage(base, "shard-rows")
    total = base.count()
    cells = max(1, math.isqrt(total))
    stratum = ["no_source", "source"]
    keyed = base.withColumn("cell", F.floor(unit(F.col("key")) * cells))
    counts = keyed.groupBy(*stratum, "cell").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy(*stratum).orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(*stratum, "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"), F.sum("n").over(W.partitionBy(*stratum)).alias("n_source"))
    local = F.row_number().over(W.partitionBy(*stratum, "cell").orderBy("key", "id", "crc", "size"))
    ranked = keyed.withColumn("r", local).join(counts, [*stratum, "cell"])
    ranked = ranked.withColumn("frac", (F.col("ahead") + F.col("r") - 0.5) / F.col("n_source")).select("id", *stratum, "size", "crc", "key", "frac", F.least(F.floor(F.col("frac") * cells), F.lit(cells - 1)).alias("run"))
    ranked = stage(ranked, "shard-ranks")
    runs = ranked.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    runs = runs.select("run", F.coalesce(F.sum("n").over(W.orderBy("run").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    at = F.row_number().over(W.partitionBy("run").orderBy("frac", *stratum, "key", "id", "crc", "size"))
    placed = ranked.withColumn("r", at).join(runs, "run").withColumn("pos", F.col("ahead") + F.col("r") - 1)
    n = max(1, total)
    placed = placed.withColumn("shard", F.expr(f"(pos * {shards}L) div {n}L"))
    return placed.select(
        "id",
        F.when(~F.col("no_source"), F.col("source")).alias("source"),
        "size",
        "crc",
        F.col("shard").cast("int").alias("shard"),
        F.expr(f"pos - ((shard * {n}L + {shards - 1}L) div {shards}L)").alias("slot"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = interleave(table(spark, sf_dir, "documents"), shards=24)
    return out.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
