"""Exact dedup by a tree-merge of sorted digest runs.

Every input partition forms one run: its distinct text digests in order, each with the
identifier to retain, a row count and two independent witnesses (byte length and a second
hash).  Runs are merged ``fan_in`` at a time in rounds: run ``r`` is handed, as a whole, to
the partition of run ``r // fan_in``, which sorts the runs it got into one and aggregates
them in that order.  Each merge keeps one row per digest, retains the smallest (or largest)
identifier and verifies that the witnesses agree, else it raises.  So that no partition
ends up with all digests, a run is cut by a checksum of the digest into lanes of about
``lane_rows`` rows of the input, and every lane has a tree of its own.  A digest has one row
per run at most, so a text that fills a third of the table is no hot key.  Only DataFrame
functions.

Defined cases: a null text counts as empty; empty texts are equal to each other; a null
identifier never wins over a number (a group of only null identifiers keeps a null one);
of rows that repeat both identifier and text exactly one is kept; an empty table gives an
empty table; extra columns are ignored by ``dedup_groups`` and carried by ``drop_copies``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Staged, col, fresh, join_groups, stage, table


def _merged(runs: DataFrame, keep: str) -> DataFrame:
    """One row per lane, run and digest.  What is retained is a struct, which only a
    sort-based aggregate can hold: the merge reads its input in order."""
    pick = F.max if keep == "max" else F.min
    same = (F.min("len_lo") == F.max("len_hi")) & (F.min("h_lo") == F.max("h_hi"))
    return (
        runs.repartition("lane", "run")
        .groupBy("lane", "run", "digest")
        .agg(
            pick("keep").alias("keep"),
            F.sum("n").alias("n"),
            F.min("len_lo").alias("len_lo"),
            F.max("len_hi").alias("len_hi"),
            F.min("h_lo").alias("h_lo"),
            F.max("h_hi").alias("h_hi"),
            same.alias("same"),
        )
        .withColumn("n", F.when(F.col("same"), F.col("n")).otherwise(F.raise_error(F.lit("two texts share a digest")).cast("long")))
        .drop("same")
    )


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(col(docs, text_col).cast("string"), F.lit(""))
    return docs.select(
        col(docs, id_col).alias("id"),
        F.sha2(text.cast("binary"), 256).alias("digest"),
        F.octet_length(text).cast("long").alias("len"),
        F.xxhash64(text).alias("h"),
        F.spark_partition_id().cast("long").alias("run"),
        F.monotonically_increasing_id().alias("row"),
    )


def winners(base: DataFrame, keep: str = "min", fan_in: int = 8, lane_rows: int = 16_384) -> DataFrame:
    """(digest, keep_id, keep_row, n) after all rounds of merging; ``base`` as from ``digests``."""
    last, rows = base.agg(F.coalesce(F.max("run"), F.lit(0)), F.count(F.lit(1))).first()
    lanes = max(1, -(-rows // lane_rows))
    known = F.col("id").isNotNull() if keep == "max" else F.col("id").isNull()
    runs = base.select(
        F.pmod(F.crc32("digest"), F.lit(lanes)).alias("lane"),
        "run",
        "digest",
        F.struct(known.alias("known"), "id", "row").alias("keep"),
        F.lit(1).cast("long").alias("n"),
        F.col("len").alias("len_lo"),
        F.col("len").alias("len_hi"),
        F.col("h").alias("h_lo"),
        F.col("h").alias("h_hi"),
    )
    merged = _merged(runs, keep)
    while last > 0:
        last //= fan_in
        merged = _merged(merged.withColumn("run", F.floor(F.col("run") / fan_in)), keep)
    return merged.select("digest", F.col("keep.id").alias("keep_id"), F.col("keep.row").alias("keep_row"), "n")


def dedup_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", fan_in: int = 8) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    base = stage(digests(docs, id_col, text_col), "digests")
    groups = stage(winners(base, keep, fan_in).where("n > 1"), "digest-groups")  # a text of one row keeps that row
    joined = join_groups(base.select("id", "digest", "row"), groups, "digest", "n", base.count(), "left")
    return joined.select(
        F.col("id").alias(id_col),
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", fan_in: int = 8) -> DataFrame:
    """The rows that stay, with all their columns.

    Texts travel keyed by (identifier, digest), never by digest alone, so a text that fills
    a third of the table does not meet in one task.
    """
    base = Staged(digests(docs, id_col, text_col), "digests")
    d, k, g = fresh(docs, "digest", "keep_key", "keep_digest")
    top = stage(winners(base.df, keep, fan_in).select(F.col("digest").alias(g), F.col("keep_id").alias(k)), "digest-winners")
    base.drop()
    text = F.coalesce(col(docs, text_col).cast("string"), F.lit(""))
    left = docs.withColumn(d, F.sha2(text.cast("binary"), 256))
    stays = left.join(top, (F.col(d) == F.col(g)) & col(docs, id_col).eqNullSafe(F.col(k)), "left_semi")
    return stays.dropDuplicates([id_col, d]).drop(d)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return dedup_groups(docs, keep="max").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM d
"""
