"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

DataFrame functions only.  Three steps:

1. Targets: each source's share of all words by weight, never above ``cap`` times its size;
   the excess goes to the others by weight.  That fixed point is ``min(cap*size, weight*L)``
   with one level ``L``, found from sums over the sources in order of ``cap*size/weight``.
2. Draws: documents of a source are permuted by a seeded hash.  The quota takes
   ``floor(quota/size)`` whole passes and then goes down the permutation, passing over
   documents that overrun what is left, until none fits.  One more document may overshoot
   the quota if that comes nearer to it, so no document left out would bring it nearer.
3. Tree: every source's line of draws is cut into blocks of equal length.  Their numbers
   are exact quotas of ``2**levels * blocks_per_shard`` blocks by the sources' targets: one
   for each source, the rest by largest remainders.  A node of the tree holds a set of blocks
   and sends a uniformly random half of it left (which draws the vector of per-source counts
   from the multivariate hypergeometric law); ``levels`` levels give as many shards, of about
   ``shard_words`` words each (``2**most_levels`` shards at most, so the table of blocks stays
   bounded).  A block is a run of the source's permuted draws; the rows that a shard's blocks
   hold are its draws, shuffled by a local hash, and what a document gives is counted there.

Cumulated sizes inside a source use ``sqrt(N)`` hash cells per source, so a hot source is
spread over tasks.  Defined cases: null source is a source (last in order), null or empty
texts have size 0 and are never drawn, empty tables give empty tables, repeated rows are
separate rows, each drawn for itself (which of them does not matter).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, col, fresh, small_join, stage, table, unit

STRATUM = ["no_source", "source"]


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """(no_source, source, source_size) -> with weight and target added."""
    order = W.orderBy(*STRATUM)
    every = W.partitionBy()
    s = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("ceiling", F.col("source_size") * F.lit(cap)).withColumn("ratio", F.col("ceiling") / F.col("weight"))
    before = W.orderBy("ratio", *STRATUM).rowsBetween(W.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("level", level).withColumn("level", F.max("level").over(every))
    return s.select(*STRATUM, "source_size", "n_rows", "weight", F.least("ceiling", F.col("weight") * F.col("level")).alias("target"))


def plan(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = 3.0, seed: int = 7919, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """One row per document: row, id, stratum, size, source_size, target, copies, key, place of
    its first copy on the line of draws and length of that line.  A column named by ``row_col``
    gives each row a number of its own, else one is made."""
    text = F.coalesce(col(docs, text_col).cast("string"), F.lit(""))
    base = docs.select(
        (col(docs, row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
        col(docs, id_col).alias("id"),
        col(docs, source_col).isNull().alias("no_source"),
        F.coalesce(col(docs, source_col).cast("string"), F.lit("")).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(text).alias("h"),
    ).withColumn("key", F.xxhash64(F.lit(seed), "id", "h"))
    base = stage(base, "mix-rows")
    cells = max(1, math.isqrt(base.count()))
    keyed = base.withColumn("cell", F.floor(unit(F.col("key")) * cells))
    sums = keyed.groupBy(*STRATUM, "cell").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
    sums = stage(sums, "mix-cells")
    goal = targets(sums.groupBy(*STRATUM).agg(F.sum("words").alias("source_size"), F.sum("rows").alias("n_rows")), weights, cap)
    goal = goal.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    goal = stage(goal.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")), "mix-targets")
    before = W.partitionBy(*STRATUM).orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    ahead = sums.select(*STRATUM, "cell", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("words_ahead"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_ahead"))
    inside = W.partitionBy(*STRATUM, "cell").orderBy("key", "id", "h", "size", "row")
    line = keyed.withColumn("end", F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0))).withColumn("pos", F.row_number().over(inside))
    line = small_join(line.join(ahead, [*STRATUM, "cell"]), goal, STRATUM)
    line = line.select("row", "id", *STRATUM, "cell", "size", "key", "source_size", "target", "passes", "rest", (F.col("words_ahead") + F.col("end")).alias("end"), (F.col("rows_ahead") + F.col("pos")).alias("pos"))
    line = stage(line, "mix-line")
    inner = F.col("end") <= F.col("rest")
    got = line.groupBy(*STRATUM).agg(F.coalesce(F.max(F.when(inner, F.col("end"))), F.lit(0)).alias("got"))
    gaps = goal.join(got, STRATUM).select(*STRATUM, (F.col("rest") - F.col("got")).alias("gap"), F.lit(0).cast("long").alias("last"), F.array().cast("array<struct<lo:long,hi:long,most:double>>").alias("steps"))
    gaps = stage(gaps, "mix-gaps")
    places = W.partitionBy(*STRATUM, "cell").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    while True:  # each step takes, in order, what fits up to the next document that overruns
        fits = small_join(line, gaps, STRATUM).where(~inner & (F.col("size") > 0) & (F.col("size") <= F.col("gap")) & (F.col("pos") > F.col("last"))).select(*STRATUM, "cell", "pos", "size", "gap")
        parts = fits.groupBy(*STRATUM, "cell", "gap").agg(F.sum("size").alias("words"))
        parts = parts.select(*STRATUM, "cell", "gap", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("reach")).where("reach < gap").drop("gap")
        reach = F.col("reach") + F.sum("size").over(places)
        step = fits.join(parts, [*STRATUM, "cell"]).withColumn("reach", reach).where("reach <= gap").groupBy(*STRATUM).agg(F.max("reach").alias("words"), F.max("pos").alias("hi"))
        step = stage(step, "mix-step")
        if step.isEmpty():
            break
        gaps = gaps.join(step, STRATUM, "left").select(
            *STRATUM,
            (F.col("gap") - F.coalesce("words", F.lit(0))).alias("gap"),
            F.coalesce("hi", "last").alias("last"),
            F.when(F.col("hi").isNull(), F.col("steps")).otherwise(F.concat("steps", F.array(F.struct(F.col("last").alias("lo"), F.col("hi").cast("long").alias("hi"), F.col("gap").cast("double").alias("most"))))).alias("steps"),
        )
        gaps = stage(gaps, "mix-gaps")
    walked = F.exists("steps", lambda x: (F.col("pos") > x["lo"]) & (F.col("pos") <= x["hi"]) & (F.col("size") <= x["most"]))
    taken = inner | ((F.col("size") > 0) & walked)
    off = F.abs(F.col("gap") - F.col("size"))
    best = small_join(line, gaps, STRATUM).where(~taken & (off < F.col("gap"))).groupBy(*STRATUM).agg(F.min(F.struct(off.alias("off"), "pos")).alias("best"))
    gaps = stage(gaps.join(best, STRATUM, "left").select(*STRATUM, "steps", F.coalesce("best.pos", F.lit(-1)).alias("closing")), "mix-gaps")
    out = small_join(line, gaps, STRATUM)
    extra = taken | (F.col("pos") == F.col("closing"))
    copies = F.when(F.col("size") > 0, F.col("passes") + extra.cast("long")).otherwise(F.lit(0).cast("long"))
    out = stage(out.select("row", "id", *STRATUM, "cell", "pos", "size", "key", "source_size", "target", copies.alias("copies")), "mix-copies")
    # the line of draws: each document's copies one behind the other, in the order of the permutation
    drawn = F.col("copies") * F.col("size")
    cells_of = out.groupBy(*STRATUM, "cell").agg(F.sum(drawn).alias("words"))
    cells_of = cells_of.select(*STRATUM, "cell", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("ahead"), F.sum("words").over(W.partitionBy(*STRATUM)).alias("line"))
    behind = W.partitionBy(*STRATUM, "cell").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    out = out.withColumn("inside", F.coalesce(F.sum(drawn).over(behind), F.lit(0))).join(cells_of, [*STRATUM, "cell"])
    return out.select("row", "id", *STRATUM, "size", "key", "source_size", "target", "copies", (F.col("ahead") + F.col("inside")).alias("start"), "line")


def split_tree(blocks: DataFrame, levels: int, seed: int) -> DataFrame:
    """(no_source, source, block) -> with shard: halves of random order, level by level."""
    out = blocks.withColumn("node", F.lit(0).cast("long"))
    for k in range(levels):
        key = F.xxhash64(F.lit(seed), F.lit(k), *STRATUM, "block")
        out = out.withColumn("rank", F.row_number().over(W.partitionBy("node").orderBy(key, *STRATUM, "block")))
        out = out.withColumn("node", F.col("node") * 2 + (F.col("rank") * 2 > F.count(F.lit(1)).over(W.partitionBy("node"))).cast("long"))
    return out.select(*STRATUM, "block", F.col("node").cast("int").alias("shard"))


def quotas(goal: DataFrame, blocks: int) -> DataFrame:
    """(no_source, source, target) -> with quota: ``blocks`` in all, one for each source that
    is drawn from at least, the rest by largest remainders (``blocks`` or more sources: one each)."""
    every = W.partitionBy()
    g = goal.where("target > 0").withColumn("spare", F.greatest(F.lit(0), F.lit(blocks) - F.count(F.lit(1)).over(every)))
    g = g.withColumn("part", F.col("spare") * F.col("target") / F.sum("target").over(every)).withColumn("whole", F.floor("part"))
    g = g.withColumn("rank", F.row_number().over(W.orderBy(F.desc(F.col("part") - F.col("whole")), *STRATUM)))
    more = (F.col("rank") <= F.col("spare") - F.sum("whole").over(every)).cast("long")
    return g.select(*STRATUM, "target", (1 + F.col("whole") + more).cast("long").alias("quota"))


def draws(planned: DataFrame, shard_words: int = 16_000_000, blocks_per_shard: int = 64, most_levels: int = 12, seed: int = 104729) -> DataFrame:
    """One row per drawn copy, with its shard and the key that orders rows inside the shard.
    ``planned`` is read more than once and should be staged."""
    goal = stage(planned.groupBy(*STRATUM).agg(F.max("target").alias("target"), F.max("line").alias("line")), "mix-goal")
    words = goal.agg(F.sum("line")).first()[0] or 0
    levels = min(most_levels, max(0, math.ceil(math.log2(max(1, words / shard_words)))))
    quota = stage(quotas(goal.where("line > 0").select(*STRATUM, "target"), blocks_per_shard << levels), "mix-quota")
    tree = stage(split_tree(quota.select(*STRATUM, F.explode(F.sequence(F.lit(0).cast("long"), F.col("quota") - 1)).alias("block")), levels, seed), "mix-tree")
    drawn = small_join(planned.where("copies > 0"), quota.drop("target"), STRATUM).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    drawn = drawn.withColumn("block", F.expr("least(quota - 1, (cast(start as decimal(25,0)) + copy * size) * quota div line)").cast("long"))
    drawn = small_join(drawn, tree, [*STRATUM, "block"])
    return drawn.withColumn("order_key", F.xxhash64(F.lit(seed + 1), "shard", "key", "copy"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = 3.0, seed: int = 7919, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixture itself: every drawn copy as a row with the columns of ``docs``.

    Rows come grouped by shard and shuffled inside it.  The table is staged with a number for
    each row, by which texts meet their draws; a hot source stays spread over tasks.
    """
    row, again, s, o = fresh(docs, "mix_row", "mix_again", "mix_shard", "mix_order")
    held = stage(docs.withColumn(row, F.monotonically_increasing_id()), "mix-docs")
    planned = stage(plan(held, weights, cap, seed, id_col=id_col, text_col=text_col, source_col=source_col, row_col=row), "mix-plan")
    got = draws(planned).select(F.col("row").alias(again), F.col("shard").alias(s), F.col("order_key").alias(o))
    joined = held.join(got, F.col(row) == F.col(again))
    return joined.sortWithinPartitions(s, o).select(*[col(docs, x) for x in docs.columns])


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = stage(plan(table(spark, sf_dir, "documents")), "mix-plan")
    leaves = draws(planned).groupBy("row").agg(F.sum("size").alias("words"), F.sort_array(F.collect_list("shard")).alias("shards"))
    out = planned.join(leaves, "row", "left")
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", F.coalesce("words", F.lit(0).cast("long")).alias("taken"), F.coalesce("shards", F.array().cast("array<int>")).alias("shards"))
