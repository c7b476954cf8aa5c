"""Catalogue of pairs: newest processing, ledgers, overlap search, missing pairs, jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def newest(df: DataFrame, keys: list[str], order: list[str], only: Column | None = None) -> DataFrame:
    """Rows with the newest processing of their key; exact ties stay.  Rows outside ``only``
    (radar pairs) all stay."""
    rank = F.rank().over(W.partitionBy(*keys).orderBy(*[F.desc(c) for c in order]))
    keep = rank == 1 if only is None else (rank == 1) | ~only
    return df.withColumn("__keep", keep).where("__keep").drop("__keep")


def unprocessed(found: DataFrame, cube: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Found rows that are neither in the cube nor in any list of the ledger."""
    return found.join(cube.select(key), key, "left_anti").join(ledger.select(key).distinct(), key, "left_anti")


def superseded(cube: DataFrame, found: DataFrame, skipped: DataFrame, key: str) -> DataFrame:
    """Cube layers that are no longer found and were replaced by a duplicate."""
    return cube.join(found.select(key), key, "left_anti").join(skipped.select(key).distinct(), key, "left_semi")


def merged_ledger(*ledgers: DataFrame) -> DataFrame:
    out = ledgers[0]
    for x in ledgers[1:]:
        out = out.unionByName(x, allowMissingColumns=True)
    return out.distinct()


def reasons(ledger: DataFrame, reason: str = "reason") -> DataFrame:
    """Count and percentage per reason."""
    n = ledger.groupBy(reason).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("percent", 100 * F.col("n") / F.sum("n").over(W.partitionBy()))


def overlap_join(left: DataFrame, right: DataFrame, cell: float, on: list[str] | None = None) -> DataFrame:
    """Pairs of boxes (x0, y0, x1, y1) that intersect.

    Both sides are spread over square cells and equi-joined on the cell; a pair that shares
    several cells is reported in the one that holds the corner of its intersection.
    """
    on = on or []

    def spread(df: DataFrame, s: str) -> DataFrame:
        ren = df.select(*on, *[F.col(c).alias(f"{c}{s}") for c in df.columns if c not in on])
        span = lambda a, b: F.sequence(F.floor(F.col(a + s) / cell), F.floor(F.col(b + s) / cell))
        return ren.withColumn("cx", F.explode(span("x0", "x1"))).withColumn("cy", F.explode(span("y0", "y1")))

    j = spread(left, "_a").join(spread(right, "_b"), [*on, "cx", "cy"])
    hit = (F.col("x0_a") <= F.col("x1_b")) & (F.col("x0_b") <= F.col("x1_a")) & (F.col("y0_a") <= F.col("y1_b")) & (F.col("y0_b") <= F.col("y1_a"))
    corner = (F.floor(F.greatest("x0_a", "x0_b") / cell) == F.col("cx")) & (F.floor(F.greatest("y0_a", "y0_b") / cell) == F.col("cy"))
    return j.where(hit & corner).drop("cx", "cy")


CHUNK = 256  # scenes; where pairs are not spread, all pairs of a pair of chunks are buffered
SLICE = 512  # scenes; where they are, one scene's pairs with a slice are
UNITS = 32  # units of pairs for each task, or more:
BLOCK = (256, 65536)  # scenes of a block, about


def interval_pairs(scenes: DataFrame, key: str, day: str, scene: str, least: int, most: int, itself: bool = False, spread: bool = True) -> DataFrame:
    """Ordered pairs of scenes of one key whose gap in days lies in [least, most] (least >= 0);
    a scene that repeats pairs with ``itself`` or not.

    The time axis is cut into slots of ``most`` days; scenes meet those of their own and the
    next slot, in parallel however few the keys are (``spread``; not needed where keys are
    many and small).
    """
    rows = scenes.select(F.col(key).alias("key"), F.col(scene).alias("scene"), F.col(day).alias("day")).where("key is not null and scene is not null and day is not null")
    pairs = (_spread_pairs if spread else _chunk_pairs)(rows, least, most)
    if not itself:
        pairs = pairs.where("scene1 != scene2")
    return pairs.select(F.col("key").alias(key), "scene1", "scene2", "day1", "day2", (F.col("day2") - F.col("day1")).alias("gap"))


def _spread_pairs(rows: DataFrame, least: int, most: int) -> DataFrame:
    """Pairs from units, which are pairs of blocks of a key's scenes in a slot.

    A block is large where pairs are many, so that there are about ``UNITS`` units a task: each
    scene is shuffled once for each block that its own meets, and no pair is.  A block holds
    the scenes of each day in sorted slices.  The three steps down to one scene and a slice go
    through higher-order functions, which are not compiled into the stage of the next step:
    they hand over one row at a time, where generated code would hold all pairs of a unit.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a number, or units are few and merged again
    rows = rows.withColumn("slot", F.floor(F.col("day") / max(1, most)))
    counts = rows.groupBy("key", "slot").agg(F.count(F.lit(1)).alias("n"))
    block = counts.agg(F.least(F.greatest(F.sqrt(F.sum(F.col("n").cast("double") * F.col("n")) / (UNITS * tasks)), F.lit(float(BLOCK[0]))), F.lit(float(BLOCK[1]))).alias("most"))
    large = counts.groupBy("key").agg(F.max("n").alias("n"), F.max("slot").alias("last")).crossJoin(F.broadcast(block)).where("n > most").select("key", "last", F.ceil(F.col("n") / F.col("most")).alias("blocks"))
    rows = rows.join(F.broadcast(large), "key", "left").withColumns({"blocks": F.coalesce("blocks", F.lit(1)), "last": F.coalesce("last", F.col("slot") + 1)})
    rows = rows.withColumn("block", F.pmod(F.xxhash64("scene"), "blocks")).repartition("key", "slot", "block")
    days = rows.groupBy("key", "slot", "block", "blocks", "last", "day").agg(F.sort_array(F.collect_list("scene")).alias("s"))
    slices = F.transform(F.sequence(F.lit(1), F.size("s"), F.lit(SLICE)), lambda i: F.struct("day", F.slice("s", i, SLICE).alias("s")))
    blocks = days.groupBy("key", "slot", "block", "blocks", "last").agg(F.flatten(F.collect_list(slices)).alias("s"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    slots = F.explode(F.sequence("slot", F.least(F.col("slot") + 1, "last")))
    unit = ["key", "slot", "block1", "block2"]
    a = blocks.select("key", "blocks", slots.alias("slot"), F.col("block").alias("block1"), F.col("s").alias("a")).select("key", "slot", "block1", every.alias("block2"), "a")
    b = blocks.select("key", "slot", every.alias("block1"), F.col("block").alias("block2"), F.col("s").alias("b"))
    met = a.repartition(tasks, *unit).join(b.repartition(tasks, *unit).hint("merge"), unit).select("key", "a", "b")
    gap = lambda x, y: (y["day"] - x["day"]).between(least, most)
    one = met.select("key", "b", F.explode(F.filter("a", lambda x: F.exists("b", lambda y: gap(x, y)))).alias("a"))
    two = one.select("key", "a", F.explode(F.filter("b", lambda y: gap(F.col("a"), y))).alias("b"))
    two = two.select("key", F.col("a.day").alias("day1"), F.col("b.day").alias("day2"), F.col("a.s").alias("a"), F.col("b.s").alias("b"))
    three = two.select("key", "day1", "day2", F.explode(F.filter("a", lambda x: x.isNotNull())).alias("scene1"), "b")
    return three.select("key", "day1", "day2", "scene1", F.explode("b").alias("scene2"))


def _chunk_pairs(rows: DataFrame, least: int, most: int) -> DataFrame:
    """Pairs from chunks of about ``CHUNK`` scenes of a key and step of the time axis, which
    meet by key and slot where their steps can hold a gap in the range."""
    step = max(1, most // 128)
    apart = max(1, (most + step - 1) // step)  # steps
    rows = rows.select("key", F.struct("scene", "day").alias("s"), F.floor(F.col("day") / step).alias("step"))
    large = rows.groupBy("key", "step").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CHUNK)
    chunk = F.coalesce(F.pmod(F.xxhash64("s.scene"), F.ceil(F.col("n") / CHUNK)), F.lit(0))
    rows = rows.join(F.broadcast(large), ["key", "step"], "left").withColumn("chunk", chunk)
    chunks = rows.groupBy("key", "step", "chunk").agg(F.collect_list("s").alias("s"))
    slot = F.floor(F.col("step") / apart)
    a = chunks.select("key", F.col("step").alias("step1"), F.col("s").alias("a"), F.explode(F.array(slot, slot + 1)).alias("slot"))
    b = chunks.select("key", F.col("step").alias("step2"), F.col("s").alias("b"), slot.alias("slot"))
    met = a.join(b, ["key", "slot"]).where((F.col("step2") - F.col("step1")).between(least // step, apart)).select("key", "a", "b")
    pairs = met.select("key", F.explode("a").alias("a"), "b").select("key", "a", F.explode("b").alias("b"))
    pairs = pairs.select("key", F.col("a.scene").alias("scene1"), F.col("b.scene").alias("scene2"), F.col("a.day").alias("day1"), F.col("b.day").alias("day2"))
    return pairs.where((F.col("day2") - F.col("day1")).between(least, most))


def missing(pairs: DataFrame, existing: DataFrame, on: list[str]) -> DataFrame:
    return pairs.join(existing.select(*on).distinct(), on, "left_anti")


def first_per_year(df: DataFrame, year: Column, order: str, most: int) -> DataFrame:
    w = W.partitionBy("year").orderBy(order)
    return df.withColumn("year", year).withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= most)


def exactly_one(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Lookup in a dimension that must hold each key once."""
    n = dim.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in dim.columns if c != key])
    bad = F.raise_error(F.concat(F.lit("no single row for "), F.col(key).cast("string"))).cast("boolean")
    return df.join(n, key, "left").where(F.when(F.col("__n") == 1, True).otherwise(bad)).drop("__n")


def incomplete(wanted: DataFrame, *present: DataFrame, key: str) -> DataFrame:
    """Keys for which not all artefacts are present."""
    parts = [wanted.join(p.select(key), key, "left_anti").select(key) for p in present]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()
