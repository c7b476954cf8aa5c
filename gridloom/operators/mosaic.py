"""Placing tiles on a regional grid and merging overlapping sources.

Cells are rows, so placement and merge are group-bys with a ``max_by`` over an ordering:
map-side combinable, whatever the number of tiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def place(tiles: DataFrame, keys: list[str], values: list[str], order: str) -> DataFrame:
    """The tile that comes last in ``order`` owns a cell."""
    best = F.max_by(F.struct(*values), F.col(order)).alias("best")
    return tiles.groupBy(*keys).agg(best).select(*keys, "best.*")


def merge_sources(sources: DataFrame, keys: list[str], values: list[str], count: str, order: str) -> DataFrame:
    """Per cell the source with the largest count, the later one on ties; where every count
    is missing, the first source."""
    rank = F.struct(F.coalesce(F.col(count), F.lit(-1)).alias("n"), F.when(F.col(count).isNull(), -F.col(order)).otherwise(F.col(order)).alias("o"))
    best = F.max_by(F.struct(*values, count, F.col(order).alias("source")), rank).alias("best")
    return sources.groupBy(*keys).agg(best, F.count(F.lit(1)).alias("n_sources")).select(*keys, "best.*", "n_sources")


def merge_annual(annual: DataFrame, static: DataFrame, keys: list[str], values: list[str], count: str, order: str) -> DataFrame:
    """Annual layers merged by the static count of their source."""
    ranked = annual.join(static.select(*keys, order, count), [*keys, order], "left")
    return merge_sources(ranked, [*keys, "year"], values, count, order)


def index_lookup(target: DataFrame, source: DataFrame, ij: list[str]) -> DataFrame:
    """Output cells take the source cell that their index points at."""
    return target.join(source, ij, "left")


def rotate(df: DataFrame, vx: str = "vx", vy: str = "vy", v: str = "v", error: str = "err") -> DataFrame:
    """A 2x2 matrix per cell (m11..m22) applied to the vector; the error scales with the
    speed and is 0 where the old speed is 0."""
    x = F.col("m11") * F.col(vx) + F.col("m12") * F.col(vy)
    y = F.col("m21") * F.col(vx) + F.col("m22") * F.col(vy)
    old = F.hypot(vx, vy)
    err = F.when(old == 0, 0.0).otherwise(F.col(error) * F.hypot(x, y) / F.nullif(old, F.lit(0.0)))
    return df.withColumns({"vx_r": x, "vy_r": y, "v_r": F.hypot(x, y), "err_r": err, "ex_r": F.abs("m11") * F.col(error) + F.abs("m12") * F.col(error), "ey_r": F.abs("m21") * F.col(error) + F.abs("m22") * F.col(error)})


def cell_union_edges(cells: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Outline of a set of unit cells: the sides that belong to one cell only."""
    sides = [(0, 0, 1, 0), (1, 0, 1, 1), (0, 1, 1, 1), (0, 0, 0, 1)]
    side = F.explode(F.array(*[F.struct(*[(F.col(c) + d).alias(n) for c, d, n in zip((x, y, x, y), s, ("ax", "ay", "zx", "zy"), strict=True)]) for s in sides])).alias("s")
    return cells.select(x, y).distinct().select(side).groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("s.*")
