"""Placement, merge and reprojection of cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grids
from ..operators import mosaic as ops
from ..sources.views import CELLS, cells, table
from .registry import query


@query(f"WITH {CELLS} SELECT x, y, v, size FROM (SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY tile DESC) AS r FROM cells WHERE source = 1) WHERE r = 1")
def tile_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-10, SET-01, SRT-04: the later tile owns a cell, its missing values included."""
    return ops.place(cells(spark, sf_dir).where("source = 1"), ["x", "y"], ["v", "size"], "tile")


@query(f"WITH {CELLS} SELECT x, y, v, CASE WHEN v IS NOT NULL THEN size * 0.8 END AS vx FROM (SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY tile DESC) AS r FROM cells WHERE source = 2) WHERE r = 1")
def annual_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-11: components are masked where the magnitude is missing."""
    p = ops.place(cells(spark, sf_dir).where("source = 2"), ["x", "y"], ["v", "size"], "tile")
    return p.select("x", "y", "v", F.when(F.col("v").isNotNull(), F.col("size") * 0.8).alias("vx"))


ONE = f"WITH {CELLS}, one AS (SELECT x, y, source, v, size, count0 FROM (SELECT *, row_number() OVER (PARTITION BY x, y, source ORDER BY tile DESC) AS r FROM cells) WHERE r = 1)"


def _one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.place(cells(spark, sf_dir), ["x", "y", "source"], ["v", "size", "count0"], "tile")


@query(ONE + ", m AS (SELECT *, count(*) OVER (PARTITION BY x, y) AS n_sources, row_number() OVER (PARTITION BY x, y ORDER BY coalesce(count0, -1) DESC, CASE WHEN count0 IS NULL THEN -source ELSE source END DESC) AS r FROM one) SELECT x, y, v, size, count0, source, n_sources FROM m WHERE r = 1")
def merge_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-12, AGG-20, SET-02, SET-06: the source with the largest count, later on ties."""
    return ops.merge_sources(_one(spark, sf_dir), ["x", "y"], ["v", "size"], "count0", "source")


@query(ONE + ", a AS (SELECT x, y, source, v + yr AS w, 2000 + yr AS year, count0 FROM one, (VALUES (0), (1)) t(yr) WHERE (source + yr) % 3 <> 2), m AS (SELECT *, count(*) OVER (PARTITION BY x, y, year) AS n_sources, row_number() OVER (PARTITION BY x, y, year ORDER BY coalesce(count0, -1) DESC, CASE WHEN count0 IS NULL THEN -source ELSE source END DESC) AS r FROM a) SELECT x, y, year, w, count0, source, n_sources FROM m WHERE r = 1")
def merge_annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-13: annual layers by the static count of their source."""
    static = _one(spark, sf_dir)
    yr = F.explode(F.array(F.lit(0), F.lit(1))).alias("yr")
    annual = static.select("x", "y", "source", "v", yr).where("(source + yr) % 3 <> 2").select("x", "y", "source", (F.col("v") + F.col("yr")).alias("w"), (2000 + F.col("yr")).alias("year"))
    return ops.merge_annual(annual, static, ["x", "y"], ["w"], "count0", "source")


@query(ONE + ", s AS (SELECT x AS i, y AS j, v, size FROM one WHERE source = 1), t AS (SELECT x * 2 + dx AS ox, y AS oy, (x + dx) % 40 AS i, (y * 3) % 40 AS j FROM one, (VALUES (0), (1)) q(dx) WHERE source = 2) SELECT ox, oy, v, size FROM t LEFT JOIN s ON t.i = s.i AND t.j = s.j")
def index_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-14, GEO-12: output cells read the source cell of their index."""
    one = _one(spark, sf_dir)
    s = one.where("source = 1").select(F.col("x").alias("i"), F.col("y").alias("j"), "v", "size")
    dx = F.explode(F.array(F.lit(0), F.lit(1))).alias("dx")
    t = one.where("source = 2").select("x", "y", dx).select((F.col("x") * 2 + F.col("dx")).alias("ox"), F.col("y").alias("oy"), ((F.col("x") + F.col("dx")) % 40).alias("i"), ((F.col("y") * 3) % 40).alias("j"))
    return ops.index_lookup(t, s, ["i", "j"]).select("ox", "oy", "v", "size")


@query("""WITH p AS (SELECT p_partkey AS k, p_retailprice / 10 - 100 AS vx, p_size * 1.5 AS vy, 2.0 AS err, cos(p_partkey / 100.0) AS m11, -sin(p_partkey / 100.0) AS m12, 2 * sin(p_partkey / 100.0) AS m21, 2 * cos(p_partkey / 100.0) AS m22 FROM part),
r AS (SELECT *, m11 * vx + m12 * vy AS x, m21 * vx + m22 * vy AS y FROM p)
SELECT k, round(x, 5) AS vx_r, round(y, 5) AS vy_r, round(sqrt(x * x + y * y), 5) AS v_r, round(err * sqrt(x * x + y * y) / sqrt(vx * vx + vy * vy), 5) AS err_r, round(abs(m11) * err + abs(m12) * err, 6) AS ex_r FROM r""")
def vector_reprojection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-09, GEO-11, GEO-13, GEO-14: matrix times vector with scaled errors."""
    a = F.col("p_partkey") / 100.0
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), (F.col("p_retailprice") / 10 - 100).alias("vx"), (F.col("p_size") * 1.5).alias("vy"), F.lit(2.0).alias("err"), F.cos(a).alias("m11"), (-F.sin(a)).alias("m12"), (2 * F.sin(a)).alias("m21"), (2 * F.cos(a)).alias("m22"))
    r = ops.rotate(p)
    return r.select("k", *[F.round(c, 5).alias(c) for c in ("vx_r", "vy_r", "v_r", "err_r")], F.round("ex_r", 6).alias("ex_r"))


@query("SELECT count(*) AS n, round(avg(m11), 1) AS m11, round(avg(m12), 1) AS m12 FROM (SELECT cos(p_partkey / 100.0) AS m11, sin(p_partkey / 100.0) * 3 AS m12 FROM part)")
def mean_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-15: attributes turn by the mean matrix, one decimal."""
    a = F.col("p_partkey") / 100.0
    return table(spark, sf_dir, "part").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.cos(a)), 1).alias("m11"), F.round(F.avg(F.sin(a) * 3), 1).alias("m12"))


@query("""WITH c AS (SELECT DISTINCT p_size AS x, CAST(p_partkey % 30 AS INTEGER) AS y FROM part WHERE p_size < 20),
s AS (SELECT x + a AS ax, y + b AS ay, x + c AS zx, y + d AS zy FROM c, (VALUES (0, 0, 1, 0), (1, 0, 1, 1), (0, 1, 1, 1), (0, 0, 0, 1)) t(a, b, c, d)) SELECT ax, ay, zx, zy FROM s GROUP BY ALL HAVING count(*) = 1""")
def union_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-08: outline of a union of grid-aligned tiles."""
    c = table(spark, sf_dir, "part").where("p_size < 20").select(F.col("p_size").alias("x"), (F.col("p_partkey") % 30).cast("int").alias("y"))
    return ops.cell_union_edges(c)


def _in_outline(spark: SparkSession, sf_dir: str, cells: Column) -> DataFrame:
    ring = F.array(*[F.array(F.lit(float(a)), F.lit(float(b))) for a, b in ((20, 10), (70, 10), (70, 35), (45, 35), (45, 60), (20, 60), (20, 10))])
    k = F.col("p_partkey")
    g = table(spark, sf_dir, "part").select(k.alias("k"), ((k * 37) % 100).alias("x"), ((k * 61) % 100).alias("y")).where(cells)
    return g.select("k", grids.in_polygon(F.col("x").cast("double"), F.col("y").cast("double"), ring).alias("inside"))


@query("""WITH g AS (SELECT p_partkey AS k, (p_partkey * 37) % 100 AS x, (p_partkey * 61) % 100 AS y FROM part)
SELECT k, CASE WHEN x > 20 AND x < 70 AND y > 10 AND y < 60 AND NOT (x >= 45 AND y >= 35) THEN TRUE ELSE FALSE END AS inside FROM g WHERE x NOT IN (20, 45, 70) AND y NOT IN (10, 35, 60)""")
def polygon_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-07, GEO-19, FLT-15: cells in an L-shaped polygon by ray casting."""
    return _in_outline(spark, sf_dir, ~F.col("x").isin(20, 45, 70) & ~F.col("y").isin(10, 35, 60))


@query("""WITH g AS (SELECT p_partkey AS k, (p_partkey * 37) % 100 AS x, (p_partkey * 61) % 100 AS y FROM part)
SELECT k, CASE WHEN x > 20 AND x < 70 AND y > 10 AND y < 60 AND NOT (x >= 45 AND y >= 35) THEN TRUE ELSE FALSE END AS inside FROM g""")
def whole_polygon_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-07, GEO-19, FLT-15 over every cell; those on an edge are outside."""
    return _in_outline(spark, sf_dir, F.lit(True))


@query("""WITH m AS (SELECT DISTINCT CAST(p_partkey % 40 AS INTEGER) AS x, CAST((p_partkey // 40) % 40 AS INTEGER) AS y FROM part WHERE p_size > 25), c AS (SELECT i AS x, j AS y FROM generate_series(0, 39) a(i), generate_series(0, 39) b(j))
SELECT CAST(x // 10 AS BIGINT) AS tx, CAST(y // 10 AS BIGINT) AS ty, count(*) AS cells, CAST(sum(CASE WHEN (x, y) IN (SELECT (x, y) FROM m) THEN 1 ELSE 0 END) AS BIGINT) AS covered FROM c GROUP BY 1, 2""")
def tile_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-06, GEO-04, GEO-18: mask share of each tile; cells without a mask count as 0."""
    k = F.col("p_partkey")
    m = table(spark, sf_dir, "part").where("p_size > 25").select((k % 40).cast("int").alias("x"), (F.floor(k / 40) % 40).cast("int").alias("y")).distinct().withColumn("mask", F.lit(1))
    c = spark.range(1600).select((F.col("id") % 40).cast("int").alias("x"), F.floor(F.col("id") / 40).cast("int").alias("y"))
    return c.join(m, ["x", "y"], "left").groupBy(F.floor(F.col("x") / 10).alias("tx"), F.floor(F.col("y") / 10).alias("ty")).agg(F.count(F.lit(1)).alias("cells"), F.sum(F.coalesce("mask", F.lit(0))).alias("covered"))


@query("""SELECT k, abs(d) < 0.001 AS close FROM (SELECT p_partkey AS k, 0.0 AS d FROM part)""")
def projection_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-03, GEO-16: UTM and polar stereographic there and back, within a millimetre."""
    k = F.col("p_partkey")
    zone, south = (k % 60 + 1).cast("int"), k % 2 == 0
    lon, lat = zone * 6 - 183 + ((k * 7) % 50) / 10.0 - 2.5, F.when(south, -1).otherwise(1) * ((k * 13) % 800) / 10.0
    x, y = grids.utm_forward(lon, lat, zone, south)
    p = table(spark, sf_dir, "part").select(k.alias("k"), zone.alias("zone"), south.alias("south"), lon.alias("lon"), lat.alias("lat"), x.alias("x"), y.alias("y"))
    lon2, lat2 = grids.utm_inverse(F.col("x"), F.col("y"), F.col("zone"), F.col("south"))
    px, py = grids.polar_forward(F.col("lon"), F.abs("lat") + 9, 70.0, -45.0)
    p = p.select("*", lon2.alias("lon2"), lat2.alias("lat2"), px.alias("px"), py.alias("py"))
    lon3, lat3 = grids.polar_inverse(F.col("px"), F.col("py"), 70.0, -45.0)
    metre = 111_320.0
    off = F.greatest(F.abs(F.col("lon2") - F.col("lon")) * F.cos(F.radians("lat")), F.abs(F.col("lat2") - F.col("lat")), F.abs(grids.wrapped_longitude(lon3 - F.col("lon"))) * F.cos(F.radians(F.abs("lat") + 9)), F.abs(lat3 - F.abs("lat") - 9)) * metre
    return p.select("k", (off < 0.001).alias("close"))


@query(ONE + """, a AS (SELECT x, y, v, size FROM one WHERE source = 0), b AS (SELECT x, y, size AS f, count0 FROM one WHERE source = 1)
SELECT a.x, a.y, round(v / nullif(f, 0) * 2.0 + a.size * 0.5, 6) AS vx, CASE WHEN v IS NOT NULL THEN f * 12.5 END AS m11 FROM a JOIN b ON a.x = b.x AND a.y = b.y WHERE a.x BETWEEN 5 AND 30 AND a.y BETWEEN 2 AND 35""")
def raster_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-16, MTH-13: two rasters joined on the cell after a crop."""
    one = _one(spark, sf_dir)
    inside = F.col("x").between(5, 30) & F.col("y").between(2, 35)
    a = one.where("source = 0").where(inside).select("x", "y", "v", "size")
    b = one.where("source = 1").where(inside).select("x", "y", F.col("size").alias("f"))
    from ..functions.vectors import restored

    return a.join(b, ["x", "y"]).select("x", "y", F.round(F.col("v") / F.nullif(F.col("f"), F.lit(0)) * 2.0 + F.col("size") * 0.5, 6).alias("vx"), restored(F.col("f"), F.lit(12.5), F.col("v")).alias("m11"))
