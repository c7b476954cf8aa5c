"""Domain views over the driver's star schema (no rasters are supplied).

``observations``: a line item whose ship date lies after its order date is an image pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell, grp, obs, day1, day2, dt, speed, vx, vy, err, flag, shift, sat, start, stop."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).where("l_shipdate > o_orderdate")
    gap = F.datediff("l_shipdate", "o_orderdate")
    dt = gap / 8.0
    speed = F.when(F.col("l_returnflag") == "N", 500 * (1 - F.least(dt, F.lit(300.0)) / 320) + 2 * F.col("l_quantity")).otherwise(500 + 2 * F.col("l_quantity"))
    day = lambda c: F.datediff(c, F.lit("1990-01-01").cast("date"))
    return (
        j.where(gap > 0)
        .select(
            (F.col("l_suppkey") % 10).alias("cell"),
            F.col("l_returnflag").alias("grp"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("obs"),
            day("o_orderdate").alias("day1"),
            day("l_shipdate").alias("day2"),
            dt.alias("dt"),
            speed.alias("speed"),
            (1 + 100 * F.col("l_discount")).alias("err"),
            (F.col("l_linenumber") % 3).alias("flag"),
            (F.col("l_tax") * 1000).alias("shift"),
            F.when(F.col("l_returnflag") == "N", "8.").when(F.col("l_returnflag") == "R", "1A").otherwise("2B").alias("sat"),
        )
        .withColumn("vx", 0.8 * F.col("speed"))
        .withColumn("vy", 0.6 * F.col("speed"))
        .withColumn("start", 1990 + F.col("day1") / 365.25)
        .withColumn("stop", 1990 + F.col("day2") / 365.25)
    )


#: The same view for DuckDB.
OBS = """obs AS (SELECT *, 0.8 * speed AS vx, 0.6 * speed AS vy, 1990 + day1 / 365.25 AS start, 1990 + day2 / 365.25 AS stop FROM (
  SELECT l_suppkey % 10 AS cell, l_returnflag AS grp, l_orderkey * 10 + l_linenumber AS obs,
    date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS day1,
    date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS day2,
    date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) / 8.0 AS dt,
    CASE WHEN l_returnflag = 'N' THEN 500 * (1 - least(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) / 8.0, 300.0) / 320) + 2 * l_quantity ELSE 500 + 2 * l_quantity END AS speed,
    1 + 100 * l_discount AS err, l_linenumber % 3 AS flag, l_tax * 1000 AS shift,
    CASE l_returnflag WHEN 'N' THEN '8.' WHEN 'R' THEN '1A' ELSE '2B' END AS sat
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) > 0))"""


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as raster cells of overlapping tiles: x, y, tile, source, value, count0."""
    p = table(spark, sf_dir, "part")
    src = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))
    out = p.select((F.col("p_partkey") % 40).cast("int").alias("x"), (F.floor(F.col("p_partkey") / 40) % 40).cast("int").alias("y"), F.col("p_partkey").alias("tile"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"), src.alias("source"))
    keep = (F.col("tile") + F.col("source")) % 3 != 0
    return out.where(keep).withColumn("count0", F.when((F.col("size") + F.col("source")) % 7 == 0, None).otherwise((F.col("size") * (F.col("source") + 1)) % 11)).withColumn("v", F.when((F.col("size") * 3 + F.col("source")) % 5 == 0, None).otherwise(F.col("price") + F.col("source")))


CELLS = """cells AS (SELECT *, CASE WHEN (size + source) % 7 = 0 THEN NULL ELSE (size * (source + 1)) % 11 END AS count0,
    CASE WHEN (size * 3 + source) % 5 = 0 THEN NULL ELSE price + source END AS v FROM (
  SELECT CAST(p_partkey % 40 AS INTEGER) AS x, CAST((p_partkey // 40) % 40 AS INTEGER) AS y, p_partkey AS tile, p_size AS size, p_retailprice AS price, CAST(s AS INTEGER) AS source
  FROM part, (VALUES (0), (1), (2)) t(s) WHERE (p_partkey + s) % 3 <> 0))"""


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as acquisitions: pr (path/row), scene, day, cloud, nadir."""
    e = table(spark, sf_dir, "events")
    return e.select(
        (F.col("user_id") % 50).alias("pr"),
        F.col("event_id").alias("scene"),
        F.datediff("ts", F.lit("1990-01-01").cast("date")).alias("day"),
        F.pmod(F.col("event_id") * 7, F.lit(100)).alias("cloud"),
        (F.col("event_id") % 11 != 0).alias("nadir"),
        "ts",
        F.col("event_type").alias("kind"),
        "value",
        "user_id",
    )


SCENES = """scenes AS (SELECT user_id % 50 AS pr, event_id AS scene, date_diff('day', DATE '1990-01-01', CAST(ts AS DATE)) AS day,
  (event_id * 7) % 100 AS cloud, event_id % 11 <> 0 AS nadir, ts, event_type AS kind, value, user_id FROM events)"""
