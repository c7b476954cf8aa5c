"""Annual and seasonal models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors
from ..operators import fit
from ..sources.views import OBS, observations
from .registry import query

YEARS = "yr AS (SELECT o.*, y AS year, least(stop, y + 1.0) - greatest(start, CAST(y AS DOUBLE)) AS overlap FROM obs o, LATERAL (SELECT unnest(generate_series(CAST(floor(start) AS INTEGER), CAST(floor(stop) AS INTEGER))) AS y))"
ANNUAL = f"{YEARS}, annual AS (SELECT cell, grp, CAST(year AS INTEGER) AS year, count(*) AS n, 1 / sqrt(sum(overlap / (err * err))) AS err, sum(speed * overlap / (err * err)) / sum(overlap / (err * err)) AS v FROM yr WHERE overlap > 0 GROUP BY ALL)"


@query(f"WITH {OBS}, {YEARS} SELECT CAST(year AS INTEGER) AS year, count(*) AS n, round(sum(overlap), 5) AS total FROM yr WHERE overlap > 0 GROUP BY 1")
def year_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-07, SET-05."""
    return fit.years_of(observations(spark, sf_dir)).groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("overlap"), 5).alias("total"))


@query(f"WITH {OBS}, {ANNUAL} SELECT cell, grp, year, n, round(err, 8) AS err FROM annual")
def annual_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-12."""
    return fit.annual_counts(observations(spark, sf_dir), ["cell", "grp"]).withColumn("err", F.round("err", 8))


@query(f"WITH {OBS} SELECT cell, grp, round(sqrt(sum(power(speed - mu, 2) / err) / sum(1 / err)), 5) AS sd FROM (SELECT *, sum(speed / err) OVER w / sum(1 / err) OVER w AS mu FROM obs WINDOW w AS (PARTITION BY cell, grp)) GROUP BY ALL")
def weighted_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-06."""
    return observations(spark, sf_dir).groupBy("cell", "grp").agg(F.round(fit.weighted_std(F.col("speed"), 1 / F.col("err")), 5).alias("sd"))


def _annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fit.years_of(observations(spark, sf_dir))
    w = F.col("overlap") / (F.col("err") * F.col("err"))
    return rows.groupBy("cell", "grp", "year").agg(F.count(F.lit(1)).alias("n"), (1 / F.sqrt(F.sum(w))).alias("err"), (F.sum(w * F.col("speed")) / F.sum(w)).alias("v"))


@query(f"""WITH {OBS}, {ANNUAL}, t AS (SELECT *, year + 0.5 - CASE WHEN cell < 3 THEN 1980 ELSE 1995 END AS t, 1 / (err * err) AS w FROM annual),
s AS (SELECT cell, grp, count(*) AS n, sum(w) AS sw, sum(w * t) AS sx, sum(w * v) AS sy, sum(w * t * t) AS sxx, sum(w * t * v) AS sxy, sum(err * err) AS see, count(*) FILTER (t < 0) > 0 AND count(*) FILTER (t >= 0) > 0 AS two FROM t GROUP BY ALL)
SELECT cell, grp, n, round(CASE WHEN two THEN (sxx * sy - sx * sxy) / (sw * sxx - sx * sx) ELSE sy / sw END, 4) AS "offset", round(CASE WHEN two THEN (sw * sxy - sx * sy) / (sw * sxx - sx * sx) END, 4) AS slope,
  round(sqrt(see) / nullif(n - 1, 0), 6) AS error FROM s""")
def weighted_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-13: two-sided cells get a slope, one-sided cells a weighted mean."""
    a = _annual(spark, sf_dir).withColumn("t", F.col("year") + 0.5 - F.when(F.col("cell") < 3, 1980).otherwise(1995))
    out = fit.weighted_line(a, ["cell", "grp"])
    return out.select("cell", "grp", "n", F.round("offset", 4).alias("offset"), F.round("slope", 4).alias("slope"), F.round("error", 6).alias("error"))


def _seasonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a planted seasonal signal: one row per order, 40 days apart."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    day = F.datediff("o_orderdate", F.lit("1990-01-01").cast("date"))
    start = 1990 + day / 365.25
    stop = start + 40 / 365.25
    turn = 2 * 3.141592653589793
    wave = 50 * (F.cos(turn * start) - F.cos(turn * stop)) / turn / (stop - start)
    noise = (F.pmod(F.col("o_orderkey") * 37, F.lit(101)) - 50) / 10.0
    return o.select((F.col("o_custkey") % 8).cast("int").alias("cell"), start.alias("start"), stop.alias("stop"), (500 + wave + noise).alias("v"), (1 + F.col("o_custkey") % 3).cast("double").alias("err"), (F.col("o_orderkey") % 2 == 0).alias("reference"))


@query()
def harmonic_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-08..11, AGG-14, WIN-01, SRT-02: annual means, amplitude and phase per cell."""
    out = fit.harmonic_fit(_seasonal(spark, sf_dir), "cell", 1995.5, (1992, 1998))
    r = lambda c: F.round(c, 6).alias(c)
    return out.select("cell", "years", "n", r("offset"), r("slope"), r("amp"), r("phase"), "pairs", F.round(fit.outlier_percent(F.col("pairs"), F.col("n_all")), 6).alias("outlier_percent"))


@query()
def second_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-18: the fit without the reference group replaces the first where that inflates."""
    s = _seasonal(spark, sf_dir)
    inflate = F.when(F.col("reference") & (F.col("cell") < 3), F.col("v") + 200 * F.sin(6.283185307179586 * F.col("start"))).otherwise(F.col("v"))
    s = s.withColumn("v", inflate)
    both = fit.harmonic_fit(s, "cell", 1995.5, (1992, 1998)).select("cell", F.struct("amp", "phase", "pairs").alias("a"))
    one = fit.harmonic_fit(s.where("not reference"), "cell", 1995.5, (1992, 1998)).select("cell", F.struct("amp", "phase", "pairs").alias("b"))
    j = both.join(one, "cell", "left").withColumn("c", fit.prefer_second(F.col("a"), F.col("b")))
    return j.select("cell", F.round("c.amp", 6).alias("amp"), F.round("c.phase", 6).alias("phase"), "c.pairs", (F.col("c.pairs") != F.col("a.pairs")).alias("replaced"))


@query(f"""WITH {OBS}, a AS (SELECT cell, grp, count(*) FILTER ((start + stop) / 2 >= 1993 AND (start + stop) / 2 < 1997) AS n_all, count(*) FILTER ((start + stop) / 2 >= 1993 AND (start + stop) / 2 < 1997 AND dt <= 128) AS n_fit FROM obs GROUP BY ALL)
SELECT cell, grp, n_all, n_fit, round(100 * (1 - n_fit / n_all), 6) AS outlier_percent FROM a""")
def outlier_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-19."""
    mid = (F.col("start") + F.col("stop")) / 2
    window = (mid >= 1993) & (mid < 1997)
    a = observations(spark, sf_dir).groupBy("cell", "grp").agg(F.count_if(window).alias("n_all"), F.count_if(window & (F.col("dt") <= 128)).alias("n_fit"))
    return a.withColumn("outlier_percent", F.round(fit.outlier_percent(F.col("n_fit"), F.col("n_all")), 6))


POINTS = "pt AS (SELECT l_orderkey * 10 + l_linenumber AS k, l_extendedprice / 100 - 300 AS x, 40 * l_quantity - 900 AS y, 1 + 100 * l_discount AS ex, 1 + 100 * l_tax AS ey, l_orderkey % 366 AS px, l_partkey % 366 AS py, l_quantity AS ax, 50 * l_discount AS ay FROM lineitem)"


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select((c("l_orderkey") * 10 + c("l_linenumber")).alias("k"), (c("l_extendedprice") / 100 - 300).alias("x"), (40 * c("l_quantity") - 900).alias("y"), (1 + 100 * c("l_discount")).alias("ex"), (1 + 100 * c("l_tax")).alias("ey"), (c("l_orderkey") % 366).alias("px"), (c("l_partkey") % 366).alias("py"), c("l_quantity").alias("ax"), (50 * c("l_discount")).alias("ay"))


@query(f"WITH {POINTS} SELECT k, round(sqrt(x * x + y * y), 5) AS v, round(sqrt(power(ex * x, 2) + power(ey * y, 2)) / sqrt(x * x + y * y), 5) AS err, round((ex * abs(x) + ey * abs(y)) / sqrt(x * x + y * y), 5) AS err_sum, CAST(ceil((px + py) / 2) AS BIGINT) AS n, round(sqrt((ex * ex + ey * ey) / 2), 6) AS rms FROM pt")
def magnitudes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTH-01, MTH-02, MTH-03, MTH-08, MTH-12."""
    p = _points(spark, sf_dir)
    c = F.col
    return p.select("k", F.round(vectors.magnitude(c("x"), c("y")), 5).alias("v"), F.round(vectors.magnitude_error(c("x"), c("y"), c("ex"), c("ey")), 5).alias("err"), F.round(vectors.magnitude_error_sum(c("x"), c("y"), c("ex"), c("ey")), 5).alias("err_sum"), vectors.mean_count(c("px"), c("py")).alias("n"), F.round(vectors.shift_rms(c("ex"), c("ey")), 6).alias("rms"))


@query(f"""WITH {POINTS}, t AS (SELECT *, atan2(y, x) AS th, 2 * pi() * px / 365.25 AS a, 2 * pi() * py / 365.25 AS b FROM pt),
z AS (SELECT *, ax * cos(th) * cos(a) + ay * sin(th) * cos(b) AS re, ax * cos(th) * sin(a) + ay * sin(th) * sin(b) AS im FROM t)
SELECT k, round(sqrt(re * re + im * im), 5) AS amp, round((px * x + py * y) / sqrt(x * x + y * y), 5) AS dv_dt, round((ex * abs(x) + ey * abs(y)) / sqrt(x * x + y * y), 5) AS amp_err,
  round(cos(CASE WHEN re = 0 AND im = 0 THEN 0 ELSE atan2(im, re) END) * sqrt(re * re + im * im), 4) AS re FROM z""")
def climatology_magnitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTH-04, MTH-06, MTH-07: seasonal signal, trend and error along the mean flow."""
    c = F.col
    amp, phase = vectors.seasonal_along(c("x"), c("y"), c("ax"), c("px"), c("ay"), c("py"))
    p = _points(spark, sf_dir)
    return p.select("k", F.round(amp, 5).alias("amp"), F.round(vectors.along(c("px"), c("py"), c("x"), c("y")), 5).alias("dv_dt"), F.round(vectors.along_abs(c("ex"), c("ey"), c("x"), c("y")), 5).alias("amp_err"), F.round(F.cos(phase * (2 * 3.141592653589793 / 365.25)) * amp, 4).alias("re"))


@query(f"""WITH {POINTS}, t AS (SELECT *, x / 1000 AS th, 2 * pi() * px / 365.24 AS a, 2 * pi() * py / 365.24 AS b FROM pt),
z AS (SELECT *, ax * cos(th) * cos(a) - ay * sin(th) * cos(b) AS r1, ax * cos(th) * sin(a) - ay * sin(th) * sin(b) AS i1, ax * sin(th) * cos(a) + ay * cos(th) * cos(b) AS r2, ax * sin(th) * sin(a) + ay * cos(th) * sin(b) AS i2 FROM t)
SELECT k, round(sqrt(r1 * r1 + i1 * i1), 5) AS amp_x, round(sqrt(r2 * r2 + i2 * i2), 5) AS amp_y FROM z""")
def seasonal_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTH-05."""
    c = F.col
    (a1, _), (a2, _) = vectors.seasonal_rotated(c("x") / 1000, c("ax"), c("px"), c("ay"), c("py"))
    return _points(spark, sf_dir).select("k", F.round(a1, 5).alias("amp_x"), F.round(a2, 5).alias("amp_y"))


@query(f"""WITH {POINTS} SELECT k, round(2.0 * (ex / 5) * 3 + 0.5 * (ey / 5) * 4, 6) AS vx, round(-0.5 * (ex / 5) * 3 + 1.5 * (ey / 5) * 4, 6) AS vy, round(1.5 / 3.25, 6) AS m11, round(-0.5 / 3.25, 6) AS m12,
  CASE WHEN ax > 25 THEN round(ey * ax, 6) END AS restored FROM pt""")
def radar_rederivation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTH-09, MTH-13."""
    c, lit = F.col, lambda x: F.lit(float(x))
    vx, vy = vectors.radar_components(c("ex"), c("ey"), lit(5), (lit(2), lit(0.5), lit(-0.5), lit(1.5)), lit(3), lit(4))
    m = vectors.inverse_2x2(lit(2), lit(0.5), lit(-0.5), lit(1.5))
    return _points(spark, sf_dir).select("k", F.round(vx, 6).alias("vx"), F.round(vy, 6).alias("vy"), F.round(m[0], 6).alias("m11"), F.round(m[1], 6).alias("m12"), F.round(vectors.restored(c("ey"), c("ax"), F.when(c("ax") > 25, c("x"))), 6).alias("restored"))


@query(f"""WITH {POINTS}, q AS (SELECT k, CASE WHEN k % 13 = 0 THEN NULL ELSE x * 37.5 END AS v FROM pt)
SELECT k, CAST(CASE WHEN v IS NULL THEN -32767 ELSE greatest(least(round_even(v, 0), 32767), -32768) END AS INTEGER) AS s, CAST(CASE WHEN v IS NULL THEN 32767 ELSE greatest(least(round_even(v, 0), 65535), 0) END AS INTEGER) AS u, CAST(CASE WHEN v IS NULL THEN 255 ELSE greatest(least(round_even(v, 0), 255), 0) END AS INTEGER) AS b,
  CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END AS flipped, CASE WHEN NOT (v > 0) THEN v END AS outside FROM q""")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-05, SNK-06, SNK-07, FLT-15, FLT-16."""
    from ..operators.quality import masked

    q = _points(spark, sf_dir).select("k", F.when(F.col("k") % 13 != 0, F.col("x") * 37.5).alias("v"))
    flag = (F.col("k") % 2).cast("int")
    return q.select("k", vectors.packed(F.col("v"), "short").alias("s"), vectors.packed(F.col("v"), "ushort").alias("u"), vectors.packed(F.col("v"), "ubyte").alias("b"), F.when(flag == 1, 0).otherwise(1).alias("flipped"), masked(F.col("v"), F.col("v") > 0).alias("outside"))
