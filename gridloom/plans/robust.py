"""Layer filters and robust statistics per cell."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..operators import composite, quality, robust
from ..sources.views import OBS, SCENES, observations, scenes
from .registry import query

BIN = "CASE WHEN dt < 16 THEN 0 WHEN dt < 32 THEN 1 WHEN dt < 64 THEN 2 WHEN dt < 128 THEN 3 WHEN dt < 256 THEN 4 ELSE 5 END"
FILTER = f"""
meds AS (SELECT cell, grp, {BIN} AS bin, median(vp) AS med FROM proj WHERE vp IS NOT NULL GROUP BY ALL),
st AS (SELECT p.cell, p.grp, m.bin, any_value(med) AS med, median(abs(vp - med)) AS mad, count(*) AS n
  FROM proj p JOIN meds m ON p.cell = m.cell AND p.grp = m.grp AND {BIN} = m.bin WHERE vp IS NOT NULL GROUP BY ALL),
b AS (SELECT *, med - mad * (0.67 * 1.4826) AS lo, med + mad * (0.67 * 1.4826) AS hi FROM st),
r AS (SELECT *, coalesce(min(CASE WHEN n >= 49 THEN bin END) OVER w, min(CASE WHEN hi <> 0 THEN bin END) OVER w) AS ref FROM b WINDOW w AS (PARTITION BY cell, grp)),
x AS (SELECT *, max(CASE WHEN bin = ref THEN lo END) OVER w AS rlo, max(CASE WHEN bin = ref THEN hi END) OVER w AS rhi FROM r WINDOW w AS (PARTITION BY cell, grp)),
lim AS (SELECT cell, grp, CAST(sum(n) AS BIGINT) AS n_obs, CAST(max(ref) AS INTEGER) AS ref_bin,
  CAST(min(CASE WHEN lo > rhi OR hi < rlo THEN [0, 16, 32, 64, 128, 256][bin + 1] END) AS INTEGER) AS max_dt FROM x GROUP BY cell, grp)"""
FLOW = """
caps AS (SELECT *, count(*) FILTER (dt <= 16) OVER w AS n1, count(*) FILTER (dt <= 32) OVER w AS n2, count(*) FILTER (dt <= 64) OVER w AS n3,
  count(*) FILTER (dt <= 128) OVER w AS n4, count(*) FILTER (dt <= 256) OVER w AS n5 FROM obs WINDOW w AS (PARTITION BY cell)),
capped AS (SELECT *, CASE WHEN n1 >= 50 THEN 16.0 WHEN n2 >= 50 THEN 32.0 WHEN n3 >= 50 THEN 64.0 WHEN n4 >= 50 THEN 128.0 WHEN n5 >= 50 THEN 256.0 ELSE CAST('inf' AS DOUBLE) END AS cap FROM caps),
flow AS (SELECT cell, CAST(max(cap) AS DOUBLE) AS dt_cap, count(*) AS n_flow, median(vx) AS vx0, median(vy) AS vy0 FROM capped WHERE dt <= cap GROUP BY cell)"""
PROJ = """
proj AS (SELECT o.*, CASE WHEN sqrt(vx0 * vx0 + vy0 * vy0) > 50 THEN (vx * vx0 + vy * vy0) / sqrt(vx0 * vx0 + vy0 * vy0) END AS vp FROM obs o JOIN flow USING (cell))"""


def _projected(obs: DataFrame) -> DataFrame:
    return robust.projected(obs, robust.flow_direction(obs, ["cell"]), ["cell"])


@query(f"WITH {OBS}, {FLOW}, {PROJ}, {FILTER} SELECT * FROM lim")
def dt_bin_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-04, AGG-05, WIN-02: largest usable time separation per cell and group."""
    return robust.dt_bin_filter(_projected(observations(spark, sf_dir)), ["cell"], "grp")


@query(f"WITH {OBS}, proj AS (SELECT *, speed / 100 AS vp FROM obs WHERE grp <> 'N'), {FILTER} SELECT * FROM lim")
def dt_bin_filter_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same filter on groups without a planted trend: nothing is cut."""
    return robust.dt_bin_filter(observations(spark, sf_dir).where("grp <> 'N'").withColumn("vp", F.col("speed") / 100), ["cell"], "grp")


@query(f"WITH {OBS}, {FLOW}, {PROJ}, {FILTER} SELECT p.cell, p.grp, count(*) AS n, round(sum(vp), 4) AS total FROM proj p LEFT JOIN lim l ON p.cell = l.cell AND p.grp = l.grp WHERE max_dt IS NULL OR dt <= max_dt GROUP BY ALL")
def dt_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-05: the filter applied."""
    p = _projected(observations(spark, sf_dir))
    kept = robust.apply_max_dt(p, robust.dt_bin_filter(p, ["cell"], "grp"), ["cell"], "grp")
    return kept.groupBy("cell", "grp").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("vp"), 4).alias("total"))


@query(f"WITH {OBS}, m AS (SELECT cell, grp, median(speed) AS med FROM obs GROUP BY ALL) SELECT o.cell, o.grp, round(any_value(med), 6) AS median, round(median(abs(speed - med)), 6) AS mad, count(*) AS n FROM obs o JOIN m ON o.cell = m.cell AND o.grp = m.grp GROUP BY ALL")
def median_mad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-01."""
    out = robust.median_mad(observations(spark, sf_dir), ["cell", "grp"], "speed")
    return out.select("cell", "grp", F.round("median", 6).alias("median"), F.round("mad", 6).alias("mad"), "n")


@query(f"WITH {OBS}, {FLOW} SELECT cell, dt_cap, n_flow, round(vx0, 6) AS vx0, round(vy0, 6) AS vy0, round(sqrt(vx0 * vx0 + vy0 * vy0), 6) AS v0, sqrt(vx0 * vx0 + vy0 * vy0) <= 50 AS slow FROM flow")
def median_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-02, AGG-03."""
    f = robust.flow_direction(observations(spark, sf_dir), ["cell"])
    return f.select("cell", "dt_cap", "n_flow", *[F.round(c, 6).alias(c) for c in ("vx0", "vy0", "v0")], "slow")


SHORT = "short AS (SELECT *, avg(vx) OVER w AS mx, avg(vy) OVER w AS my FROM biased WHERE dt <= 64 WINDOW w AS (PARTITION BY cell, grp))"
SENSOR = f"""biased AS (SELECT * REPLACE (CASE WHEN grp = 'A' THEN vx - 150 ELSE vx END AS vx, CASE WHEN grp = 'A' THEN vy - 120 ELSE vy END AS vy) FROM obs), {SHORT},
bins AS (SELECT cell, grp, floor((day1 + day2) / 2 / 73) AS bin, avg((vx * mx + vy * my) / sqrt(mx * mx + my * my)) AS m, count(*) AS n FROM short GROUP BY ALL HAVING count(*) >= 3),
d AS (SELECT a.cell, a.grp, a.m - r.m AS delta FROM bins a JOIN bins r ON a.cell = r.cell AND a.bin = r.bin AND r.grp = 'N' WHERE a.grp <> 'N'),
s AS (SELECT cell, grp, count(*) AS bins, avg(delta) AS md, stddev_pop(delta) AS sd FROM d GROUP BY ALL HAVING count(*) > 3),
dis AS (SELECT cell, grp, bins, md, sd / sqrt(bins - 1) AS se, md + 3 * sd / sqrt(bins - 1) < 0 AS excluded FROM s)"""


def _biased(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = F.col("grp") == "A"
    o = observations(spark, sf_dir).withColumn("day", (F.col("day1") + F.col("day2")) / 2)
    return o.withColumn("vx", F.when(low, F.col("vx") - 150).otherwise(F.col("vx"))).withColumn("vy", F.when(low, F.col("vy") - 120).otherwise(F.col("vy")))


@query(f"WITH {OBS}, {SENSOR} SELECT cell, grp, bins, round(md, 5) AS mean_delta, round(se, 5) AS se, excluded FROM dis")
def sensor_disagreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-15."""
    out = robust.disagreeing_groups(_biased(spark, sf_dir), ["cell"], "grp", "N")
    return out.select("cell", "grp", "bins", F.round("mean_delta", 5).alias("mean_delta"), F.round("se", 5).alias("se"), "excluded")


@query(f"WITH {OBS}, {SENSOR} SELECT b.cell, b.grp, count(*) AS n FROM biased b WHERE NOT EXISTS (SELECT 1 FROM dis x WHERE x.cell = b.cell AND x.grp = b.grp AND excluded AND b.cell % 2 = 0) GROUP BY ALL")
def sensor_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-16: exclusion applies where the inland mask (odd cells) is 0."""
    b = _biased(spark, sf_dir)
    bad = robust.disagreeing_groups(b, ["cell"], "grp", "N").where(F.col("cell") % 2 == 0)
    return robust.without_groups(b, bad, ["cell"], "grp").groupBy("cell", "grp").agg(F.count(F.lit(1)).alias("n"))


KEPT = "bad AS (SELECT cell, grp FROM dis WHERE excluded AND cell % 2 = 0), kept AS (SELECT * FROM biased b WHERE NOT EXISTS (SELECT 1 FROM bad x WHERE x.cell = b.cell AND x.grp = b.grp))"


@query(f"""WITH {OBS}, {SENSOR}, {KEPT}, {FLOW.replace("FROM obs", "FROM kept")}, {PROJ.replace("FROM obs o", "FROM kept o")}, {FILTER},
f AS (SELECT p.cell, p.grp, count(*) AS n, sum(vp) AS total FROM proj p LEFT JOIN lim l ON p.cell = l.cell AND p.grp = l.grp WHERE (max_dt IS NULL OR dt <= max_dt) AND sqrt(vx * vx + vy * vy) <= 560 GROUP BY ALL),
g AS (SELECT cell, grp, count(*) AS n_all FROM biased GROUP BY ALL)
SELECT g.cell, g.grp, n_all, CASE WHEN bad.cell IS NULL THEN 1 ELSE 0 END AS include, max_dt, coalesce(n, 0) AS n, round(total, 4) AS total
FROM g LEFT JOIN bad ON g.cell = bad.cell AND g.grp = bad.grp LEFT JOIN lim ON g.cell = lim.cell AND g.grp = lim.grp LEFT JOIN f ON g.cell = f.cell AND g.grp = f.grp""")
def composite_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-03, AGG-05, AGG-15..17, FLT-06: the composite's filters in one plan, excluded groups
    passed through."""
    rows, groups = composite.filtered(_biased(spark, sf_dir), F.col("cell") % 2 != 0, "N", speed_limit=560.0)
    n = rows.groupBy("cell", "grp").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("vp"), 4).alias("total"))
    return groups.join(n, ["cell", "grp"], "left").select("cell", "grp", "n_all", "include", "max_dt", F.coalesce("n", F.lit(0)).alias("n"), "total")


@query()
def composite_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-17: exclusion, flow, time filter, speed limit, fits with and without the reference
    group, magnitudes, share of outliers and limits in one plan."""
    out = composite.composite(_biased(spark, sf_dir), F.col("cell") % 2 != 0, "N", 1995.5, (1993, 1996))
    r = lambda name: F.round(name, 5).alias(name)
    lists = [F.transform(k, lambda x: F.round(x, 5)).alias(k) for k in ("v", "v_error")]
    return out.select("cell", "years", *lists, "n", *map(r, ("v0", "v0_error", "dv_dt", "amp", "amp_error", "phase")), "pairs", r("outlier_percent"), "replaced", "groups")


@query(f"""WITH {OBS}, t AS (SELECT *, CASE sat WHEN '8.' THEN 61.6 WHEN '1A' THEN 1.1 ELSE 28.5 END AS threshold FROM obs),
f AS (SELECT *, shift * dt / 365.25 > threshold AS big FROM t)
SELECT grp, count(*) FILTER (NOT (big AND flag = 1)) AS kept, count(*) FILTER (big AND flag = 2) AS reversed,
  round(sum(CASE WHEN big AND flag = 2 THEN vx + shift ELSE vx END) FILTER (NOT (big AND flag = 1)), 3) AS vx_sum FROM f GROUP BY grp""")
def stable_shift_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-03, FLT-04, FLT-05, MAP-01."""
    o = observations(spark, sf_dir).withColumn("mission", names.known_mission_group(F.col("sat")))
    s = robust.stable_shift(o, names.shift_threshold(F.col("mission")), F.col("shift"), F.col("shift"), F.col("dt"), F.col("flag"))
    return s.groupBy("grp").agg(F.count_if("keep").alias("kept"), F.count_if(F.col("add_x") > 0).alias("reversed"), F.round(F.sum(F.when(F.col("keep"), F.col("vx") + F.col("add_x"))), 3).alias("vx_sum"))


@query(f"""WITH {OBS}, v AS (SELECT * FROM obs WHERE (start + stop) / 2 >= 1993 AND (start + stop) / 2 < 1997 AND sqrt(vx * vx + vy * vy) <= 560),
n AS (SELECT *, count(*) OVER (PARTITION BY cell, grp, flag, floor(start)) AS k FROM v) SELECT cell, grp, count(*) AS n, round(avg(vx), 6) AS vx FROM n WHERE k >= 30 GROUP BY ALL""")
def observation_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-06, FLT-07, FLT-08: speed limit, climatology window, least number per cell."""
    mid = (F.col("start") + F.col("stop")) / 2
    o = observations(spark, sf_dir).where((mid >= 1993) & (mid < 1997) & (F.hypot("vx", "vy") <= 560)).withColumn("y", F.floor("start"))
    return robust.enough(o, ["cell", "grp", "flag", "y"], 30).groupBy("cell", "grp").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("vx"), 6).alias("vx"))


@query(f"""WITH {OBS}, p AS (SELECT cell, grp, flag % 2 = 0 AS stable, speed, 2 * dt + 450 AS ref FROM obs),
q AS (SELECT *, quantile_cont(abs(ref), 0.25) OVER (PARTITION BY cell, grp) AS q25 FROM p),
a AS (SELECT cell, grp, count(*) FILTER (stable) AS n_stable, count(*) FILTER (abs(ref) <= q25) AS n_slow,
  median(speed - ref) FILTER (stable) AS s1, stddev_pop(speed - ref) FILTER (stable) AS e1 FROM q GROUP BY ALL)
SELECT cell, grp, n_stable, n_slow, round(s1, 1) AS shift, round(e1, 1) AS error, 1 AS flag FROM a""")
def shift_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-21."""
    o = observations(spark, sf_dir).select("cell", "grp", (F.col("flag") % 2 == 0).alias("stable"), "speed", (2 * F.col("dt") + 450).alias("ref"))
    return robust.calibrated_shift(o, ["cell", "grp"], "speed", "ref", "stable")


LAYERS = "px AS (SELECT p_partkey % 50 AS layer, CASE WHEN p_partkey % 50 % 9 = 0 THEN 32622 ELSE 3413 END AS epsg, p_size AS x, p_partkey % 37 AS y, CASE WHEN p_partkey % 50 % 5 = 0 THEN NULL ELSE p_retailprice END AS v FROM part)"


def _layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 50
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(k.alias("layer"), F.when(k % 9 == 0, 32622).otherwise(3413).alias("epsg"), F.col("p_size").alias("x"), (F.col("p_partkey") % 37).alias("y"), F.when(k % 5 != 0, F.col("p_retailprice")).alias("v"))


STATUS = f"""WITH {LAYERS}, s AS (SELECT layer, max(epsg) AS epsg, count(*) FILTER (x BETWEEN 5 AND 40 AND y BETWEEN 3 AND 30) AS n_in,
  count(v) FILTER (x BETWEEN 5 AND 40 AND y BETWEEN 3 AND 30) AS n_valid, count(DISTINCT x) FILTER (x BETWEEN 5 AND 40 AND y BETWEEN 3 AND 30) AS nx, count(DISTINCT y) FILTER (x BETWEEN 5 AND 40 AND y BETWEEN 3 AND 30) AS ny FROM px GROUP BY layer),
st AS (SELECT layer, n_in, n_valid, CASE WHEN epsg <> 3413 THEN 'wrong_projection' WHEN n_in = 0 THEN 'outside' WHEN n_valid = 0 THEN 'empty' WHEN nx <= 1 OR ny <= 1 THEN 'one_cell' ELSE 'keep' END AS status FROM s)"""


@query(STATUS + " SELECT * FROM st")
def layer_qualification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-01, FLT-02."""
    return quality.qualify(_layers(spark, sf_dir), "layer", "epsg", 3413, (5, 3, 40, 30))


@query(STATUS + " SELECT status, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM st GROUP BY status")
def skip_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-26."""
    from ..operators.catalog import reasons

    out = reasons(quality.qualify(_layers(spark, sf_dir), "layer", "epsg", 3413, (5, 3, 40, 30)), "status")
    return out.withColumn("percent", F.round("percent", 6))


@query(f"WITH {LAYERS}, b AS (SELECT layer, min(x) FILTER (w) AS x0, max(x) FILTER (w) AS x1, min(y) FILTER (w) AS y0, max(y) FILTER (w) AS y1 FROM (SELECT *, v > 905 AND x BETWEEN 8 AND 41 AND y > 4 AS w FROM px) GROUP BY layer) SELECT p.layer, count(*) AS n FROM px p JOIN b USING (layer) WHERE x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 GROUP BY ALL")
def crop_to_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-12."""
    p = _layers(spark, sf_dir).withColumn("w", F.when((F.col("v") > 905) & F.col("x").between(8, 41) & (F.col("y") > 4), F.col("v")))
    return quality.crop_to_valid(p, ["layer"], "w").groupBy("layer").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT l_returnflag AS grp, count(*) AS n, round(avg(p), 5) AS mean, round(stddev_pop(p), 5) AS std, round(min(p), 5) AS least, round(max(p), 5) AS most
FROM (SELECT l_returnflag, 100 * (a - b) / ((a + b) / 2) AS p FROM (SELECT l_returnflag, l_extendedprice AS a, l_extendedprice * (1 - l_discount) AS b FROM lineitem)) GROUP BY 1""")
def percent_difference_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-22, AGG-23, MTH-11."""
    from ..functions.vectors import percent_difference

    x = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_returnflag").alias("grp"), percent_difference(F.col("l_extendedprice"), F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("p"))
    s = quality.spread_stats(x, ["grp"], F.col("p")).join(x.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "grp")
    return s.select("grp", "n", *[F.round(c, 5).alias(c) for c in ("mean", "std", "least", "most")])


@query(f"""WITH {SCENES}, d AS (SELECT pr, min(ts) AS t0, max(ts) AS t1, count(*) AS n, count(*) FILTER (value IS NULL) AS nulls FROM scenes GROUP BY pr)
SELECT pr, n, CAST(t0 AS DATE) AS first_day, nulls = 0 AND t0 >= TIMESTAMP '2020-01-01' AS ok FROM d""")
def cube_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-24, AGG-25, FLT-14: least date and null coordinates per cube."""
    s = scenes(spark, sf_dir).groupBy("pr").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("t0"), F.count_if(F.col("value").isNull()).alias("nulls"))
    return s.select("pr", "n", F.to_date("t0").alias("first_day"), ((F.col("nulls") == 0) & (F.col("t0") >= F.lit("2020-01-01").cast("timestamp_ntz"))).alias("ok"))


@query("""SELECT o_custkey % 100 AS cube, min(c) AS least, max(s) AS size, CASE WHEN min(c) >= 0 THEN 'cast' WHEN max(s) > 140000 THEN 'on_demand' ELSE 'spot' END AS action
FROM (SELECT o_custkey, CAST(o_totalprice AS BIGINT) % 977 - 2 AS c, o_orderkey * 10 AS s FROM orders) GROUP BY 1""")
def overflow_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-17."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select((F.col("o_custkey") % 100).alias("cube"), (F.rint("o_totalprice").cast("long") % 977 - 2).alias("c"), (F.col("o_orderkey") * 10).alias("s"))
    return quality.overflow_triage(o, "cube", "c", F.col("s"))


@query(f"""WITH {OBS} SELECT q, count(*) AS n FROM (SELECT CASE WHEN dt < 5 OR f IS NULL THEN 0 WHEN f = 2 THEN 3 WHEN f = 3 THEN 2 ELSE f END AS q FROM (SELECT dt, CASE WHEN obs % 5 = 4 THEN NULL ELSE obs % 5 END AS f FROM obs)) GROUP BY q""")
def quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-29."""
    o = observations(spark, sf_dir)
    f = F.when(F.col("obs") % 5 != 4, F.col("obs") % 5)
    return o.select(quality.flag_swap(f, F.col("dt") < 5).alias("q")).groupBy("q").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {OBS}, layers AS (SELECT DISTINCT flag, CASE WHEN flag = 1 THEN 0 ELSE 1 END AS keep, flag * 2.5 AS extra FROM obs) SELECT cell, count(*) AS n, round(sum(vx + extra), 3) AS vx FROM obs JOIN layers USING (flag) WHERE keep = 1 GROUP BY cell")
def layer_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-15: per-layer scalars joined to every pixel of the layer."""
    layers = spark.createDataFrame([(0, 0.0, True), (1, 2.5, False), (2, 5.0, True)], "flag int, extra double, keep boolean").where("keep")  # three rows
    o = observations(spark, sf_dir).join(F.broadcast(layers), "flag")
    return o.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("vx") + F.col("extra")), 3).alias("vx"))
