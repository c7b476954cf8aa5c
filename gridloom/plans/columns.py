"""Names, dates, grids, JSON features and archive metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, grids, names
from ..sources import writers
from ..sources.views import table
from .registry import query

NAMES = """nm AS (SELECT o_orderkey AS k, 'LC08_L1TP_' || lpad(CAST(o_orderkey % 233 AS VARCHAR), 3, '0') || lpad(CAST(o_custkey % 248 AS VARCHAR), 3, '0') || '_' || strftime(o_orderdate, '%Y%m%d') || '_' || strftime(o_orderdate + INTERVAL 9 DAY, '%Y%m%d') || '_02_T1_X_LC09_L1GT_009011_' || strftime(o_orderdate + INTERVAL 16 DAY, '%Y%m%d') || '_' || strftime(o_orderdate + INTERVAL 40 DAY, '%Y%m%d') || '_02_T2_G0120V02_P' || lpad(CAST(o_custkey % 101 AS VARCHAR), 3, '0') || '.nc' AS name FROM orders)"""


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    day = lambda n: F.date_format(F.date_add(F.to_date("o_orderdate"), n), "yyyyMMdd")
    name = F.concat(F.lit("LC08_L1TP_"), pad(F.col("o_orderkey") % 233, 3), pad(F.col("o_custkey") % 248, 3), F.lit("_"), day(0), F.lit("_"), day(9), F.lit("_02_T1_X_LC09_L1GT_009011_"), day(16), F.lit("_"), day(40), F.lit("_02_T2_G0120V02_P"), pad(F.col("o_custkey") % 101, 3), F.lit(".nc"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), name.alias("name"))


@query(f"""WITH {NAMES}, t AS (SELECT k, name, string_split(split_part(name, '_X_', 1), '_') AS a, string_split(split_part(name, '_X_', 2), '_') AS b FROM nm)
SELECT k, CAST(strptime(a[5], '%Y%m%d') AS DATE) AS proc1, CAST(strptime(b[5], '%Y%m%d') AS DATE) AS proc2, array_to_string(list_concat(a[1:4], a[6:7], ['X'], b[1:4], b[6:8]), '_') AS pair_id,
  a[1] AS sensor1, b[1] AS sensor2, array_to_string(a[1:4], '_') AS short_name, CAST(strptime(a[4], '%Y%m%d') AS DATE) AS acquired FROM t""")
def pair_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-01, STR-02, STR-03, STR-04."""
    n = _names(spark, sf_dir)
    h = names.pair_halves(F.col("name"))
    return n.select("k", names.landsat_pair(F.col("name")).alias("p"), names.sensor_prefix(h[0]).alias("sensor1"), names.sensor_prefix(h[1]).alias("sensor2"), names.scene_short(F.col("name")).alias("short_name"), names.acquisition(h[0]).alias("acquired")).select("k", "p.*", "sensor1", "sensor2", "short_name", "acquired")


@query("""SELECT p_partkey AS k, 'vel_EPSG' || (32601 + p_partkey % 60) || '_G0120_X' || (p_partkey * 50) || '_Y' || (-50 * p_size) || '.zarr' AS cube, 'velocity_EPSG3413_060m_X' || p_partkey || '_Y' || p_size || '.zarr' AS composite,
  'velocity_120m_R' || p_size || '_' || (2000 + p_size % 20) || '_v02.nc' AS annual, 'velocity_120m_R' || p_size || '_0000_v02.nc' AS static_ FROM part""")
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-05, STR-06."""
    k, s = F.col("p_partkey"), F.col("p_size")
    year = (2000 + s % 20).cast("string")
    annual = names.mosaic_name("velocity", F.lit(120), F.concat(F.lit("R"), s.cast("string")), year, F.lit("v02"))
    return table(spark, sf_dir, "part").select(k.alias("k"), names.cube_name("vel", 32601 + k % 60, F.lit(120), k * 50, -50 * s).alias("cube"), names.composite_name("velocity", F.lit(3413), F.lit(60), k, s).alias("composite"), annual.alias("annual"), names.static_name(annual, year).alias("static_"))


@query("""SELECT page_id, regexp_replace(url, '^https?://([^./]+)\\.[^/]+/', 's3://\\1/') AS store, replace(url, 'http', 'ftp') AS moved, split_part(url, '/', -1) AS base, list_transform([url, 'a/old/b'], lambda x: replace(x, 'old', 'new')) AS listed FROM pages""")
def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-07, STR-09, STR-11, STR-13, SRC-21."""
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", names.to_store_path(u).alias("store"), names.replace_token(u, "http", "ftp").alias("moved"), names.base_name(u).alias("base"), names.replace_in_list(F.array(u, F.lit("a/old/b")), "old", "new").alias("listed"))


@query("""WITH g AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 97 = 0 THEN 90.0 ELSE (p_partkey * 7) % 1800 / 10.0 - 90 END AS lat, CASE WHEN p_partkey % 89 = 0 THEN 180.0 ELSE (p_partkey * 13) % 3600 / 10.0 - 180 END AS lon FROM part),
b AS (SELECT *, CAST(floor(abs(lat) / 10) AS INTEGER) * 10 AS la, CAST(floor(abs(lon) / 10) AS INTEGER) * 10 AS lo FROM g)
SELECT k, CASE WHEN lat >= 0 THEN 'N' ELSE 'S' END || lpad(CAST(CASE WHEN la = 90 THEN 80 ELSE la END AS VARCHAR), 2, '0') || CASE WHEN lon >= 0 THEN 'E' ELSE 'W' END || lpad(CAST(CASE WHEN lo >= 180 THEN 170 ELSE lo END AS VARCHAR), 3, '0') AS prefix FROM b""")
def degree_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-08."""
    k = F.col("p_partkey")
    lat = F.when(k % 97 == 0, 90.0).otherwise((k * 7) % 1800 / 10.0 - 90)
    lon = F.when(k % 89 == 0, 180.0).otherwise((k * 13) % 3600 / 10.0 - 180)
    return table(spark, sf_dir, "part").select(k.alias("k"), names.degree_prefix(lat, lon).alias("prefix"))


@query("""WITH s AS (SELECT p_partkey AS k, ['8.', '9.0', '7', '4.', '5', '1A', '1B', '2A', '2B', '2'][p_partkey % 10 + 1] AS sat FROM part), m AS (SELECT k, sat, CASE WHEN sat IN ('8.', '9.0') THEN 'L89' WHEN sat = '7' THEN 'L7' WHEN sat IN ('4.', '5') THEN 'L45' WHEN sat IN ('1A', '1B') THEN 'S1' ELSE 'S2' END AS mission FROM s)
SELECT mission, CASE mission WHEN 'L45' THEN 1 WHEN 'L7' THEN 2 WHEN 'L89' THEN 3 WHEN 'S1' THEN 4 ELSE 5 END AS sensor, count(*) AS n, count(DISTINCT sat) AS spellings FROM m GROUP BY ALL""")
def mission_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAP-01, MAP-02, MAP-03."""
    sat = F.element_at(F.array(*[F.lit(x) for x in ("8.", "9.0", "7", "4.", "5", "1A", "1B", "2A", "2B", "2")]), (F.col("p_partkey") % 10 + 1).cast("int"))
    s = table(spark, sf_dir, "part").select(sat.alias("sat")).withColumn("mission", names.known_mission_group(F.col("sat")))
    return s.groupBy("mission", names.sensor_id(F.col("mission")).alias("sensor")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("sat").alias("spellings"))


@query("""SELECT event_id, round(year(ts) + date_diff('microsecond', date_trunc('year', ts), ts) / CAST(date_diff('microsecond', date_trunc('year', ts), make_timestamp(year(ts), 12, 31, 23, 59, 59)) AS DOUBLE), 9) AS dec_year,
  ts + to_microseconds(CAST(date_diff('microsecond', ts, ts + INTERVAL 100 HOUR) // 2 + CAST(strftime(ts, '%y%m%d') AS BIGINT) AS BIGINT)) AS mid, CAST(ts AS DATE) + 8 AS half, strftime(ts, '%Y%m%d') || lpad(format('{:.1f}', CAST(event_id % 400 AS DOUBLE)), 7, '0') AS tag FROM events""")
def date_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DAT-01, DAT-02, DAT-04, DAT-05."""
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select("event_id", F.round(dates.decimal_year(ts), 9).alias("dec_year"), dates.mid_date(ts, F.timestamp_add("HOUR", F.lit(100), ts)).alias("mid"), dates.date_midpoint(F.to_date(ts), F.date_add(F.to_date(ts), 17)).alias("half"), dates.date_and_gap(ts, (F.col("event_id") % 400).cast("double")).alias("tag"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) WHEN 2 THEN NULL ELSE date_trunc('second', ts) END AS repaired FROM events""")
def repaired_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DAT-03: malformed date-times are repaired, short ones are null."""
    k, ts = F.col("event_id") % 4, F.col("ts")
    stamp = F.date_format(ts, "yyyyMMdd'T'HHmmss")
    text = F.when(k == 0, F.concat(stamp, F.lit("T00:00:00"))).when(k == 1, F.date_format(ts, "yyyyMMdd")).when(k == 2, F.lit("2019")).otherwise(stamp)
    return table(spark, sf_dir, "events").select("event_id", dates.repaired_timestamp(text).alias("repaired"))


@query("""SELECT p_partkey AS k, ceil((p_partkey * 10) / 120.0) * 120 - 7.5 AS x0, ceil((p_partkey * 10 + p_size * 100) / 120.0) * 120 - 7.5 AS x1, floor((-p_size * 1000) / 240.0) * 240 + 7.5 AS y0,
  CAST(floor((ceil((p_partkey * 10 + p_size * 100) / 120.0) * 120 - ceil((p_partkey * 10) / 120.0) * 120) / 120) AS INTEGER) AS nx, CAST(floor(p_partkey * 33 / 50.0) * 50 AS BIGINT) AS centre, ((p_partkey * 11 + 180) % 360 + 360) % 360 - 180 AS lon FROM part""")
def grid_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-01, GEO-02, GEO-05, GEO-06, ARR-01."""
    k, s = F.col("p_partkey"), F.col("p_size")
    x0, x1 = grids.snapped((k * 10).cast("double"), (k * 10 + s * 100).cast("double"), 120, "x")
    y0, _ = grids.snapped((-s * 1000).cast("double"), (-s * 1000 + 500).cast("double"), 240, "y")
    return table(spark, sf_dir, "part").select(k.alias("k"), x0.alias("x0"), x1.alias("x1"), y0.alias("y0"), F.size(grids.centres(x0, x1, 120)).alias("nx"), grids.tile_centre(k * 33.0).alias("centre"), grids.wrapped_longitude((k * 11).cast("double")).alias("lon"))


RING = "[[x, y], [x + 1, y], [x + 1, y + 2], [x, y + 2], [x, y]]"


@query(f"""WITH p AS (SELECT p_partkey AS k, CAST(p_partkey % 90 AS DOUBLE) AS x, CAST(p_size AS DOUBLE) AS y FROM part), r AS (SELECT k, x, y, {RING} AS ring FROM p)
SELECT k, x AS x_min, y AS y_min, x + 1 AS x_max, y + 2 AS y_max, array_to_string(list_transform(flatten(ring), lambda v: format('{{:.4f}}', v)), ',') AS text_, round(x - 0.001, 6) AS west, 17 AS n_points, x + 0.25 AS second_x FROM r""")
def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ARR-02, ARR-03, ARR-04, ARR-05, SRC-13."""
    x, y = (F.col("p_partkey") % 90).cast("double"), F.col("p_size").cast("double")
    ring = F.array(F.array(x, y), F.array(x + 1, y), F.array(x + 1, y + 2), F.array(x, y + 2), F.array(x, y))
    dense = grids.densified(x, y, x + 1, y + 2)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), grids.box(ring).alias("b"), grids.polygon_text(ring).alias("text_"), F.round(grids.point_box(x, y)[0], 6).alias("west"), F.size(dense).alias("n_points"), dense[1][0].alias("second_x")).select("k", "b.*", "text_", "west", "n_points", "second_x")


@query("""SELECT p_partkey AS k, '{"type":"Feature","geometry":{"type":"Polygon","coordinates":[[[' || CAST(CAST(p_size AS DOUBLE) AS VARCHAR) || ',0.0]]]},"properties":{"filename":"' || p_name || '","directory":"d","version":"002","epsg":' || p_size || '}}' AS feature FROM part""")
def catalog_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSN-01, STR-10: catalogue features as JSON."""
    p = table(spark, sf_dir, "part")
    ring = F.array(F.array(F.col("p_size").cast("double"), F.lit(0.0)))
    return p.select(F.col("p_partkey").alias("k"), writers.feature(F.col("p_name"), F.lit("d"), ring, {"version": F.lit("002"), "epsg": F.col("p_size")}).alias("feature"))


@query("""SELECT o_orderkey AS k, 'Begin_date=' || strftime(o_orderdate, '%Y-%m-%d') || chr(10) || 'Begin_time=00:00:00' || chr(10) || 'End_date=' || strftime(o_orderdate + INTERVAL 16 DAY, '%Y-%m-%d') || chr(10) || 'End_time=00:00:00' || chr(10) || 'Container=AssociatedPlatformInstrumentSensor' || chr(10) || 'AssociatedPlatformShortName=L8' || chr(10) || 'AssociatedInstrumentShortName=OLI' || chr(10) || 'AssociatedSensorShortName=OLI' AS premet,
  format('{:.2f}', 1.0) || chr(9) || format('{:.2f}', CAST(o_custkey AS DOUBLE)) || chr(10) || '2.50' || chr(9) || format('{:.2f}', CAST(o_custkey AS DOUBLE)) || chr(10) || '2.50' || chr(9) || '-3.25' || chr(10) || '1.00' || chr(9) || '-3.25' AS spatial_ FROM orders""")
def archive_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-19, SNK-20."""
    o = table(spark, sf_dir, "orders")
    begin = F.to_date("o_orderdate").cast("timestamp_ntz")
    end = F.date_add(F.to_date("o_orderdate"), 16).cast("timestamp_ntz")
    return o.select(F.col("o_orderkey").alias("k"), writers.premet(begin, end, F.lit("L8"), F.lit("OLI"), F.lit("OLI")).alias("premet"), writers.spatial(F.lit(1.0), F.lit(-3.25), F.lit(2.5), F.col("o_custkey").cast("double")).alias("spatial_"))


@query("SELECT o_orderkey AS k, o_custkey AS n FROM orders WHERE o_orderkey % 2 = 0")
def log_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-14: counts mined from log lines."""
    o = table(spark, sf_dir, "orders")
    line = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("INFO  cube_"), F.col("o_orderkey").cast("string"), F.lit(" layers: "), F.col("o_custkey").cast("string"))).otherwise(F.lit("INFO done"))
    return o.select(F.col("o_orderkey").alias("k"), names.log_count(line, "layers").alias("n")).where("n is not null")


@query("SELECT l_orderkey * 10 + l_linenumber AS k, round(sqrt((power(1 + l_tax, 2) + power(1 + l_discount, 2)) / 2 * (2 - pi() / 2)), 9) AS sigma FROM lineitem")
def noise_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTH-10: the simulated spread of a magnitude in closed form."""
    from ..functions.vectors import noise_magnitude

    li = table(spark, sf_dir, "lineitem")
    return li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), F.round(noise_magnitude(1 + F.col("l_tax"), 1 + F.col("l_discount")), 9).alias("sigma"))
