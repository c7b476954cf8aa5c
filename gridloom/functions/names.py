"""Names of image pairs, cubes and mosaics; paths and directory prefixes.

All functions take and return columns.  File-name prefixes are parameters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of satellites per mission group, and the stable-shift thresholds.
MISSION_SATELLITES = {"L45": ("4", "5"), "L7": ("7",), "L89": ("8", "9"), "S1": ("1A", "1B", "1"), "S2": ("2A", "2B", "2")}
SHIFT_THRESHOLDS = {"L45": float("inf"), "L7": float("inf"), "L89": 61.6, "S1": 1.1, "S2": 28.5}
SENSOR_IDS = {"L45": 1, "L7": 2, "L89": 3, "S1": 4, "S2": 5}


def pair_halves(name: Column) -> Column:
    """The two image names of ``<image>_X_<image>_<grid>_P<nnn>.nc``."""
    return F.split(name, "_X_")


def tokens(name: Column) -> Column:
    return F.split(name, "_")


def landsat_pair(name: Column) -> Column:
    """(proc1, proc2, pair_id): processing dates of both images, and the name without them,
    without valid percentage and extension."""
    halves = pair_halves(name)
    one, two = tokens(F.element_at(halves, 1)), tokens(F.element_at(halves, 2))
    kept = F.concat(F.slice(one, 1, 4), F.slice(one, 6, F.lit(100)), F.array(F.lit("X")), F.slice(two, 1, 4), F.slice(two, 6, F.size(two) - 6))
    return F.struct(F.try_to_date(F.get(one, F.lit(4)), "yyyyMMdd").alias("proc1"), F.try_to_date(F.get(two, F.lit(4)), "yyyyMMdd").alias("proc2"), F.array_join(kept, "_").alias("pair_id"))


def acquisition(image: Column) -> Column:
    """Acquisition date: fourth token of optical names, sixth from the end of radar names."""
    t = tokens(image)
    radar = F.substring(image, 1, 1) == "S"
    raw = F.when(radar, F.try_element_at(t, F.lit(-5))).otherwise(F.try_element_at(t, F.lit(4)))
    return F.try_to_date(F.substring(raw, 1, 8), "yyyyMMdd")


def sensor_prefix(image: Column) -> Column:
    return F.substring_index(image, "_", 1)


def scene_short(name: Column) -> Column:
    return F.substring_index(name, "_", 4)


def cube_name(prefix: str, epsg: Column, grid: Column, x: Column, y: Column) -> Column:
    return F.format_string(f"{prefix}_EPSG%d_G%04d_X%d_Y%d.zarr", epsg, grid, x, y)


def composite_name(prefix: str, epsg: Column, grid: Column, x: Column, y: Column) -> Column:
    return F.format_string(f"{prefix}_EPSG%d_%03dm_X%d_Y%d.zarr", epsg, grid, x, y)


def mosaic_name(prefix: str, grid: Column, region: Column, year: Column, version: Column) -> Column:
    return F.format_string(f"{prefix}_%dm_%s_%s_%s.nc", grid, region, year, version)


def static_name(annual: Column, year: Column, key: str = "0000") -> Column:
    """The static mosaic's name from an annual one: its year token replaced."""
    return F.replace(annual, year, F.lit(key))


def to_store_path(url: Column) -> Column:
    """``https://<bucket>.<host>/<key>`` -> ``s3://<bucket>/<key>``."""
    return F.regexp_replace(url, r"^https?://([^./]+)\.[^/]+/", "s3://$1/")


def replace_token(path: Column, old: str, new: str) -> Column:
    return F.replace(path, F.lit(old), F.lit(new))


def replace_in_list(paths: Column, old: str, new: str) -> Column:
    return F.transform(paths, lambda p: F.replace(p, F.lit(old), F.lit(new)))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def scene_key(scene: Column) -> Column:
    """Directory of a scene from fixed positions: sensor, year, path, row, scene."""
    return F.concat_ws("/", F.substring(scene, 1, 4), F.substring(scene, 18, 4), F.substring(scene, 11, 3), F.substring(scene, 14, 3), scene)


def degree_prefix(lat: Column, lon: Column) -> Column:
    """Ten-degree directory: hemispheres and magnitudes toward zero; the pole counts to the
    80 band and the date line to the 170 band."""
    band = F.floor(F.abs(lat) / 10) * 10
    strip = F.floor(F.abs(lon) / 10) * 10
    return F.format_string(
        "%s%02d%s%03d",
        F.when(lat >= 0, "N").otherwise("S"),
        F.when(band == 90, 80).otherwise(band).cast("int"),
        F.when(lon >= 0, "E").otherwise("W"),
        F.when(strip >= 180, 170).otherwise(strip).cast("int"),
    )


def satellite_key(satellite: Column) -> Column:
    """Spellings such as ``8.``, ``8.0``, ``8`` become one."""
    return F.regexp_replace(satellite, r"\.0?$", "")


def mission_group(satellite: Column) -> Column:
    """Mission group of a satellite; null where unknown."""
    key = satellite_key(satellite)
    out = F.lit(None).cast("string")
    for group, members in MISSION_SATELLITES.items():
        out = F.when(key.isin(*members), F.lit(group)).otherwise(out)
    return out


def known_mission_group(satellite: Column) -> Column:
    """As ``mission_group``; an unknown satellite fails the query."""
    return F.coalesce(mission_group(satellite), F.raise_error(F.concat(F.lit("unknown satellite "), satellite)).cast("string"))


def sensor_id(group: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in SENSOR_IDS.items() for x in kv]), group)


def shift_threshold(group: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in SHIFT_THRESHOLDS.items() for x in kv]), group)


def log_count(line: Column, label: str) -> Column:
    """The number that follows ``label`` in a log line."""
    return F.try_to_number(F.regexp_extract(line, label + r"[^0-9]*([0-9]+)", 1), F.lit("999999999")).cast("long")
