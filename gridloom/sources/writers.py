"""Writers: observation cubes, composites, mosaics, catalogue blocks and archive metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import packed


def append_cube(layers: DataFrame, path: str, tile: str = "tile") -> None:
    """Layers appended to a cube, clustered by cell inside each tile."""
    layers.repartition(F.col(tile), F.pmod(F.xxhash64("x", "y"), F.lit(16))).sortWithinPartitions(tile, "x", "y").write.mode("append").partitionBy(tile).option("compression", "zstd").parquet(path)


def write_packed(df: DataFrame, kinds: dict[str, str], path: str, partitions: tuple[str, ...] = ()) -> None:
    """Columns packed to integers with their fills; other columns as they are."""
    out = df.withColumns({c: packed(F.col(c), k) for c, k in kinds.items()})
    out.write.mode("overwrite").option("compression", "zstd").partitionBy(*partitions).parquet(path)


def write_years(df: DataFrame, path: str) -> None:
    """Annual mosaics; only the years at hand are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("region", "year").parquet(path)


def write_catalog(features: DataFrame, path: str, block: int) -> None:
    """Catalogue features as JSON lines, at most ``block`` per file."""
    features.write.mode("overwrite").option("maxRecordsPerFile", block).option("compression", "gzip").json(path)


def write_provenance(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def feature(filename: Column, directory: Column, ring: Column, properties: dict[str, Column]) -> Column:
    """A GeoJSON feature as JSON text."""
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    props = F.struct(filename.alias("filename"), directory.alias("directory"), *[c.alias(k) for k, c in properties.items()])
    return F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), props.alias("properties")))


def premet(begin: Column, end: Column, platform: Column, instrument: Column, sensor: Column) -> Column:
    """Archive begin/end and platform block."""
    day, clock = (lambda t: F.date_format(t, "yyyy-MM-dd")), (lambda t: F.date_format(t, "HH:mm:ss"))
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Begin_date="), day(begin)),
        F.concat(F.lit("Begin_time="), clock(begin)),
        F.concat(F.lit("End_date="), day(end)),
        F.concat(F.lit("End_time="), clock(end)),
        F.lit("Container=AssociatedPlatformInstrumentSensor"),
        F.concat(F.lit("AssociatedPlatformShortName="), platform),
        F.concat(F.lit("AssociatedInstrumentShortName="), instrument),
        F.concat(F.lit("AssociatedSensorShortName="), sensor),
    )


def spatial(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Archive corners, one per line with two decimals."""
    corner = lambda x, y: F.format_string("%.2f\t%.2f", x, y)
    return F.concat_ws("\n", corner(x0, y1), corner(x1, y1), corner(x1, y0), corner(x0, y0))


def write_text(df: DataFrame, column: str, path: str) -> None:
    df.select(column).write.mode("overwrite").text(path)
