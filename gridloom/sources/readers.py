"""Readers: scene lists, catalogues, ledgers, jobs, text lists, observation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURE = "geometry struct<type:string,coordinates:array<array<array<double>>>>, properties struct<filename:string,directory:string,middate:string,deldays:double,percent_valid_pix:double,data_epsg:int>"


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """Pairs of a GeoJSON catalogue with their bounding box."""
    raw = spark.read.schema(f"features array<struct<{_struct(FEATURE)}>>").option("multiLine", True).json(path)
    f = raw.select(F.explode("features").alias("f")).select("f.geometry.coordinates", "f.properties.*")
    ring = F.element_at("coordinates", 1)
    x, y = F.transform(ring, lambda p: p[0]), F.transform(ring, lambda p: p[1])
    return f.select(F.concat_ws("/", "directory", "filename").alias("url"), "percent_valid_pix", "data_epsg", F.array_min(x).alias("x0"), F.array_min(y).alias("y0"), F.array_max(x).alias("x1"), F.array_max(y).alias("y1"))


def _struct(ddl: str) -> str:
    return ddl.replace("geometry struct", "geometry:struct").replace(", properties struct", ", properties:struct")


def scenes(spark: SparkSession, path: str) -> DataFrame:
    """Scene list, CSV with header, plain or gzip."""
    return spark.read.option("header", True).csv(path)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Skipped granules ``{reason: [url, ...]}`` as rows."""
    raw = spark.read.schema("value string").option("wholetext", True).text(path)
    m = F.from_json("value", "map<string,array<string>>")
    return raw.select(F.explode(m).alias("reason", "urls")).select("reason", F.explode("urls").alias("url"))


def jobs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def words(spark: SparkSession, path: str) -> DataFrame:
    """White-space-delimited list."""
    return spark.read.text(path).select(F.explode(F.split(F.trim("value"), r"\s+")).alias("item")).where("item <> ''")


def corrections(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("to_correct")


def joined_arrays(text) -> F.col:
    """Concatenated JSON arrays ``[..][..]`` as one array."""
    return F.regexp_replace(text, r"\]\s*\[", ",")


def pixels(spark: SparkSession, path: str) -> DataFrame:
    """Converted granules; files written before a column existed read as null there."""
    return spark.read.option("mergeSchema", True).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
