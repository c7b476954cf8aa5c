"""Layer qualification, crops, masks, validation and repair triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def qualify(pixels: DataFrame, layer: str, epsg: str, target: int, box: tuple[float, float, float, float], value: str = "v", x: str = "x", y: str = "y") -> DataFrame:
    """Status per layer: wrong_projection, outside, empty, one_cell or keep."""
    inside = F.col(x).between(box[0], box[2]) & F.col(y).between(box[1], box[3])
    s = pixels.groupBy(layer).agg(F.max(epsg).alias("epsg"), F.count_if(inside).alias("n_in"), F.count(F.when(inside, F.col(value))).alias("n_valid"), F.count_distinct(F.when(inside, F.col(x))).alias("nx"), F.count_distinct(F.when(inside, F.col(y))).alias("ny"))
    status = F.when(F.col("epsg") != target, "wrong_projection").when(F.col("n_in") == 0, "outside").when(F.col("n_valid") == 0, "empty").when((F.col("nx") <= 1) | (F.col("ny") <= 1), "one_cell").otherwise("keep")
    return s.select(layer, "n_in", "n_valid", status.alias("status"))


def crop_to_valid(df: DataFrame, keys: list[str], value: str, x: str = "x", y: str = "y") -> DataFrame:
    """Rows inside the bounding box of the non-null values of their key: the boxes are
    grouped and joined back, so no layer's rows are buffered."""
    ends = [f(c).alias(f"__{c}{i}") for c in (x, y) for i, f in enumerate((F.min, F.max))]
    boxes = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(*ends)
    out = df.join(boxes, keys).where(F.col(x).between(F.col(f"__{x}0"), F.col(f"__{x}1")) & F.col(y).between(F.col(f"__{y}0"), F.col(f"__{y}1")))
    return out.select(*df.columns)


def masked(c: Column, inside: Column, fill: Column | None = None) -> Column:
    return F.when(~inside, c).otherwise(fill if fill is not None else F.lit(None))


def spread_stats(df: DataFrame, keys: list[str], c: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"), F.min(c).alias("least"), F.max(c).alias("most"))


def one_value(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """Cross-layer invariants: columns that must hold one value per key, and whether they do."""
    return df.groupBy(key).agg(*[(F.count_distinct(c) <= 1).alias(f"{c}_ok") for c in columns])


def overflow_triage(df: DataFrame, key: str, count: str, size: Column, limit: int = 140_000) -> DataFrame:
    """A negative count means an overflow: run again, on demand if the cube is large."""
    s = df.groupBy(key).agg(F.min(count).alias("least"), F.max(size).alias("size"))
    return s.withColumn("action", F.when(F.col("least") >= 0, "cast").when(F.col("size") > limit, "on_demand").otherwise("spot"))


def flag_swap(flag: Column, empty: Column) -> Column:
    """Quality flags: years without data 0, 2 and 3 exchanged, missing 0."""
    return F.when(empty | flag.isNull(), 0).when(flag == 2, 3).when(flag == 3, 2).otherwise(flag)


def mismatches(a: DataFrame, b: DataFrame, key: str, column: str) -> DataFrame:
    """Rows whose timestamps differ in date or hour between two tables."""
    j = a.select(key, F.col(column).alias("one")).join(b.select(key, F.col(column).alias("two")), key)
    return j.where((F.to_date("one") != F.to_date("two")) | (F.hour("one") != F.hour("two")))


VALIDATIONS = {
    "no_null_coordinates": lambda df: df.where(F.col("x").isNull() | F.col("y").isNull() | F.isnan("x") | F.isnan("y")),
    "dates_in_range": lambda df: df.where(F.col("date") < F.lit("1980-01-01").cast("date")),
}


def validate(df: DataFrame, name: str) -> DataFrame:
    """Rows that break the named validation."""
    return VALIDATIONS[name](df)
