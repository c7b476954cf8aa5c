"""Incremental cube update: a file stream of new layers, one bounded batch at a time.

The checkpoint is the ledger of files seen; ``foreachBatch`` drops layers that the cube
holds already, so a batch that runs again after a failure adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.catalog import newest
from ..sources.readers import exists


def update_cube(spark: SparkSession, incoming: str, cube: str, checkpoint: str, schema, key: str, qualify: Callable[[DataFrame], DataFrame] = lambda df: df, files_per_batch: int = 64) -> DataFrame:
    """Create the cube if there is none, else append what is new; returns the cube."""

    def add(batch: DataFrame, number: int) -> None:
        fresh = qualify(batch).dropDuplicates([key])
        if exists(spark, cube):
            fresh = fresh.join(spark.read.parquet(cube).select(key), key, "left_anti")
        fresh.write.mode("append").parquet(cube)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(incoming)
    stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(cube)


def current_layers(history: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Late reprocessings supersede older layers: the append-only history seen through the
    newest processing per key."""
    return newest(history, keys, order)


def windowed(events: DataFrame, time: str, lateness: str, size: str, *keys: str, value: str) -> DataFrame:
    """Event-time tumbling windows with a watermark (an addition of this engine)."""
    return events.withWatermark(time, lateness).groupBy(F.window(time, size), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
