"""Shared plumbing: tables in the cluster's shared folder, code shipping, name helpers."""

from __future__ import annotations

import atexit
import os
import sys
import tempfile
import uuid
import weakref
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WS = r"\x20\x09-\x0D"
WORD = rf"[^{WS}]+"

_shipped: set[str] = set()
_scratch: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine (tests, local mode) is a local
    folder set; on a cluster the setting is required.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        set_by_context = spark.sparkContext._jsc.sc().getCheckpointDir()
        if set_by_context.isDefined():
            found = set_by_context.get()
        elif not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        else:
            found = "file://" + tempfile.mkdtemp(prefix="gridloom-")
            spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/gridloom/{name}-{uuid.uuid4().hex}"
    _scratch[path] = weakref.ref(spark)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete one scratch table through Hadoop's file system (works on any store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    _scratch.pop(path, None)


@atexit.register
def _drop_all() -> None:
    for path, ref in list(_scratch.items()):
        spark = ref()
        try:
            if spark is not None and spark.sparkContext._jsc is not None:
                drop_path(spark, path)
        except Exception:  # the gateway may be gone at exit; nothing is left to do then
            pass


class Staged:
    """A table written to the shared folder: lineage ends here, lost executors cost nothing."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, name)
        df.write.option("compression", "zstd").parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        drop_path(self.spark, self.path)


def stage(df: DataFrame, name: str) -> DataFrame:
    return Staged(df, name).df


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    out = os.path.join(tempfile.mkdtemp(prefix="gridloom-code-"), "gridloom_code.zip")
    with zipfile.ZipFile(out, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    spark.sparkContext.addPyFile(out)
    if out in sys.path:  # the driver runs the package it imported
        sys.path.remove(out)
    _shipped.add(app)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with any column of ``df`` (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def col(df: DataFrame, name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def unit(c: Column) -> Column:
    """A 64-bit hash as a number in [0, 1)."""
    return F.shiftrightunsigned(c, 11).cast("double") * F.lit(2.0**-53)


def small_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", limit: int = 50_000, salts: int = 32) -> DataFrame:
    """Join a large side with a per-key table whose size is counted first.

    ``small`` (staged, one row per key) is broadcast when it has at most ``limit`` rows;
    beyond that it is repeated over ``salts`` and joined on the keys plus a salt, so that a
    key with a third of all rows meets in ``salts`` tasks.
    """
    if small.limit(limit + 1).count() <= limit:
        return big.join(F.broadcast(small), keys, how)
    salted = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = big.withColumn("__salt", F.pmod(F.xxhash64(*[c for c in big.columns]), F.lit(salts)).cast("int"))
    return rows.join(salted, [*keys, "__salt"], how).drop("__salt")


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, how: str = "inner", heavy: int = 4096) -> DataFrame:
    """Join rows with what is known of their group, however large a group is.

    ``groups`` has one row per ``key`` with the number of its rows in ``size``; ``total`` is
    the number of all rows.  Groups of at least ``total / heavy`` rows, of which there are
    ``heavy`` at most, are broadcast, so their rows stay where they are; all others meet by
    key.  Both tables are read twice and should be staged.
    """
    large = F.broadcast(groups.where(F.col(size) * heavy >= total))
    rest = rows.join(F.broadcast(large.select(key)), key, "left_anti").join(groups.where(F.col(size) * heavy < total), key, how)
    return rows.join(large, key).unionByName(rest)


def ranked(df: DataFrame, strata: list[str], key: str, order: list[str], cells: int, name: str = "rank") -> DataFrame:
    """Number the rows of every stratum from 0 in the order of a hash ``key``, in two levels.

    A stratum is cut into ``cells`` ranges of the hash; ranks inside a range are local and
    the ranges' offsets come from a table of counts.  No stratum is sorted in one task.
    ``df`` must be staged: it is read twice.
    """
    keyed = df.withColumn("__cell", F.floor(unit(F.col(key)) * cells))
    counts = keyed.groupBy(*strata, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*strata).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*strata, "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__ahead"))
    local = F.row_number().over(Window.partitionBy(*strata, "__cell").orderBy(key, *order))
    out = keyed.withColumn("__r", local).join(counts, [*strata, "__cell"])
    return out.withColumn(name, F.col("__ahead") + F.col("__r") - 1).drop("__cell", "__r", "__ahead")
