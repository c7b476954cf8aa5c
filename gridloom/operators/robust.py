"""Robust per-cell statistics and filters.

Everything groups by the cell first, so consecutive steps reuse one partitioning; a frequent
cell is spread by adding its group and bin to the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed values of the filters.
EDGES = (0, 16, 32, 64, 128, 256)
MIN_FLOW_OBS = 50  # observations that fix the median flow
MIN_REFERENCE_OBS = 49  # observations of a reference bin (a count one above is compared with 50)
MAD_TO_STD, BOUND = 1.4826, 0.67
SLOW = 50.0
SENSOR_BIN_DAYS, SENSOR_MIN, SENSOR_BINS, SENSOR_MAX_DT, SENSOR_SE = 73, 3, 3, 64, 3.0


def median_mad(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Median and median absolute deviation per key: the medians are grouped (a median is
    held as counts of distinct values, combined before the exchange) and joined back."""
    rows = df.where(F.col(value).isNotNull())
    centred = rows.join(rows.groupBy(*keys).agg(F.median(value).alias("__med")), keys)
    return centred.groupBy(*keys).agg(F.max("__med").alias("median"), F.median(F.abs(F.col(value) - F.col("__med"))).alias("mad"), F.count(F.lit(1)).alias("n"))


def dt_bin(dt: Column) -> Column:
    """Index of the left-closed bin; the last is open."""
    out = F.lit(len(EDGES) - 1)
    for k in range(len(EDGES) - 1, 0, -1):
        out = F.when(dt < EDGES[k], k - 1).otherwise(out)
    return out


def flow_direction(df: DataFrame, keys: list[str], vx: str = "vx", vy: str = "vy", dt: str = "dt") -> DataFrame:
    """Per cell the median flow: medians over the smallest time cap that has enough
    observations, else over all; ``slow`` where the speed switches the filter off.

    The caps come from counts, which combine before the exchange; only rows within a cell's
    cap go on to its medians."""
    valid = df.where(F.col(vx).isNotNull())
    counts = valid.groupBy(*keys).agg(*[F.count_if(F.col(dt) <= edge).alias(f"__n{edge}") for edge in EDGES[1:]])
    cap = F.lit(float("inf"))
    for edge in reversed(EDGES[1:]):
        cap = F.when(F.col(f"__n{edge}") >= MIN_FLOW_OBS, F.lit(float(edge))).otherwise(cap)
    used = valid.join(counts.select(*keys, cap.alias("__cap")), keys).where(F.col(dt) <= F.col("__cap"))
    out = used.groupBy(*keys).agg(F.max("__cap").alias("dt_cap"), F.count(F.lit(1)).alias("n_flow"), F.median(vx).alias("vx0"), F.median(vy).alias("vy0"))
    return out.withColumn("v0", F.hypot("vx0", "vy0")).withColumn("slow", F.col("v0") <= SLOW)


def projected(df: DataFrame, flow: DataFrame, keys: list[str], vx: str = "vx", vy: str = "vy") -> DataFrame:
    """Velocity along the median flow of the cell (null in slow cells)."""
    f = flow.select(*keys, "vx0", "vy0", "v0", "slow")
    vp = F.when(~F.col("slow"), (F.col(vx) * F.col("vx0") + F.col(vy) * F.col("vy0")) / F.col("v0"))
    return df.join(f, keys).withColumn("vp", vp).drop("vx0", "vy0", "v0")


def dt_bin_filter(df: DataFrame, keys: list[str], group: str, value: str = "vp", dt: str = "dt") -> DataFrame:
    """Largest usable time separation per (cell, group); null where nothing is cut.

    Bins whose bounds (median +- 0.67 * 1.4826 * MAD) miss those of the reference bin cut at
    their left edge.  The reference is the first bin with enough observations, else the
    first whose upper bound is not zero.
    """
    by = [*keys, group]
    binned = df.where(F.col(value).isNotNull()).withColumn("bin", dt_bin(F.col(dt)))
    stats = median_mad(binned, [*by, "bin"], value)
    half = F.col("mad") * (BOUND * MAD_TO_STD)
    stats = stats.withColumn("lo", F.col("median") - half).withColumn("hi", F.col("median") + half)
    w = W.partitionBy(*by)
    ref = F.coalesce(F.min(F.when(F.col("n") >= MIN_REFERENCE_OBS, F.col("bin"))).over(w), F.min(F.when(F.col("hi") != 0, F.col("bin"))).over(w))
    stats = stats.withColumn("ref", ref)
    at_ref = F.col("bin") == F.col("ref")
    stats = stats.withColumn("ref_lo", F.max(F.when(at_ref, F.col("lo"))).over(w)).withColumn("ref_hi", F.max(F.when(at_ref, F.col("hi"))).over(w))
    edge = F.element_at(F.array(*[F.lit(e) for e in EDGES]), F.col("bin") + 1)
    cut = (F.col("lo") > F.col("ref_hi")) | (F.col("hi") < F.col("ref_lo"))
    return stats.groupBy(*by).agg(F.sum("n").alias("n_obs"), F.max("ref").alias("ref_bin"), F.min(F.when(cut, edge)).alias("max_dt"))


def apply_max_dt(df: DataFrame, limits: DataFrame, keys: list[str], group: str, dt: str = "dt") -> DataFrame:
    """Drops observations above the limit; one at the limit stays, and so do those of cells
    without one (slow cells skip the filter)."""
    return df.join(limits.select(*keys, group, "max_dt"), [*keys, group], "left").where(F.col("max_dt").isNull() | (F.col(dt) <= F.col("max_dt")))


def disagreeing_groups(df: DataFrame, keys: list[str], group: str, reference: str, day: str = "day", vx: str = "vx", vy: str = "vy", dt: str = "dt") -> DataFrame:
    """Groups that stay below the reference group over shared time bins.

    Short separations only; velocities along each group's own mean flow, averaged in 73-day
    bins of at least three; compared where more than three bins are shared; excluded if the
    mean difference plus three standard errors is negative.
    """
    by = [*keys, group]
    short = df.where((F.col(dt) <= SENSOR_MAX_DT) & F.col(vx).isNotNull())
    w = W.partitionBy(*by)
    mx, my = F.avg(vx).over(w), F.avg(vy).over(w)
    short = short.withColumn("__mx", mx).withColumn("__my", my)
    short = short.withColumn("vp", (F.col(vx) * F.col("__mx") + F.col(vy) * F.col("__my")) / F.hypot("__mx", "__my")).withColumn("bin", F.floor(F.col(day) / SENSOR_BIN_DAYS))
    bins = short.groupBy(*by, "bin").agg(F.avg("vp").alias("m"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= SENSOR_MIN)
    ref = F.max(F.when(F.col(group) == reference, F.col("m"))).over(W.partitionBy(*keys, "bin"))
    delta = bins.withColumn("delta", F.col("m") - ref).where((F.col(group) != reference) & F.col("delta").isNotNull())
    out = delta.groupBy(*by).agg(F.count(F.lit(1)).alias("bins"), F.avg("delta").alias("mean_delta"), F.stddev_pop("delta").alias("sd")).where(F.col("bins") > SENSOR_BINS)
    out = out.withColumn("se", F.col("sd") / F.sqrt(F.col("bins") - 1))
    return out.withColumn("excluded", F.col("mean_delta") + SENSOR_SE * F.col("se") < 0).drop("sd")


def without_groups(df: DataFrame, excluded: DataFrame, keys: list[str], group: str) -> DataFrame:
    return df.join(excluded.where("excluded").select(*keys, group), [*keys, group], "left_anti")


def stable_shift(df: DataFrame, threshold: Column, sx: Column, sy: Column, dt: Column, flag: Column) -> DataFrame:
    """Above the mission's threshold: flag 1 drops a layer, flag 2 adds its shift back."""
    sx, sy = F.coalesce(sx, F.lit(0.0)), F.coalesce(sy, F.lit(0.0))
    big = F.greatest(F.abs(sx), F.abs(sy)) * dt / 365.25 > threshold
    return df.withColumn("keep", ~(big & (flag == 1))).withColumn("add_x", F.when(big & (flag == 2), sx).otherwise(0.0)).withColumn("add_y", F.when(big & (flag == 2), sy).otherwise(0.0))


def enough(df: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Rows of cells with at least ``least`` observations: counted groups joined back, so no
    cell's rows are buffered."""
    return df.join(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= least).select(*keys), keys, "left_semi")


def calibrated_shift(df: DataFrame, keys: list[str], value: str, ref: str, stable: str) -> DataFrame:
    """Shift against a reference field: over the stable surface, else over the slowest
    quarter; with its spread and which surface was used (1, 2, 0: none)."""
    quarter = df.groupBy(*keys).agg(F.percentile(F.abs(ref), F.lit(0.25)).alias("__q"))
    rows = df.join(quarter, keys).withColumn("__slow", F.abs(ref) <= F.col("__q")).withColumn("__d", F.col(value) - F.col(ref))
    on = lambda f, c: f(F.when(c, F.col("__d")))
    out = rows.groupBy(*keys).agg(
        F.count_if(F.col(stable) & F.col("__d").isNotNull()).alias("n_stable"),
        F.count_if(F.col("__slow") & F.col("__d").isNotNull()).alias("n_slow"),
        on(F.median, F.col(stable)).alias("s1"),
        on(F.median, F.col("__slow")).alias("s2"),
        on(F.stddev_pop, F.col(stable)).alias("e1"),
        on(F.stddev_pop, F.col("__slow")).alias("e2"),
    )
    flag = F.when(F.col("n_stable") > 0, 1).when(F.col("n_slow") > 0, 2).otherwise(0)
    pick = lambda a, b: F.round(F.when(flag == 1, a).when(flag == 2, b).otherwise(0.0), 1)
    return out.select(*keys, "n_stable", "n_slow", pick(F.col("s1"), F.col("s2")).alias("shift"), pick(F.col("e1"), F.col("e2")).alias("error"), flag.alias("flag"))
