"""The composite of a cube as one plan.

Sensor exclusion, median flow, time-separation filter and speed limit are filters over the
observations; both velocity components are then fitted, with and without the reference
group, in one grouped kernel (one shuffle of the observations by cell), and all that follows
is expressions on one row per cell.

Defined cases: observations without a velocity take no part; an excluded group enters
neither the median flow nor the fits and is reported with ``include`` 0; a slow cell skips
the time filter and keeps its rows; cells with too few observations give no row; an empty
table gives none.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors
from . import fit, robust

# Fixed values of the composite.
SPEED_LIMIT, AMPLITUDE_LIMIT = 20000.0, 10000.0


def filtered(obs: DataFrame, inland: Column, reference: str, cell: str = "cell", group: str = "grp", speed_limit: float = SPEED_LIMIT) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all filters, and per (cell, group) n_all, include, max_dt.

    ``inland`` marks cells where no group is excluded.  Reads vx, vy, dt and day.
    """
    by = [cell, group]
    bad = robust.disagreeing_groups(obs, [cell], group, reference).where(F.col("excluded") & ~inland).select(*by)
    kept = obs.join(bad, by, "left_anti")
    along = robust.projected(kept, robust.flow_direction(kept, [cell]), [cell])
    limits = robust.dt_bin_filter(along, [cell], group)
    rows = robust.apply_max_dt(along, limits, [cell], group).where(F.hypot("vx", "vy") <= speed_limit)
    groups = obs.groupBy(*by).agg(F.count(F.lit(1)).alias("n_all")).join(bad.withColumn("include", F.lit(0)), by, "left").join(limits.select(*by, "max_dt"), by, "left")
    return rows, groups.select(*by, "n_all", F.coalesce("include", F.lit(1)).alias("include"), "max_dt")


TERMS = ("offset", "slope", "se", "amp", "amp_error", "phase", "pairs")
FITS = "whole boolean, years array<int>, vx array<double>, vy array<double>, ex array<double>, ey array<double>, nx array<double>, ny array<double>, " + ", ".join(f"{k}_{a} double" for a in "xy" for k in TERMS)


def fit_components(rows: DataFrame, reference: str, centre: float, climate: tuple[int, int], cell: str = "cell", group: str = "grp") -> DataFrame:
    """Fits of both components per cell: of all rows (``whole``) and of those outside the
    reference group.  Annual means are given for the years that both components have."""
    used = rows.select(cell, (F.col(group) == reference).alias("reference"), "start", "stop", "vx", "vy", "err")
    used = used.join(used.groupBy(cell).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= fit.MIN_BEFORE).select(cell), cell, "left_semi")

    def kernel(k: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["start", "stop", "vx", "vy", "err"])
        out = []
        for whole, part in ((True, g), (False, g[~g["reference"]])):
            x, y = (fit.fit_series(*(part[c].to_numpy(float) for c in ("start", "stop", v, "err")), centre, climate) for v in ("vx", "vy"))
            if x is None or y is None:
                continue
            years, i, j = np.intersect1d(x["years"], y["years"], return_indices=True)
            row = {cell: k[0], "whole": whole, "years": years.tolist()}
            for a, f, at in (("x", x, i), ("y", y, j)):
                row |= {f"v{a}": f["mean"][at].tolist(), f"e{a}": f["error"][at].tolist(), f"n{a}": f["n"][at].astype(float).tolist()}
                row |= {f"{t}_{a}": None if f[t] is None else float(f[t]) for t in TERMS}
            out.append(row)
        return pd.DataFrame(out)

    kind = rows.select(cell).schema.fields[0].simpleString().replace(":", " ")
    return used.groupBy(cell).applyInPandas(kernel, f"{kind}, {FITS}")


def composite(obs: DataFrame, inland: Column, reference: str, centre: float, climate: tuple[int, int], cell: str = "cell", group: str = "grp", speed_limit: float = SPEED_LIMIT) -> DataFrame:
    """One row per cell that can be fitted: annual speeds with errors and counts, speed at
    the centre, trend, seasonal signal along the flow, share of outliers, whether the fit
    without the reference group replaced the first, and the groups' include and max_dt."""
    c = F.col
    rows, groups = filtered(obs, inland, reference, cell, group, speed_limit)
    fits = fit_components(rows, reference, centre, climate, cell, group)
    each = F.arrays_zip("vx", "vy", "ex", "ey", "nx", "ny")
    amp, phase = vectors.seasonal_along(c("offset_x"), c("offset_y"), c("amp_x"), c("phase_x"), c("amp_y"), c("phase_y"))
    result = F.struct(
        "years",
        F.transform(each, lambda r: vectors.magnitude(r["vx"], r["vy"])).alias("v"),
        F.transform(each, lambda r: vectors.magnitude_error(r["vx"], r["vy"], r["ex"], r["ey"])).alias("v_error"),
        F.transform(each, lambda r: vectors.mean_count(r["nx"], r["ny"])).alias("n"),
        vectors.magnitude(c("offset_x"), c("offset_y")).alias("v0"),
        vectors.magnitude_error(c("offset_x"), c("offset_y"), c("se_x"), c("se_y")).alias("v0_error"),
        vectors.along(c("slope_x"), c("slope_y"), c("offset_x"), c("offset_y")).alias("dv_dt"),
        amp.alias("amp"),
        phase.alias("phase"),
        vectors.along_abs(c("amp_error_x"), c("amp_error_y"), c("offset_x"), c("offset_y")).alias("amp_error"),
        vectors.mean_count(c("pairs_x"), c("pairs_y")).cast("long").alias("pairs"),
    )
    both = fits.select(cell, "whole", result.alias("r")).groupBy(cell).agg(F.max(F.when(c("whole"), c("r"))).alias("a"), F.max(F.when(~c("whole"), c("r"))).alias("b"))
    both = both.where("a is not null").withColumn("r", fit.prefer_second(c("a"), c("b")))
    mid = (c("start") + c("stop")) / 2
    before = obs.where((mid >= climate[0]) & (mid < climate[1] + 1)).groupBy(cell).agg(F.count("vx").alias("n_window"))
    of_group = groups.groupBy(cell).agg(F.array_sort(F.collect_list(F.struct(group, "include", "max_dt"))).alias("groups"))  # one entry per sensor group
    out = both.join(before, cell, "left").join(of_group, cell)
    within = lambda name: F.when(c("r.amp") <= AMPLITUDE_LIMIT, c(f"r.{name}")).alias(name)
    plain = [c(f"r.{k}").alias(k) for k in ("years", "v", "v_error", "n", "v0", "v0_error", "dv_dt")]
    return out.select(cell, *plain, within("amp"), within("amp_error"), within("phase"), c("r.pairs").alias("pairs"), fit.outlier_percent(c("r.pairs"), c("n_window")).alias("outlier_percent"), (~c("r").eqNullSafe(c("a"))).alias("replaced"), "groups")
