"""Annual and seasonal models per cell.

Overlap of a pair with a year, per-year counts and formal errors, and the weighted line are
column expressions and sums.  The harmonic fit is a grouped kernel: it needs a cell's whole
series, sorted, and a least-squares solution; it gets only the six columns it uses.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the fit.
MEDIAN_POINTS, SIGMA, SIGMA_STEP, ATTEMPTS = 15, 2.0, 0.05, 10
MAD_TIMES, MAD_TO_STD = 6.0, 1.4826
MIN_BEFORE, MIN_AFTER = 5, 30
YEAR_DAYS = 365.25


def year_overlap(start: Column, stop: Column, year: Column) -> Column:
    """Part of the year that a pair spans, in years."""
    return F.greatest(F.lit(0.0), F.least(stop, year + 1.0) - F.greatest(start, year.cast("double")))


def years_of(df: DataFrame, start: str = "start", stop: str = "stop") -> DataFrame:
    """One row per pair and year touched, with the overlap."""
    year = F.explode(F.sequence(F.floor(start).cast("int"), F.floor(stop).cast("int")))
    out = df.withColumn("year", year)
    return out.withColumn("overlap", year_overlap(F.col(start), F.col(stop), F.col("year"))).where("overlap > 0")


def annual_counts(df: DataFrame, keys: list[str], error: str = "err") -> DataFrame:
    """Pairs that touch each year, and the formal error of its mean."""
    rows = years_of(df)
    return rows.groupBy(*keys, "year").agg(F.count(F.lit(1)).alias("n"), (1 / F.sqrt(F.sum(F.col("overlap") / (F.col(error) * F.col(error))))).alias("err"))


def weighted_std(value: Column, weight: Column) -> Column:
    """Population standard deviation with weights, from sums."""
    s0, s1, s2 = F.sum(weight), F.sum(weight * value), F.sum(weight * value * value)
    return F.sqrt(F.greatest(s2 / s0 - (s1 / s0) * (s1 / s0), F.lit(0.0)))


def weighted_line(df: DataFrame, keys: list[str], t: str = "t", value: str = "v", error: str = "err") -> DataFrame:
    """Offset and slope about ``t = 0`` with weights 1/err^2; a weighted mean without slope
    where all estimates lie on one side; error sqrt(sum err^2)/(n-1), null for one."""
    rows = df.where(F.col(value).isNotNull() & F.col(error).isNotNull())
    w, x, y = 1 / (F.col(error) * F.col(error)), F.col(t), F.col(value)
    s = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(w).alias("sw"),
        F.sum(w * x).alias("sx"),
        F.sum(w * y).alias("sy"),
        F.sum(w * x * x).alias("sxx"),
        F.sum(w * x * y).alias("sxy"),
        F.sum(F.col(error) * F.col(error)).alias("see"),
        (F.count_if(x < 0) > 0).alias("before"),
        (F.count_if(x >= 0) > 0).alias("after"),
    )
    det = F.nullif(F.col("sw") * F.col("sxx") - F.col("sx") * F.col("sx"), F.lit(0.0))
    both = F.col("before") & F.col("after")
    offset = F.when(both, (F.col("sxx") * F.col("sy") - F.col("sx") * F.col("sxy")) / det).otherwise(F.col("sy") / F.col("sw"))
    slope = F.when(both, (F.col("sw") * F.col("sxy") - F.col("sx") * F.col("sy")) / det)
    return s.select(*keys, "n", offset.alias("offset"), slope.alias("slope"), (F.sqrt("see") / F.nullif(F.col("n") - 1, F.lit(0))).alias("error"))


def moving_median(v: np.ndarray, points: int = MEDIAN_POINTS) -> np.ndarray:
    """Centred median whose ends see the series mirrored, end values repeated."""
    half = points // 2
    padded = np.pad(v, half, "symmetric") if len(v) >= half else np.pad(v, half, "symmetric" if len(v) else "constant")
    return np.median(np.lib.stride_tricks.sliding_window_view(padded, points), axis=1)


def overlaps(start: np.ndarray, stop: np.ndarray, years: np.ndarray) -> np.ndarray:
    return np.clip(np.minimum(stop[:, None], years + 1.0) - np.maximum(start[:, None], years), 0, 1)


def _solve(start: np.ndarray, stop: np.ndarray, m: np.ndarray, w: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    turn = 2 * math.pi
    design = np.column_stack(((np.cos(turn * start) - np.cos(turn * stop)) / turn, (np.sin(turn * stop) - np.sin(turn * start)) / turn, m))
    p = np.linalg.lstsq(design * w[:, None], w * d, rcond=None)[0]
    return p, design @ p


def gram_solve(start: np.ndarray, stop: np.ndarray, m: np.ndarray, w: np.ndarray, d: np.ndarray) -> np.ndarray:
    """The same parameters from normal equations, whose sums combine map-side."""
    turn = 2 * math.pi
    design = np.column_stack(((np.cos(turn * start) - np.cos(turn * stop)) / turn, (np.sin(turn * stop) - np.sin(turn * start)) / turn, m))
    weighted = design * (w * w)[:, None]
    return np.linalg.solve(weighted.T @ design, weighted.T @ d)


def fit_series(start: np.ndarray, stop: np.ndarray, v: np.ndarray, err: np.ndarray, centre: float, climate: tuple[int, int]) -> dict | None:
    """Annual means and climatology of one series; None where too little is left."""
    ok = np.isfinite(v) & np.isfinite(err) & (err > 0) & (stop > start)
    start, stop, v, err = start[ok], stop[ok], v[ok], err[ok]
    if len(v) < MIN_BEFORE:
        return None
    order = np.argsort((start + stop) / 2, kind="stable")
    start, stop, v, err = start[order], stop[order], v[order], err[order]
    residual = np.abs(v - moving_median(v))
    spread = np.median(residual) * MAD_TO_STD
    for attempt in range(ATTEMPTS):
        kept = ~(residual > (SIGMA + attempt * SIGMA_STEP) * MAD_TIMES * spread)
        if kept.sum() < MIN_AFTER:
            return None
        s, e, x, er = start[kept], stop[kept], v[kept], err[kept]
        years = np.arange(math.floor(s.min()), math.floor(e.max()) + 1)
        m = overlaps(s, e, years)
        has = m.sum(0) > 0
        years, m = years[has], m[:, has]
        dt = e - s
        w, d = 1 / (er * dt), x * dt
        try:
            p, _ = _solve(s, e, m, w, d)
            break
        except np.linalg.LinAlgError:
            continue
    else:
        return None
    mean, n = p[2:], (m > 0).sum(0)
    error = 1 / np.sqrt(((1 / er**2) @ m))
    out = {"years": years, "mean": mean, "error": error, "n": n, "offset": None, "slope": None, "se": None, "amp": None, "amp_error": None, "phase": None, "pairs": None}
    inside = (years >= climate[0]) & (years <= climate[1])
    if inside.any():
        out["offset"], out["slope"], out["se"] = line(years[inside] + 0.5 - centre, mean[inside], error[inside])
    mid = (s + e) / 2
    in_window = (mid >= climate[0]) & (mid < climate[1] + 1)
    if in_window.any():
        s, e, w, d, dt, m = s[in_window], e[in_window], w[in_window], d[in_window], dt[in_window], m[in_window]
        has = m.sum(0) > 0
        m = m[:, has]
        p, model = _solve(s, e, m, w, d)
        out["pairs"], out["amp"] = len(d), math.hypot(p[0], p[1])
        out["phase"] = YEAR_DAYS * ((0.25 - math.atan2(p[1], p[0]) / (2 * math.pi)) % 1)
        parts = []
        for k in range(m.shape[1]):
            at = m[:, k] > 0
            r, wk = (d - model)[at], w[at]
            avg = np.average(r, weights=wk)
            parts.append(math.sqrt(np.average((r - avg) ** 2, weights=wk)) / ((wk * dt[at]).sum() / wk.sum()))
        if m.shape[1] > 1:
            out["amp_error"] = math.sqrt(sum(x * x for x in parts)) / (m.shape[1] - 1)
    return out


def line(t: np.ndarray, v: np.ndarray, err: np.ndarray) -> tuple[float, float | None, float | None]:
    w = 1 / err**2
    se = math.sqrt((err**2).sum()) / (len(v) - 1) if len(v) > 1 else None
    if not ((t < 0).any() and (t >= 0).any()):
        return float((w * v).sum() / w.sum()), None, se
    root = np.sqrt(w / w.mean())
    offset, slope = np.linalg.lstsq(np.column_stack((root, root * t)), root * v, rcond=None)[0]
    return float(offset), float(slope), se


FIT_SCHEMA = "years array<int>, mean array<double>, error array<double>, n array<long>, offset double, slope double, se double, amp double, amp_error double, phase double, pairs long, n_all long"


def harmonic_fit(df: DataFrame, key: str, centre: float, climate: tuple[int, int], start: str = "start", stop: str = "stop", value: str = "v", error: str = "err") -> DataFrame:
    """One row per cell that can be fitted.  Cells below the minimum never reach the kernel."""
    rows = df.select(key, F.col(start).alias("s"), F.col(stop).alias("e"), F.col(value).alias("v"), F.col(error).alias("r")).where("v is not null and r is not null")
    rows = rows.join(rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= MIN_BEFORE).select(key), key, "left_semi")

    def kernel(k: tuple, g: pd.DataFrame) -> pd.DataFrame:
        got = fit_series(*(g[c].to_numpy(float) for c in "sevr"), centre, climate)
        if got is None:
            return pd.DataFrame()
        mid = (g["s"] + g["e"]) / 2
        n_all = int(((mid >= climate[0]) & (mid < climate[1] + 1)).sum())
        got = {c: [x.tolist() if isinstance(x, np.ndarray) else x] for c, x in got.items()}
        return pd.DataFrame({key: [k[0]], **got, "n_all": [n_all]})

    return rows.groupBy(key).applyInPandas(kernel, f"{df.select(key).schema.fields[0].simpleString().replace(':', ' ')}, {FIT_SCHEMA}")


def outlier_percent(pairs: Column, n_all: Column) -> Column:
    """Share of observations removed before the fit; a negative share fails the query."""
    share = 100 * (1 - pairs / F.nullif(n_all, F.lit(0)))
    return F.when(share < 0, F.raise_error(F.lit("negative outlier share")).cast("double")).otherwise(share)


def prefer_second(first: Column, second: Column, ratio: float = 2.0, least: float = 2.0) -> Column:
    """The fit without the reference group replaces the first where the first's amplitude is
    more than ``ratio`` times larger and differs by more than ``least``."""
    better = (first["amp"] > ratio * second["amp"]) & (first["amp"] - second["amp"] > least)
    return F.when(F.coalesce(better, F.lit(False)), second).otherwise(first)
