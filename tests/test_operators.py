"""Numerics and semantics on synthetic cells with known answers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import dates, names, vectors
from gridloom.operators import catalog, fit, mosaic, robust


def series(n=200, amp=50.0, day=120.0, slope=0.0, level=500.0, noise=0.0, years=4, seed=0):
    rng = np.random.default_rng(seed)
    start = 2015 + np.sort(rng.uniform(0, years - 0.1, n))
    stop = start + rng.uniform(16, 64, n) / 365.25
    turn = 2 * math.pi
    p = turn * (day / 365.25)
    area = amp * (np.sin(turn * stop - p) - np.sin(turn * start - p)) / turn
    v = level + area / (stop - start) + slope * ((start + stop) / 2 - 2017) + rng.normal(0, noise, n) if noise else level + area / (stop - start) + slope * ((start + stop) / 2 - 2017)
    return start, stop, v, np.ones(n)


def test_constant_speed():
    got = fit.fit_series(*series(amp=0.0), 2017.0, (2015, 2018))
    assert np.allclose(got["mean"], 500) and got["amp"] < 1e-6 and abs(got["offset"] - 500) < 1e-6


def test_amplitude_and_phase():
    got = fit.fit_series(*series(noise=8.0), 2017.0, (2015, 2018))
    assert abs(got["amp"] - 50) < 3 and abs(got["phase"] - 120) < 5 and got["pairs"] >= 198


def test_trend():
    got = fit.fit_series(*series(amp=0.0, slope=10.0), 2017.0, (2015, 2018))
    assert abs(got["slope"] - 10) < 1.5


def test_outliers_are_dropped_and_few_points_give_nothing():
    s, e, v, r = series(noise=8.0)
    v[::20] += 5000
    got = fit.fit_series(s, e, v, r, 2017.0, (2015, 2018))
    assert got["pairs"] <= 190 and abs(got["amp"] - 50) < 3
    assert fit.fit_series(s[:4], e[:4], v[:4], r[:4], 2017.0, (2015, 2018)) is None
    assert fit.fit_series(s[:20], e[:20], v[:20], r[:20], 2017.0, (2015, 2018)) is None


def test_single_year_has_no_amplitude_error():
    s, e, v, r = series(years=1, n=80)
    got = fit.fit_series(s, e, v, r, 2015.5, (2015, 2015))
    assert got["amp_error"] is None and got["slope"] is None


def test_gram_agrees_with_least_squares():
    s, e, v, r = series(noise=1.0)
    m = fit.overlaps(s, e, np.arange(2015, 2020))
    m = m[:, m.sum(0) > 0]
    w, d = 1 / (r * (e - s)), v * (e - s)
    assert np.allclose(fit._solve(s, e, m, w, d)[0], fit.gram_solve(s, e, m, w, d), atol=1e-6)


def test_moving_median_mirrors_ends():
    v = np.arange(30.0)
    got = fit.moving_median(v)
    assert got[15] == 15 and got[0] == np.median(np.r_[v[6::-1], v[:8]])


@pytest.mark.parametrize("n, cut", [(47, False), (48, False), (49, True), (50, True)])
def test_reference_bin_needs_49(spark, n, cut):
    rows = [(1, "a", 20.0, 900.0 + i % 3) for i in range(n)] + [(1, "a", 3.0, 100.0 + i % 3) for i in range(10)]
    out = robust.dt_bin_filter(spark.createDataFrame(rows, "cell int, grp string, dt double, vp double"), ["cell"], "grp").first()
    assert out["ref_bin"] == (1 if cut else 0) and out["max_dt"] == (0 if cut else 16)


def test_edge_separation_survives(spark):
    rows = [(1, "a", 3.0, 100.0 + i % 3) for i in range(60)] + [(1, "a", 16.0, 500.0), (1, "a", 17.0, 500.0)]
    df = spark.createDataFrame(rows, "cell int, grp string, dt double, vp double")
    left = robust.apply_max_dt(df, robust.dt_bin_filter(df, ["cell"], "grp"), ["cell"], "grp")
    assert left.count() == 61 and left.agg(F.max("dt")).first()[0] == 16.0


def test_slow_cell_is_not_filtered(spark):
    rows = [(1, float(i % 40), 10.0 + i % 5, 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "cell int, dt double, vx double, vy double")
    flow = robust.flow_direction(df, ["cell"])
    assert flow.first()["slow"] and robust.projected(df, flow, ["cell"]).where("vp is not null").count() == 0


def test_newest_keeps_exact_ties(spark):
    df = spark.createDataFrame([("p", 1, 2, "a"), ("p", 1, 2, "b"), ("p", 1, 1, "c"), ("q", 0, 0, "d")], "id string, p1 int, p2 int, url string")
    once = catalog.newest(df, ["id"], ["p1", "p2"])
    assert sorted(r["url"] for r in once.collect()) == ["a", "b", "d"] == sorted(r["url"] for r in catalog.newest(once, ["id"], ["p1", "p2"]).collect())


def test_merge_ties_and_missing_counts(spark):
    df = spark.createDataFrame([(0, 0, 1, 5, 1.0), (0, 0, 2, 5, None), (1, 0, 1, None, 7.0), (1, 0, 2, None, 8.0)], "x int, y int, src int, n int, v double")
    got = {r["x"]: r for r in mosaic.merge_sources(df, ["x", "y"], ["v"], "n", "src").collect()}
    assert got[0]["source"] == 2 and got[0]["v"] is None and got[1]["source"] == 1 and got[1]["v"] == 7.0


def test_overlap_join_reports_each_pair_once(spark):
    boxes = spark.createDataFrame([(i, float(i), 0.0, i + 25.0, 25.0) for i in range(10)], "id int, x0 double, y0 double, x1 double, y1 double")
    j = catalog.overlap_join(boxes, boxes, 10.0)
    assert j.count() == 100 == j.select("id_a", "id_b").distinct().count()


def test_decimal_year_ends_at_the_last_second(spark):
    df = spark.sql("select timestamp_ntz'2019-12-31 23:59:59' t").select(dates.decimal_year(F.col("t")).alias("d"))
    assert df.first()["d"] == 2020.0


def test_unknown_satellite_fails(spark):
    with pytest.raises(Exception, match="unknown satellite"):
        spark.createDataFrame([("99",)], "s string").select(names.known_mission_group(F.col("s"))).collect()


def test_rotation_round_trip(spark):
    df = spark.createDataFrame([(0.7, 3.0, 40.0, 2.0, 200.0)], "t double, ax double, px double, ay double, py double")
    c = F.col
    (a1, p1), (a2, p2) = vectors.seasonal_rotated(c("t"), c("ax"), c("px"), c("ay"), c("py"))
    (b1, q1), (b2, q2) = vectors.seasonal_rotated(-c("t"), c("a1"), c("p1"), c("a2"), c("p2"))
    r = df.select("*", a1.alias("a1"), p1.alias("p1"), a2.alias("a2"), p2.alias("p2")).select("*", b1.alias("b1"), q1.alias("q1"), b2.alias("b2"), q2.alias("q2")).first()
    assert abs(r["b1"] - 3) < 1e-9 and abs(r["q1"] - 40) < 1e-6 and abs(r["b2"] - 2) < 1e-9 and abs(r["q2"] - 200) < 1e-6


def test_packing_rounds_half_to_even_and_fills(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (None,), (1e9,)], "v double")
    assert [r[0] for r in df.select(vectors.packed(F.col("v"), "short")).collect()] == [0, 2, -32767, 32767]


def test_cells_on_an_edge_are_outside(spark):
    from gridloom.functions import grids

    ring = F.array(*[F.array(F.lit(float(a)), F.lit(float(b))) for a, b in ((0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4), (0, 0))])
    cells = spark.createDataFrame([(float(x), float(y)) for x in range(-1, 6) for y in range(-1, 6)], "x double, y double")
    got = {(r["x"], r["y"]) for r in cells.where(grids.in_polygon(F.col("x"), F.col("y"), ring)).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (1, 2), (1, 3)}


def test_projections_of_known_points(spark):
    """Central meridians, the pole and the length of the meridian arc to 45 degrees."""
    from gridloom.functions import grids

    one = spark.range(1)
    x, y = grids.utm_forward(F.lit(3.0), F.lit(45.0), F.lit(31), F.lit(False))
    x0, y0 = grids.utm_forward(F.lit(3.0), F.lit(0.0), F.lit(31), F.lit(False))
    px, py = grids.polar_forward(F.lit(-45.0), F.lit(70.0), 70.0, -45.0)
    ex, ey = grids.polar_forward(F.lit(45.0), F.lit(70.0), 70.0, -45.0)
    got = one.select(*[c.cast("double").alias(f"c{i}") for i, c in enumerate((x, y, x0, y0, px, py, ex, ey))]).first()
    rho = 6378137 * math.cos(math.radians(70)) / math.sqrt(1 - 0.00669437999014 * math.sin(math.radians(70)) ** 2)  # radius of the parallel of true scale
    want = (500000, 0.9996 * 4984944.378, 500000, 0, 0, -rho, rho, 0)
    assert all(abs(a - b) < 0.01 for a, b in zip(got, want))


def test_small_groups_are_left_out_and_boxes_crop(spark):
    from gridloom.operators import quality

    df = spark.createDataFrame([(k, i, i % 4, float(i) if 3 <= i <= 6 else None) for k in (1, 2) for i in range(10 if k == 1 else 5)], "k int, x int, y int, v double")
    assert {r["k"] for r in robust.enough(df, ["k"], 6).collect()} == {1}
    got = sorted((r["k"], r["x"], r["y"]) for r in quality.crop_to_valid(df, ["k"], "v").collect())
    assert got == [(1, 3, 3), (1, 4, 0), (1, 5, 1), (1, 6, 2), (2, 3, 3), (2, 4, 0)]
