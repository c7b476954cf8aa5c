"""The composite as one plan against its steps by hand."""

import math

import numpy as np
from pyspark.sql import functions as F

from gridloom.operators import composite, fit

SCHEMA = "cell int, grp string, dt double, day double, start double, stop double, vx double, vy double, err double"


def series(cell, grp, n, seed, speed=300.0, season=0.0, low=0.0):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        start, dt = 2015 + 3.9 * rng.random(), float(rng.choice([8, 12, 24, 40]))
        stop = start + dt / 365.25
        mid = (start + stop) / 2
        v = speed + season * math.sin(2 * math.pi * mid) + rng.normal(0, 1) - low
        out.append((cell, grp, dt, (mid - 2015) * 365.25, start, stop, 0.8 * v, 0.6 * v, 1.0 + float(rng.random())))
    return out


def rows():
    out = series(0, "N", 300, 1) + series(0, "A", 300, 2) + series(0, "B", 300, 3, low=80)  # B reads too low
    out += series(1, "N", 300, 4) + series(1, "B", 300, 5, low=80)  # likewise, but inland
    out += series(2, "N", 300, 6, season=200) + series(2, "A", 300, 7)  # the reference group inflates the amplitude
    out += series(3, "N", 200, 8, speed=20)  # slow
    out += series(4, "N", 4, 9)  # too few
    out += [(0, "N", 8.0, 10.0, 2015.1, 2015.2, None, None, 1.0), (1, "N", 8.0, 10.0, 2015.1, 2015.2, 30000.0, 0.0, 1.0)]
    return out


def by_hand(part):
    x, y = (fit.fit_series(*(np.array([r[c] for r in part], float) for c in ("start", "stop", v, "err")), 2017.0, (2015, 2018)) for v in ("vx", "vy"))
    f = np.array([x["offset"], y["offset"]]) / math.hypot(x["offset"], y["offset"])
    wave = sum(k * p["amp"] * np.exp(2j * math.pi * p["phase"] / 365.25) for k, p in zip(f, (x, y)))
    return x, y, math.hypot(x["offset"], y["offset"]), f @ [x["slope"], y["slope"]], abs(wave)


def test_composite(spark):
    obs = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    inland = F.col("cell") == 1
    left, groups = composite.filtered(obs, inland, "N")
    left, groups = left.collect(), {(r["cell"], r["grp"]): r for r in groups.collect()}
    assert [k for k, r in groups.items() if not r["include"]] == [(0, "B")]
    assert not [r for r in left if (r["cell"], r["grp"]) == (0, "B")] and [r for r in left if (r["cell"], r["grp"]) == (1, "B")]
    assert len([r for r in left if r["cell"] == 3]) == 200 and max(math.hypot(r["vx"], r["vy"]) for r in left) < 20000
    got = {r["cell"]: r for r in composite.composite(obs, inland, "N", 2017.0, (2015, 2018)).collect()}
    assert sorted(got) == [0, 1, 2, 3]
    assert got[2]["replaced"] and not got[0]["replaced"]
    for k, r in got.items():
        part = sorted((x for x in left if x["cell"] == k), key=lambda x: (x["start"], x["stop"]))
        first, rest = by_hand(part), [x for x in part if x["grp"] != "N"]
        second = by_hand(rest) if rest else None
        assert r["replaced"] == bool(second and first[4] > 2 * second[4] and first[4] - second[4] > 2)
        x, y, v0, trend, amp = second if r["replaced"] else first
        assert np.allclose([r["v0"], r["dv_dt"], r["amp"]], [v0, trend, amp], rtol=1e-6, atol=1e-6)
        assert r["years"] == list(x["years"]) and np.allclose(r["v"], np.hypot(x["mean"], y["mean"]))
        assert r["n"] == [math.ceil((a + b) / 2) for a, b in zip(x["n"], y["n"])] and r["pairs"] == math.ceil((x["pairs"] + y["pairs"]) / 2)
        seen = [o for o in rows() if o[0] == k and o[6] is not None]
        assert math.isclose(r["outlier_percent"], 100 * (1 - r["pairs"] / len(seen)), abs_tol=1e-9)
    assert got[2]["amp"] < 5 and {g["grp"]: g["include"] for g in got[0]["groups"]} == {"A": 1, "B": 0, "N": 1}
    assert composite.composite(obs.where("false"), inland, "N", 2017.0, (2015, 2018)).count() == 0
