"""Every registered query against DuckDB on the smallest tables."""

import decimal
import numbers
from pathlib import Path

import duckdb
import pytest

from gridloom import plans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if v is None or v != v:
        return "-"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, numbers.Number | decimal.Decimal):
        return f"{round(float(v), 6):.6f}"
    if isinstance(v, list):
        return str([plain(x) for x in v])
    return str(v).removesuffix(" 00:00:00")


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    got = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    if name not in plans.ORACLES:
        assert got
        return
    rel = duck.sql(plans.ORACLES[name])
    assert sorted(rel.columns) == sorted(df.columns)
    at = [rel.columns.index(c) for c in sorted(df.columns)]
    want = sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())
    assert got == want


def test_pairs_fill_the_windows_of_the_reference(spark, tmp_path):
    """Against loops over scenes of two path/rows up to 700 days apart, some of one day."""
    import datetime as dt
    import itertools
    import random

    rng = random.Random(3)
    days = [rng.choice([0, 1, 4, 5, 29, 90, 91, 544, 545, 700]) for _ in range(70)]
    rows = [(i, i % 3 + 50 * (i % 2), dt.datetime(2020, 1, 1) + dt.timedelta(days=d, hours=i % 20), "view" if i % 4 else "click", 1.0, "{}") for i, d in enumerate(days)]
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    cloud = lambda i: i * 7 % 100
    pr = {r[0]: r[1] % 50 for r in rows}
    close = [(i, j, days[j] - days[i]) for i, j in itertools.permutations(range(70), 2) if pr[i] == pr[j] and (days[i], i) < (days[j], j)]
    window = [p for p in close if p[2] <= 544]
    fits = lambda p, nadir: all(cloud(i) <= 60 and (i % 11 != 0) == nadir for i in p[:2])
    run = lambda name: plans.QUERIES[name](spark, str(tmp_path)).collect()
    pairs = lambda name: sorted((r["scene1"], r["scene2"], r["gap"]) for r in run(name))
    want = sorted(p for p in window if fits(p, True))
    assert {0, 4, 5, 29, 544} <= {p[2] for p in want}
    assert pairs("window_interval_pairs") == want
    assert pairs("window_missing_pairs") == [p for p in want if (p[0] + p[1]) % 4]
    assert pairs("window_off_nadir_pairs") == sorted(p for p in window if fits(p, False))
    orbit = [p for p in close if 5 <= p[2] <= 90 and p[0] % 4 and p[1] % 4 and not (cloud(p[0]) < 50 and cloud(p[1]) < 50)]
    assert {r["pr"]: r["n"] for r in run("window_orbit_pairs")} == {k: sum(pr[p[0]] == k for p in orbit) for k in {pr[p[0]] for p in orbit}}
    for r in run("window_pair_statistics"):
        of = [p for p in window if pr[p[0]] == r["pr"]]
        same = sum(rows[p[0]][1] == rows[p[1]][1] for p in of)
        assert (r["n"], r["same"], r["crossed"], r["zero"], r["least"], r["most"]) == (len(of), same, len(of) - same, sum(cloud(p[0]) == 0 for p in of), min(p[2] for p in of), max(p[2] for p in of))


@pytest.fixture(scope="module")
def repeated(spark, tmp_path_factory):
    """Scenes of few path/rows and days, of which some repeat on other days, and nulls."""
    import datetime as dt
    import random

    rng = random.Random(7)
    at = lambda d: dt.datetime(2020, 1, 1) + dt.timedelta(days=d, hours=3)
    rows = [(i, rng.choice([1, 51, 2]), at(rng.choice([0, 1, 2, 3, 5, 6, 40, 700])), rng.choice(["view", "view", "click"])) for i in range(1, 90)]
    rows += [(i, u, at(rng.choice([0, 3, 4, 8, 45])), k) for i, u, _, k in rows[::4] + rows[::8]]
    rows += [(100, 3, at(d), "view") for d in (0, 2, 7)] + [(60, 4, at(0), "view"), (61, 4, at(5), "view")]
    rows += [(None, 1, at(4), "view"), (7, None, at(4), "view"), (8, 1, None, "view")]
    out = str(tmp_path_factory.mktemp("repeated"))
    spark.createDataFrame([(*r, 1.0, "{}") for r in rows], "event_id long, user_id long, ts timestamp_ntz, event_type string, value double, props string").write.parquet(f"{out}/events.parquet")
    return out


def as_oracle(spark, name, path):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{path}/events.parquet/*.parquet'")
    rel = con.sql(plans.ORACLES[name])
    df = plans.QUERIES[name](spark, path).select(*rel.columns)
    want = sorted(tuple(map(plain, r)) for r in rel.fetchall())
    assert want and sorted(tuple(map(plain, r)) for r in df.collect()) == want


def test_window_pairs_of_repeated_scenes(spark, repeated):
    as_oracle(spark, "window_interval_pairs", repeated)


def test_window_pairs_of_one_day_are_made_in_many_tasks(spark, tmp_path):
    import datetime as dt

    from pyspark.sql import functions as F

    rows = [(i, 50, dt.datetime(2020, 1, 1), "view", 1.0, "{}") for i in range(4000)]
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, event_type string, value double, props string").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    n = [r["count"] for r in plans.QUERIES["window_interval_pairs"](spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()]
    fits = sum(i * 7 % 100 <= 60 and i % 11 != 0 for i in range(4000))
    assert sum(n) == fits * (fits - 1) // 2 and max(n) < 0.6 * sum(n)


def test_interval_pairs_are_made_in_many_tasks(spark, repeated, tmp_path):
    import datetime as dt

    from pyspark.sql import functions as F

    as_oracle(spark, "interval_pairs", repeated)
    rows = [(i, 50, dt.datetime(2020, 1, 1 + i % 2), "view", 1.0, "{}") for i in range(4000)]
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, event_type string, value double, props string").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    n = [r["count"] for r in plans.QUERIES["interval_pairs"](spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()]
    fits = [sum(i * 7 % 100 <= 60 and i % 11 != 0 for i in range(k, 4000, 2)) for k in (0, 1)]
    assert sum(n) == fits[0] * fits[1] and max(n) < 0.6 * sum(n)


def test_lacking_pairs_of_repeated_scenes(spark, repeated):
    as_oracle(spark, "orbit_pairs", repeated)


def test_window_lacking_pairs_of_repeated_scenes(spark, repeated):
    as_oracle(spark, "window_orbit_pairs", repeated)


def test_pair_statistics_of_repeated_scenes(spark, repeated):
    as_oracle(spark, "pair_statistics", repeated)


def test_window_missing_pairs_are_not_joined_anew(spark, repeated):
    as_oracle(spark, "window_missing_pairs", repeated)
    assert "Anti" not in plans.QUERIES["window_missing_pairs"](spark, repeated)._jdf.queryExecution().toString()


def test_missing_pairs_are_not_joined_anew(spark, repeated):
    as_oracle(spark, "missing_pairs", repeated)
    assert "Anti" not in plans.QUERIES["missing_pairs"](spark, repeated)._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["interval_pairs", "window_interval_pairs", "window_missing_pairs"])
def test_what_is_shuffled_does_not_grow_with_pairs(spark, tmp_path, name):
    """Twice the scenes of a path/row make four times the pairs."""
    sc = spark.sparkContext._jsc.sc()

    def shuffled():
        sc.listenerBus().waitUntilEmpty()
        return sc.statusStore().executorSummary("driver").totalShuffleWrite()

    n, took = [], []
    for rows in (20000, 40000):
        path = str(tmp_path / str(rows))
        spark.range(rows).selectExpr("id as event_id", "50L as user_id", "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(int(id % 2)) as ts", "'view' as event_type", "1.0D as value", "'{}' as props").write.parquet(f"{path}/events.parquet")
        before = shuffled()
        n.append(plans.QUERIES[name](spark, path).count())
        took.append(shuffled() - before)
    assert n[1] > 3.9 * n[0] and 0 < took[1] < 3 * took[0], took
