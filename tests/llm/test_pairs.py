"""Near duplicates, components and top-k search against brute force."""

import math
import random

from pyspark.sql import functions as F

from gridloom.llm import minhash, topk
from gridloom.llm.components import components


def near(rows, size, num, den):
    sets, parent = [], {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append((i, {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()))
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and i is not None and j is not None and den * len(a & b) >= num * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(a), root(i)) for i, a in sets}


def test_near_groups(docs, corpus, none):
    for size, num, den in ((3, 85, 100), (5, 80, 100)):
        want = near([(i, t) for i, t, _ in corpus if i is not None], size, num, den)
        got = minhash.near_groups(docs, size, num, den).collect()
        assert len(got) == len(corpus)
        for r in got:
            if r["doc_id"] is None:
                assert r["component_id"] is None and r["kept"]
            else:
                assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
                assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert minhash.near_groups(none).count() == 0 == minhash.drop_near_copies(none).count()


def test_chain_of_links_and_split_buckets(spark):
    """A varied group: many members of one bucket that are not all linked."""
    rng = random.Random(3)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    want = near(rows, 3, 85, 100)
    got = minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85, 100)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == want
    assert len({c for _, c in want.values()}) > 1


def test_drop_near_copies_keeps_columns(docs):
    left = minhash.drop_near_copies(docs)
    assert left.columns == docs.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert 5 in ids and not set(range(140, 170)) & set(ids)


def test_components_of_a_long_path(spark):
    n = 40
    links = spark.createDataFrame([(k, k + 1) for k in range(n)] + [(100, 101), (7, 7)], "u long, v long")
    got = {r["u"]: r["v"] for r in components(links).df.collect()}
    assert got == {k: 0 for k in range(1, n + 1)} | {101: 100}


def test_buckets_of_many_unrelated_members(monkeypatch, spark):
    """With few centres a round, whose number doubles."""
    monkeypatch.setattr(minhash, "CENTRES", 4)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    test_chain_of_links_and_split_buckets(spark)


def test_names_that_clash_are_carried(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 5, 6), (2, "a b c d e f", 7, 8)], "doc_id int, text string, kept_id int, __kept_id long")
    got = minhash.drop_near_copies(df)
    assert got.columns == df.columns and [r["doc_id"] for r in got.collect()] == [1]


def brute(rows, k):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in {i: a for i, a in sorted(good, key=lambda x: x[1], reverse=True) if i % 5 == 0}.items():
        best = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in good if c != q)[:k]
        out |= {(q, r, c, -s) for r, (s, c) in enumerate(best, 1)}
    return out


def test_top_k(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 420)]  # one vector many times: ties
    rows += [(420, None), (421, [1.0, None]), (422, [float("nan")] * 8), (423, [float("inf")] * 8), (None, [9.0] * 8), (425, []), (430, [0.5])]
    df = spark.createDataFrame([(i, v, 1, "z") for i, v in rows], "vec_id long, embedding array<double>, rank int, score string")
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k=5, pivots=6, rings=4, sample=200, block=32)
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == brute(rows, 5)
    assert topk.top_k(df.where("false"), F.lit(True)).count() == 0
    huge = [(i, [rng.choice([1e12, -1e9, 3.5, 1e300, 7e15, 0.25]) for _ in range(3)]) for i in range(60)]
    df2 = spark.createDataFrame(huge, "vec_id long, embedding array<double>")
    cut = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
    v = {i: [math.floor(256 * x) for x in e] for i, e in huge}
    want = set()
    for q in (i for i in v if i % 5 == 0):
        best = sorted((-cut(sum(x * y for x, y in zip(v[q], v[c]))), c) for c in v if c != q)[:5]
        want |= {(q, r, c, -s) for r, (s, c) in enumerate(best, 1)}
    assert {tuple(r) for r in topk.top_k(df2, F.col("vec_id") % 5 == 0, rings=3).collect()} == want
    assert topk.top_k(df.where("vec_id = 5"), F.lit(True)).count() == 0


SMALL_DRIVER = """
import sys
from pyspark.sql import SparkSession, functions as F
sys.path.insert(0, sys.argv[1])
from gridloom.llm import topk
conf = {"spark.driver.maxResultSize": "8m", "spark.sql.files.maxPartitionBytes": "1m", "spark.sql.files.openCostInBytes": "64k", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"}
spark = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
for i in (F.col("id"), F.lit(7)):  # the second: one id in all rows
    df = spark.range(0, 60000, 1, 8).select(i.cast("long").alias("vec_id"), F.array(*[F.xxhash64("id", F.lit(k)) % 1000 / 4096 for k in range(64)]).alias("embedding"))
    got = topk.top_k(df, F.col("vec_id") == 9, k=3).collect()
    assert len(got) == (3 if i._jc.toString() == "id" else 0), got
"""


def test_top_k_brings_no_rows_of_every_partition_to_the_driver():
    """Results of 8 MB at most a job; the sample has 2 MB, the least rows of all partitions about 30."""
    import subprocess
    import sys
    from pathlib import Path

    done = subprocess.run([sys.executable, "-c", SMALL_DRIVER, str(Path(topk.__file__).parents[2])], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


def test_sample_of_least_hashes(spark):
    rows = spark.range(0, 4000, 1, 16).select("id", F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"))
    want = {tuple(r["v"]) for r in rows.orderBy(F.xxhash64("id"), "id").limit(100).collect()}
    assert {tuple(v.as_py()) for v in topk.sampled(rows, 4000, 100)} == want
    assert len(topk.sampled(rows.withColumn("id", F.lit(7).cast("long")), 4000, 100)) == 100
