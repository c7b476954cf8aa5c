"""Exact top-k inner-product search over a pivot-distance index.

Largest inner product is turned into nearest neighbour: a candidate ``c`` gets one more
component ``sqrt(M - |c|^2)`` (``M`` the largest squared norm), a query ``q`` a zero, so that
``|q' - c'|^2 = |q|^2 + M - 2 q.c``.  Candidates are keyed by their nearest pivot and by a
ring of the distance to it.  For a query, ``||q'-p| - |c'-p||`` bounds the distance to every
candidate of a ring from below, hence its score from above.

A query's rings (annuli) are sorted by that bound and expanded in rounds of growing width;
after each round the k-th best score so far stops all rings whose bound lies below it.
The last round takes every ring that is left, so the result is exact.

Bounds: pivots come from ``sample`` vectors (the least hashes of their ids) and serve only
the layout; every vector is indexed.  Their number grows as the square root of the table's,
up to ``sample / 16``.  The driver gets the sample and one row per ring
(``pivots * rings`` at most); blocks and scores are never broadcast.  A ring is stored as
blocks of about ``block`` vectors, so a vector that fills a third of the table is spread
over many tasks.

Defined cases: scores are exact, and cut to the range of 64-bit integers where components
are so large that they leave it (such scores tie); vectors that are null or hold null, NaN or infinite components, and rows
without id, take no part; shorter vectors count as padded with zeros; rows that repeat an
id are separate candidates, while a query id is asked once (with its least vector); empty
tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import col, ship, stage, table

ROUNDS = (2, 14, 112, None)  # rings; the last round takes all that are left


def integer_vectors(rows: DataFrame, is_query: Column, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """id, v, asks of the rows that take part; v: components as floor(scale * x), whole
    numbers kept as doubles (one that leaves their range is the largest double)."""
    v = col(rows, vector_col)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    most = F.lit(float(np.finfo(np.float64).max))

    def whole(x: Column) -> Column:
        y = F.greatest(-most, F.least(most, x.cast("double") * scale))
        return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)  # larger doubles are whole

    scaled = F.transform(v, whole)
    return rows.where(col(rows, id_col).isNotNull() & v.isNotNull() & good).select(col(rows, id_col).cast("long").alias("id"), scaled.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))


def fit_pivots(sample: np.ndarray, pivots: int, rings: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """k-means centres of the sample and, per pivot, the inner ring edges."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.permutation(len(sample))[:pivots]].copy()
    for _ in range(8):
        near = _distances(sample, centres).argmin(1)
        for p in range(len(centres)):
            if (near == p).any():
                centres[p] = sample[near == p].mean(0)
    d = _distances(sample, centres)
    near, own = d.argmin(1), d.min(1)
    steps = np.linspace(0, 1, rings + 1)[1:-1]
    edges = np.array([np.quantile(own[near == p], steps) if (near == p).any() else np.zeros(rings - 1) for p in range(len(centres))])
    return centres, edges


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T
    return np.sqrt(np.nan_to_num(np.maximum(sq, 0), nan=np.inf))


def _matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _lift(m: np.ndarray, top: float) -> np.ndarray:
    x = m.astype(np.float64)
    return np.c_[x, np.sqrt(np.maximum(top - (x * x).sum(1), 0)) if np.isfinite(top) else np.zeros(len(x))]


def sampled(vectors: DataFrame, rows: int, sample: int) -> pa.ChunkedArray:
    """Vectors of the ``sample`` least hashes of ids.

    The limit is taken on the executors and staged: collected at once, it would bring as
    many rows of every partition to the driver.  Hashes under a bound that about twice the
    sample meets come first; where repeated ids leave too few of them, all rows are asked.
    """
    key = F.xxhash64("id")

    def least(df: DataFrame) -> pa.ChunkedArray:
        return stage(df.orderBy(key, "id").limit(sample).select("v"), "sample").toArrow().column("v")

    if rows > 2 * sample:
        out = least(vectors.where(key < LONG[0] + (2 * sample << 64) // rows))
        if len(out) == sample:
            return out
    return least(vectors)


LONG = (-(1 << 63), (1 << 63) - 1)


def _scores(q: np.ndarray, c: np.ndarray, exact: type) -> np.ndarray:
    """Inner products of whole numbers kept as doubles: in doubles or 64-bit integers where
    these hold every sum, else in Python's integers, cut to the 64-bit range."""
    if exact is not object:
        return (q.astype(exact) @ c.astype(exact).T).astype(np.int64)
    a, b = ([[int(x) for x in row] for row in m.tolist()] for m in (q, c))
    return np.array([[min(max(sum(x * y for x, y in zip(i, j)), LONG[0]), LONG[1]) for j in b] for i in a], np.int64).reshape(len(q), len(c))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by score, ties to the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], ~scores[at]))][:k]  # the complement falls as scores rise, without overflow


def top_k(rows: DataFrame, is_query: Column, k: int = 5, scale: int = 256, pivots: int | None = None, rings: int = 8, sample: int = 4096, block: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best candidates of every query row."""
    spark = rows.sparkSession
    ship(spark)
    vectors = stage(integer_vectors(rows, is_query, scale, id_col, vector_col), "vectors")
    sq = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows_in_all, width, top, peak = vectors.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(sq), F.max(F.array_max(F.transform("v", F.abs)))).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if width is None:
        return empty
    width, peak = max(width, 1), peak or 0
    if float(width) * peak * peak >= 2.0**62:
        exact = object  # neither bounds nor machine numbers hold: every ring is taken, and scored in Python's integers
    else:
        exact = np.float64 if width * peak * peak < 1 << 52 else np.int64
    store_as = np.int32 if peak < 1 << 31 else np.float64
    if pivots is None:
        pivots = min(max(32, math.isqrt(rows_in_all) // 4), sample // 16)
    some = sampled(vectors, rows_in_all, sample)
    centres, edges = fit_pivots(_lift(_matrix([v.values.to_numpy() for v in some], width), top), min(pivots, len(some)), rings)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch.column("v").to_pylist(), width)
            d = _distances(_lift(m, top), centres)
            near, own = d.argmin(1), d.min(1)
            ring = (edges[near] < own[:, None]).sum(1)
            x = m.astype(np.float64)
            home = _distances(np.c_[x, np.zeros(len(x))], centres).argmin(1)
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "asks": batch.column("asks"), "pivot": pa.array(near, pa.int32()), "ring": pa.array(ring, pa.int32()), "distance": own, "home": pa.array(home, pa.int32()), "vec": [r.tobytes() for r in m.astype(store_as)]})

    entries = stage(vectors.mapInArrow(index, "id long, asks boolean, pivot int, ring int, distance double, home int, vec binary"), "pivot-index")
    directory = entries.groupBy("pivot", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("distance").alias("near"), F.max("distance").alias("far")).orderBy("pivot", "ring").collect()  # pivots * rings at most
    blocks_of = {(r["pivot"], r["ring"]): -(-r["n"] // block) for r in directory}
    d_pivot = np.array([r["pivot"] for r in directory])
    d_near, d_far = np.array([r["near"] for r in directory]), np.array([r["far"] for r in directory])
    d_blocks = [blocks_of[r["pivot"], r["ring"]] for r in directory]
    d_ring = [r["ring"] for r in directory]

    sizes = spark.createDataFrame([(p, r, n) for (p, r), n in blocks_of.items()], "pivot int, ring int, blocks int")
    placed = entries.join(F.broadcast(sizes), ["pivot", "ring"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    blocks = stage(placed.groupBy("pivot", "ring", "block").agg(F.collect_list(F.struct("id", "vec")).alias("members")), "index-blocks")
    asked = entries.where("asks").groupBy("id").agg(F.min(F.struct("vec", "home")).alias("q"))
    asked = stage(asked.select(F.col("id").alias("query_id"), F.col("q.vec").alias("vec"), F.col("q.home").alias("home")), "queries")
    per_home = {r["home"]: -(-r["n"] // 256) for r in asked.groupBy("home").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``pivots`` rows
    if not per_home:
        return empty
    homes = spark.createDataFrame(list(per_home.items()), "home int, parts int")
    asked = asked.join(F.broadcast(homes), "home").withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int")).drop("parts")

    def bounds(q: np.ndarray) -> np.ndarray:
        """Per query and ring the largest score that the ring can hold."""
        x = q.astype(np.float64)
        d = _distances(np.c_[x, np.zeros(len(x))], centres)[:, d_pivot]
        least = np.maximum(0, np.maximum(d - d_far, d_near - d))
        if exact is object:
            return np.full((len(q), len(d_pivot)), np.inf)
        most = ((x * x).sum(1)[:, None] + top - least * least) / 2
        return most + 1e-6 * (1 + np.abs(top) + (x * x).sum(1)[:, None])

    def expand(lo: int, hi: int | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    ids = np.array([x["query_id"] for x in row["asked"]])
                    q = np.stack([np.frombuffer(x["vec"], store_as) for x in row["asked"]])
                    tau = np.array([x["tau"] if x["tau"] is not None else -(1 << 62) for x in row["asked"]])
                    most = bounds(q)
                    order = np.argsort(-most, axis=1, kind="stable")
                    rank = np.empty_like(order)
                    np.put_along_axis(rank, order, np.arange(order.shape[1])[None], axis=1)
                    wanted = (rank >= lo) & (most >= tau[:, None])
                    if hi is not None:
                        wanted &= rank < hi
                    out = []
                    for r in np.flatnonzero(wanted.any(0)):
                        w = wanted[:, r]
                        for b in range(d_blocks[r]):
                            out.append({"pivot": int(d_pivot[r]), "ring": d_ring[r], "block": b, "ids": ids[w].tobytes(), "vecs": q[w].tobytes()})
                        if len(out) >= 64:
                            yield pa.RecordBatch.from_pylist(out, pairs_schema)
                            out = []
                    if out:
                        yield pa.RecordBatch.from_pylist(out, pairs_schema)

        return run

    pairs_schema = pa.schema([("pivot", pa.int32()), ("ring", pa.int32()), ("block", pa.int32()), ("ids", pa.binary()), ("vecs", pa.binary())])
    hits_schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        none = (np.empty(0, np.int64), np.empty(0, np.int64))

        def flush() -> pa.RecordBatch:
            q = np.concatenate([np.full(len(s), i) for i, (s, _) in state.items()])
            out = pa.RecordBatch.from_arrays([pa.array(q), pa.array(np.concatenate([c for _, c in state.values()])), pa.array(np.concatenate([s for s, _ in state.values()]))], schema=hits_schema)
            state.clear()
            return out

        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                ids = np.frombuffer(row["ids"], np.int64)
                q = np.frombuffer(row["vecs"], store_as).reshape(len(ids), -1)
                members = np.array([x["id"] for x in row["members"]])
                c = np.stack([np.frombuffer(x["vec"], store_as) for x in row["members"]])
                scores = _scores(q, c, exact)
                for i, qid in enumerate(ids.tolist()):
                    other = members != qid
                    s, m = scores[i][other], members[other]
                    best = _best(s, m, k)
                    s0, m0 = state.get(qid, none)
                    s, m = np.concatenate((s0, s[best])), np.concatenate((m0, m[best]))
                    best = _best(s, m, k)
                    state[qid] = (s[best], m[best])
                if len(state) > 50_000:
                    yield flush()
        if any(len(s) for s, _ in state.values()):
            yield flush()

    def best_of(hits: DataFrame) -> DataFrame:
        w = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    found, lo = None, 0
    for width_of_round in ROUNDS:
        rows_of = asked
        if found is not None:
            tau = found.where(F.col("rank") == k).select("query_id", F.col("score").alias("tau"))
            rows_of = asked.join(tau.hint("merge"), "query_id", "left")
        else:
            rows_of = asked.withColumn("tau", F.lit(None).cast("long"))
        groups = rows_of.groupBy("home", "part").agg(F.collect_list(F.struct("query_id", "vec", "tau")).alias("asked")).select("asked")
        hi = None if width_of_round is None else lo + width_of_round
        pairs = groups.mapInArrow(expand(lo, hi), "pivot int, ring int, block int, ids binary, vecs binary")
        hits = pairs.join(blocks.hint("merge"), ["pivot", "ring", "block"]).select("ids", "vecs", "members").mapInArrow(score, "query_id long, vec_id long, score long")
        if found is not None:
            hits = hits.unionByName(found.select("query_id", "vec_id", "score"))
        found = stage(best_of(hits), "hits")
        lo = hi or lo
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk FROM s)
SELECT query_id, CAST(rk AS INTEGER) AS rank, vec_id, score FROM r WHERE rk <= 5
"""
