"""Toxicity by non-negative positive-unlabelled learning in numpy.

Positives are training rows confirmed toxic.  The unlabelled set is a draw of all training
documents, labelled or not; no label is read for it, and no negative label is needed.  A
linear model on character n-grams of words is fitted with the sigmoid loss to the
corrected risk  ``prior*R_p(+) + max(0, R_u(-) - prior*R_p(-))``; where the bracket turns
negative the step goes back along it.

Class prior: the parameter ``prior`` if given; else the share of toxic rows among the
labelled training rows, if these hold both classes; else (labels of one class only) the
least ratio  ``P_u(f > t) / P_p(f > t)``  over thresholds that at least a third of the
positives pass, where ``f`` sums the features' log ratios.  As every toxic text lies in the
unlabelled set too, no such ratio is below the prior but by chance.

Bounds (documented parameters): the fit takes at most ``positives`` labelled rows and
``unlabelled`` documents (least hash of the id).  Features are all n-grams that occur in 1 %
of the positives and are more frequent there by ``least_z`` standard deviations.  Scores
cover every whole text: a text's logit is the sum of its distinct words' weights, shifted so
that the fitted decision boundary lies at a score of ``boundary``.

Defined cases: null and empty texts get the score of a text without features; a null id is
hashed as the empty string and belongs to the unlabelled rows; labels that are null count
as missing; a row is positive if any of its labels is 1; without any positive training row
every score is 0; repeated rows are scored each; empty tables give no rows; extra columns
are ignored or carried.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, ship, stage, table
from .textual import gathered, pieces, unicode_words

PUNCTUATION = ".,;:!?\"'()[]{}<>*_-"


def grams(word: str) -> set[str]:
    """Character 4- and 5-grams of a word between blanks, and the word itself."""
    w = f" {word} "
    out = {w[i : i + 4] for i in range(len(w) - 3)} | {w[i : i + 5] for i in range(len(w) - 4)}
    out.add(w)
    return out


def distinct_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Text, word code of the distinct words of every text, and the words: lower case,
    without punctuation at their ends."""
    parts = unicode_words(texts)
    bare = pc.utf8_trim(parts.distinct, characters=PUNCTUATION).dictionary_encode()
    names = bare.dictionary.to_numpy(zero_copy_only=False).tolist()
    width = max(1, len(names))
    both = np.unique(parts.owners() * width + bare.indices.to_numpy()[parts.codes])
    owner, word = both // width, both % width
    real = np.fromiter(map(bool, names), bool, len(names))[word]
    return owner[real], word[real], names


class Finder:
    """Finds the features in words: one automaton over all of them."""

    def __init__(self, features: list[str]):
        self.width, self.automaton = max(1, len(features)), ahocorasick.Automaton()
        for i, g in enumerate(features):
            self.automaton.add_word(g, i)
        if features:
            self.automaton.make_automaton()
        self.none = not features

    def __call__(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Word and feature of the distinct features of every word."""
        if self.none or not names:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        ends = np.cumsum(np.fromiter(map(len, names), np.int64, len(names)) + 3)
        found = np.fromiter((x for pair in self.automaton.iter("".join(f" {w} \n" for w in names)) for x in pair), np.int64)
        at, which = found[::2], found[1::2]
        both = np.unique(np.searchsorted(ends, at, "right") * self.width + which)
        return both // self.width, both % self.width


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


class Sparse:
    """Rows of a feature matrix as (row, feature, value) triples, with the two products."""

    def __init__(self, row: np.ndarray, at: np.ndarray, value: np.ndarray, rows: int, width: int):
        self.row, self.at, self.value, self.rows, self.width = row, at, value, rows, width

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.at] * self.value, self.rows)

    def back(self, s: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, s[self.row] * self.value, self.width)

    @classmethod
    def of(cls, x: np.ndarray) -> Sparse:
        row, at = np.nonzero(x)
        return cls(row, at, x[row, at].astype(np.float64), *x.shape)


def _sigmoid(f: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(f, -30, 30)))


def fit_nnpu(xp: Sparse, xu: Sparse, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and intercept by Adam on the non-negative PU risk with the sigmoid loss."""
    w, b = np.zeros(xp.width), -1.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        sp, su = _sigmoid(xp.dot(w) + b), _sigmoid(xu.dot(w) + b)  # also the losses of calling the rows negative
        bracket = su.mean() - prior * sp.mean()
        sp, su = sp * (1 - sp) / len(sp), su * (1 - su) / len(su)
        up = xp.back(sp)
        g_neg = np.r_[xu.back(su) - prior * up, su.sum() - prior * sp.sum()]
        g = np.r_[-prior * up, -prior * sp.sum()] + g_neg if bracket >= 0 else -g_neg
        g[:-1] += decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def least_ratio(fp: np.ndarray, fu: np.ndarray, part: float = 1 / 3) -> float:
    """The least share of unlabelled rows above a threshold against that of positives, over
    the thresholds that at least ``part`` of the positives pass."""
    cuts = np.unique(np.quantile(fp, np.linspace(0, 1 - part, 50)))
    share_p = np.array([(fp >= t).mean() for t in cuts])
    share_u = np.array([(fu >= t).sum() + 1 for t in cuts]) / (len(fu) + 1)
    return float((share_u / share_p).min())


def _gram_counts(sample: DataFrame) -> DataFrame:
    """gram, a, b: positive and unlabelled documents that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bool, Counter] = {True: Counter(), False: Counter()}

        def out() -> pa.RecordBatch:
            keys = [(g, n if p else 0, 0 if p else n) for p, c in counts.items() for g, n in c.items()]
            for c in counts.values():
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), pa.array([k[2] for k in keys], pa.int64())], ["gram", "a", "b"])

        for batch in batches:
            for part in pieces(batch, size=1_000_000):
                owner, word, names = distinct_words(part.column("text"))
                of_word = [grams(w) for w in names]
                edges = np.searchsorted(owner, np.arange(part.num_rows + 1))
                for k, positive in enumerate(part.column("positive").to_pylist()):
                    counts[positive].update(set().union(*(of_word[i] for i in word[edges[k] : edges[k + 1]].tolist())))
                    if len(counts[positive]) > 300_000:
                        yield out()
        yield out()

    return sample.select("positive", "text").mapInArrow(run, "gram string, a long, b long").groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def _matrices(sample: DataFrame, features: list[str]) -> dict[bool, Sparse]:
    """Feature matrices of the bounded sample: how many of a text's distinct words hold a feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(features)
        for batch in batches:
            for part in pieces(batch, size=2_000_000):
                owner, word, names = distinct_words(part.column("text"))
                of, which = finder(names)
                first, last = np.searchsorted(of, word), np.searchsorted(of, word, "right")
                which, _ = gathered(which, first, last - first)
                both, n = np.unique(np.repeat(owner, last - first) * finder.width + which, return_counts=True)
                edges = np.searchsorted(both // finder.width, np.arange(part.num_rows + 1))
                at = (both % finder.width).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("positive"), pa.array([at[x:y] for x, y in zip(edges, edges[1:])], pa.list_(pa.int32())), pa.array([n[x:y] for x, y in zip(edges, edges[1:])], pa.list_(pa.int64()))], ["positive", "at", "n"])

    got = sample.select("positive", "text").mapInArrow(run, "positive boolean, at array<int>, n array<long>").toArrow()  # the bounded sample's sparse rows
    out = {}
    for positive in (True, False):
        some = got.filter(pc.equal(got.column("positive"), positive)).combine_chunks()
        per_row = pc.list_value_length(some.column("at")).to_numpy()
        at, n = (pc.list_flatten(some.column(c)).to_numpy() for c in ("at", "n"))
        out[positive] = Sparse(np.repeat(np.arange(len(per_row)), per_row), at.astype(np.int64), n.astype(np.float64), len(per_row), len(features))
    return out


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, positives: int = 2000, unlabelled: int = 8000, least_z: float = 3.0, prior: float | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[dict[str, float], float] | None:
    """Weights per n-gram and intercept; None without positive rows.  ``may_learn`` speaks
    of the column ``id``."""
    ship(docs.sparkSession)
    marked = labels.where(col(labels, label_col).isNotNull() & col(labels, id_col).isNotNull()).groupBy(col(labels, id_col).cast("long").alias("id")).agg(F.max(col(labels, label_col).cast("int")).alias("y"))
    marked = stage(marked.where(may_learn), "labelled")
    total, toxic = marked.agg(F.count(F.lit(1)), F.count_if(F.col("y") == 1)).first()
    if not toxic:
        return None
    order = [F.xxhash64(F.lit(17), "id"), "id"]
    texts = docs.select(col(docs, id_col).cast("long").alias("id"), col(docs, text_col).cast("string").alias("text"))
    p = marked.where("y = 1").orderBy(*order).limit(positives).select("id")
    p = texts.join(F.broadcast(p), "id").select("id", "text", F.lit(True).alias("positive"))  # ``positives`` ids at most
    ids = texts.where(may_learn).select("id").orderBy(*order).limit(unlabelled).distinct()
    u = texts.join(F.broadcast(ids), texts["id"].eqNullSafe(ids["id"]), "left_semi").orderBy(*order).limit(unlabelled).select("id", "text", F.lit(False).alias("positive"))  # ``unlabelled`` ids at most
    sample = stage(p.unionByName(u).repartition(32), "toxic-sample")
    n_p, n_u = sample.agg(F.count_if("positive"), F.count_if(~F.col("positive"))).first()
    if not n_p:
        return None
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    ratio = F.log(a / (n_p + 1)) - F.log(b / (n_u + 1))
    frequent = _gram_counts(sample).where(F.col("a") >= max(2, math.ceil(0.01 * n_p)))
    chosen = {r["gram"]: r["ratio"] for r in frequent.select("gram", ratio.alias("ratio"), (ratio / F.sqrt(1 / a + 1 / b)).alias("z")).where(F.col("z") >= least_z).collect()}
    if not chosen:
        return None
    features = sorted(chosen)
    x = _matrices(sample, features)
    if prior is None:
        if toxic < total:
            prior = toxic / total
        else:
            ratios = np.array([chosen[g] for g in features])
            prior = least_ratio(x[True].dot(ratios), x[False].dot(ratios))
    w, b = fit_nnpu(x[True], x[False], min(prior, 0.99))
    return {g: float(v) for g, v in zip(features, w, strict=True)}, float(b)


class Scorer:
    """Logits of texts: the summed weights of their distinct words."""

    def __init__(self, weights: dict[str, float], intercept: float):
        self.finder, self.weights, self.intercept = Finder(list(weights)), np.array(list(weights.values())), intercept

    def __call__(self, texts: pa.Array) -> np.ndarray:
        owner, word, names = distinct_words(texts)
        of, which = self.finder(names)
        per_word = np.bincount(of, self.weights[which], len(names)) if len(of) else np.zeros(len(names))
        return np.round(np.bincount(owner, per_word[word], len(texts)) + self.intercept, 9)  # the order of words leaves no trace


def _shifted(logits: np.ndarray, boundary: float = 0.3) -> np.ndarray:
    """Scores whose decision boundary (logit 0) lies at ``boundary``."""
    return 1 / (1 + np.exp(-np.clip(logits + math.log(boundary / (1 - boundary)), -500, 500)))


def score(docs: DataFrame, model: tuple[dict[str, float], float] | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every row's whole text."""
    ship(docs.sparkSession)
    rows_of = docs.select(col(docs, id_col).cast("long").alias("doc_id"), col(docs, text_col).cast("string").alias("text"))
    if model is None:
        return rows_of.select("doc_id", F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*model)
        for batch in batches:
            for part in pieces(batch, size=2_000_000):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(_shifted(scorer(part.column("text"))))], ["doc_id", "score"])

    return rows_of.mapInArrow(run, "doc_id long, score double")


def learned(docs: DataFrame, labels: DataFrame, held_out_of: int = 4, held_out: int = 2) -> tuple[dict[str, float], float] | None:
    return fit(docs, labels, remainder(F.col("id"), held_out_of) != held_out)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose whole text scores below ``threshold``, with all their columns.

    Each row is judged where it lies: no shuffle and no join.
    """
    model = learned(docs, labels)
    if model is None:
        return docs
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*model)
        for batch in batches:
            for part in pieces(batch, place, size=2_000_000):
                yield part.filter(pa.array(_shifted(scorer(part.column(place))) < threshold))

    place = docs.columns.index(text_col)
    return docs.mapInArrow(run, docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, learned(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
