"""Language-model scoring: a causal self-attention model in numpy over subword ids.

Text form: A-Z in lower case, words split at ASCII white space, each word encoded with a
leading blank (names of special tokens are ordinary text), then one end id behind the
vocabulary's own.  The network predicts the class of the next id (the most frequent ids are
classes of their own, the rest share classes by frequency and by whether they begin a word)
and an id inside its class by its smoothed share there, so every id has a probability and
all of them sum to one.  Classes are predicted in two steps, a group and a member of the
group; a group holds only classes that begin a word or only classes that do not.

Network: class embeddings, one attention head with a learned bias per distance, a small
rectified layer, and direct paths from the last two classes whose tables are set in closed
form from the counts of all training documents and scaled by learned factors.  Scoring
walks over windows of two blocks that overlap by one; each window scores its second block
with the first as context, so each id is scored once.

Words: the network's probability of a whole word is that of its ids and of a word's end
behind them, given that a word begins; it is mixed (``known_part``) with the share of the
word among all training tokens, for the ``frequent`` most frequent words.  Both are
distributions over words, so the score is a log probability.

Learning: word, id and class-pair counts cover every training document, and so do the
attention weights.  Training rows are dealt by a hash of the row to rounds and, inside a
round, to shards of about ``shard_tokens`` ids; a shard is sorted by that hash and passed
once by Adam, whose state lasts through the shard while its batches grow; a round starts
from the average of the last one.  So the weights do not depend on how the table is
partitioned (but for rounding).  Texts are encoded once; later passes read the staged ids.

Base score: add-one word unigrams.  The ``frequent`` most frequent words are counted where
the text is read; occurrences of all others are joined with the table of counts (no such
word is frequent, so none is hot).

Defined cases: null and empty texts consist of the end alone; a null id is hashed as the
empty string; rows that repeat are scored each; without training rows counts are zero and
the model is uniform inside equal classes; empty tables give no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from numpy.lib.stride_tricks import as_strided
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, ship, stage, table
from .textual import Parts, ascii_words, gathered, pieces
from .tokens import VOCABULARY, encoder

GROUPS = 32
CLASSES = GROUPS * GROUPS
OWN = CLASSES - 2 * GROUPS
BLOCK, WIDTH, HIDDEN = 16, 16, 32
CHUNK = 256  # blocks scored at once
BUCKETS = 4096  # ranges of word hashes, a power of two


def word_keys(names: pa.Array) -> np.ndarray:
    """Signed 64-bit hashes of words."""
    found = names.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)).view(np.int64)


def held_out(doc_id: int | None, modulus: int = 7, remainder: int = 2) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus == remainder


def id_type(ids: int) -> type:
    return np.uint16 if ids <= 1 << 16 else np.uint32


def id_count(vocabulary: str) -> int:
    """Ids of the vocabulary and one more, the last, for a text's end."""
    return encoder(vocabulary, plain=True).tokenizer.get_vocab_size() + 1


class Encoded(NamedTuple):
    """Ids of texts one behind the other, ends included, with the texts' offsets; the number
    of ids of every word (an end is a word), with the texts' offsets among the words."""

    ids: np.ndarray
    offsets: np.ndarray
    sizes: np.ndarray
    word_offsets: np.ndarray


def sequences(parts: Parts, vocabulary: str, end: int) -> Encoded:
    enc = encoder(vocabulary, plain=True)
    led = pc.binary_join_element_wise(pa.scalar(" "), parts.distinct, "")
    starts, sizes = enc.located(parts._replace(distinct=led))
    ids, ends = gathered(enc.ids, starts, sizes)
    offsets = np.r_[0, ends][parts.offsets]
    more = np.arange(len(offsets))
    return Encoded(np.insert(ids, offsets[1:], end), offsets + more, np.insert(sizes, parts.offsets[1:], 1), parts.offsets + more)


class Classes:
    """Classes of ids from their counts, and the log share of each id in its class.

    ``starts`` marks the ids that begin a word; classes of such ids fill the first
    ``start_groups`` groups.
    """

    def __init__(self, counts: np.ndarray, starts: np.ndarray):
        ids = len(counts)
        order = np.lexsort((np.arange(ids), -counts))
        own, rest = order[:OWN], order[OWN:]
        n_start = int(starts[own].sum())
        bands = GROUPS // 2 + (-n_start - GROUPS // 2) % GROUPS  # so that a whole number of groups is filled
        self.of = np.empty(ids, np.int64)
        at = 0
        for begins, n in ((1, bands), (0, CLASSES - OWN - bands)):
            mine = own[starts[own] == begins]
            self.of[mine] = at + np.arange(len(mine))
            others = rest[starts[rest] == begins]
            mass = np.cumsum(counts[others] + 1.0)
            if len(others):
                self.of[others] = at + len(mine) + np.minimum((mass / mass[-1] * n).astype(np.int64), n - 1)
            at += len(mine) + n
        self.end, self.start_groups = int(self.of[-1]), (n_start + bands) // GROUPS
        total = np.bincount(self.of, counts + 1.0, CLASSES)
        self.share = np.log((counts + 1.0) / total[self.of])


def word_starts(vocabulary: str) -> np.ndarray:
    t = encoder(vocabulary, plain=True).tokenizer
    return np.array([*((t.id_to_token(i) or "").startswith("Ġ") for i in range(id_count(vocabulary) - 1)), True], np.int64)


class Tables:
    """Log probabilities of group and of member given the class one and two places back
    (the latter relative to the probabilities without context)."""

    def __init__(self, last: np.ndarray, before: np.ndarray, prior: float = 10.0):
        n = last.reshape(CLASSES, CLASSES).astype(np.float64)
        one = (n.sum(0) + 1) / (n.sum() + CLASSES)
        own = self._split((n + prior * one) / (n.sum(1, keepdims=True) + prior))
        m = before.reshape(CLASSES, CLASSES).astype(np.float64)
        two = self._split((m + 2 * prior * one) / (m.sum(1, keepdims=True) + 2 * prior))
        plain = self._split(one[None])
        self.group1, self.member1 = (x.astype(np.float32) for x in own)
        self.group2, self.member2 = (two[0] - plain[0]).astype(np.float32), (two[1] - np.tile(plain[1], (CLASSES, 1))).astype(np.float32)

    @staticmethod
    def _split(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        g = p.reshape(len(p), GROUPS, GROUPS).sum(2)
        return np.log(g), np.log(p / np.repeat(g, GROUPS, 1)).reshape(len(p) * GROUPS, GROUPS)


SHAPES = {"emb": (CLASSES, WIDTH), "wq": (WIDTH, WIDTH), "wk": (WIDTH, WIDTH), "wv": (WIDTH, WIDTH), "far": (2 * BLOCK,), "w1": (WIDTH, HIDDEN), "b1": (HIDDEN,), "w2": (HIDDEN, WIDTH), "group": (WIDTH, GROUPS), "member": (GROUPS, WIDTH, GROUPS), "scale": (4,)}


def start_weights(seed: int = 9) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = {k: (rng.standard_normal(s) * (0.5 if k == "emb" else 0.25 / math.sqrt(WIDTH))).astype(np.float32) for k, s in SHAPES.items()}
    w["far"] = (-0.1 * np.arange(2 * BLOCK)).astype(np.float32)
    w["b1"][:] = 0
    w["group"] *= 0.1
    w["member"] *= 0.1
    w["scale"][:] = (1.0, 0.3, 1.0, 0.3)  # group: last, before; member: last, before
    return w


def pack_weights(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in SHAPES])


def unpack_weights(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = math.prod(s)
        out[k] = flat[at : at + n].reshape(s).astype(np.float32)
        at += n
    return out


class Blocks(NamedTuple):
    """Class sequences cut into blocks, one text behind the other: inputs, the classes two
    places back, the targets (-1 beyond a text's end), and whether a block is its text's
    first.  The context of a block is the block before it."""

    cur: np.ndarray
    back: np.ndarray
    targets: np.ndarray
    first: np.ndarray

    def part(self, lo: int, hi: int) -> Blocks:
        return Blocks(*(x[lo:hi] for x in self))


def blocked(classes: np.ndarray, offsets: np.ndarray, end_class: int) -> tuple[Blocks, np.ndarray]:
    """Blocks of texts, and the place of every id among the blocks' targets."""
    n = np.diff(offsets)
    n_blocks = -(-n // BLOCK)
    total = int(n_blocks.sum())
    at = np.cumsum(n_blocks) - n_blocks
    place = np.arange(len(classes)) + np.repeat(at * BLOCK - offsets[:-1], n)
    inputs, targets = np.zeros(total * BLOCK, np.int32), np.full(total * BLOCK, -1, np.int32)
    targets[place] = classes
    inputs[1:] = np.maximum(targets[:-1], 0)
    inputs[at * BLOCK] = end_class
    back = np.roll(inputs, 1)
    back[at * BLOCK] = end_class
    first = np.zeros(total, bool)
    first[at] = True
    return Blocks(inputs.reshape(total, BLOCK), back.reshape(total, BLOCK), targets.reshape(total, BLOCK), first), place


_LAG = np.arange(BLOCK)[:, None] + BLOCK - np.arange(2 * BLOCK)[None]  # distance from query to key
_SEEN = _LAG >= 0
_FAR = np.where(_SEEN, _LAG, 0) % (2 * BLOCK)


def _bounded(x: np.ndarray) -> np.ndarray:
    """In place: values above 80 become 80, so that their exponentials stay finite."""
    if x.size and x.max() > 80:
        np.minimum(x, 80, out=x)
    return x


def _sums(x: np.ndarray) -> np.ndarray:
    """Sums of rows; a product is several times as fast as a sum over a short axis."""
    return x @ np.ones(x.shape[-1], x.dtype)


def _product(x: np.ndarray, y: np.ndarray, run: int = 256) -> np.ndarray:
    """x.T @ y over runs of rows: faster than one product of two long, narrow arrays."""
    m = len(x) // run * run
    out = x[m:].T @ y[m:]
    if m:
        out += (x[:m].reshape(-1, run, x.shape[1]).transpose(0, 2, 1) @ y[:m].reshape(-1, run, y.shape[1])).sum(0)
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    np.exp(_bounded(x), out=x)
    x /= _sums(x)[..., None]
    return x


def _pull(x: np.ndarray, goal: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """In place: gradient, by the scores of each row, of the weighted negative log shares of the goals."""
    np.exp(_bounded(x), out=x)
    x *= (weight / _sums(x))[:, None]
    x.reshape(-1)[np.arange(len(x)) * x.shape[1] + goal] -= weight
    return x


def _windows(x: np.ndarray) -> np.ndarray:
    """Rows of every block and the block before it: a view, nothing is copied."""
    size, width = x.strides
    return as_strided(x, (len(x) // BLOCK - 1, 2 * BLOCK, x.shape[1]), (BLOCK * size, size, width), writeable=False)


def _turned(x: np.ndarray) -> np.ndarray:
    """``_windows``, each transposed, with its columns' values side by side: small products
    with a transposed right side are slow."""
    x = np.ascontiguousarray(x.T)
    size, width = x.strides
    return as_strided(x, (x.shape[1] // BLOCK - 1, len(x), 2 * BLOCK), (BLOCK * width, size, width), writeable=False)


class Network:
    def __init__(self, weights: dict[str, np.ndarray], tables: Tables):
        self.w, self.t = weights, tables
        e = weights["emb"]
        self.q, self.k, self.v = e @ weights["wq"] / np.float32(math.sqrt(WIDTH)), e @ weights["wk"], e @ weights["wv"]
        self.near = np.where(_SEEN, weights["far"][_FAR], np.float32(-1e9))

    def forward(self, b: Blocks, scaled: tuple[np.ndarray, ...] | None = None) -> dict[str, np.ndarray]:
        """Of all blocks but the first, which is context only.  What concerns members of
        groups is in the order ``order``, by group.  ``a`` holds the exponentials of
        attention's scores, ``each`` the factors that make a query's add up to one.
        ``scaled``: the direct tables times their factors, where these are fixed."""
        w, t = self.w, self.t
        every, first = b.cur.ravel(), b.first[1:]
        last, before, goal = every[BLOCK:], b.back[1:].ravel(), np.maximum(b.targets[1:].ravel(), 0)
        k, v = self.k.take(every, 0), self.v.take(every, 0)
        q = self.q.take(last, 0).reshape(-1, BLOCK, WIDTH)
        a = q @ _turned(k)
        a += self.near
        a[first, :, :BLOCK] = -1e9  # masked: the block before belongs to another text
        np.exp(_bounded(a), out=a)
        each = 1 / _sums(a.reshape(-1, 2 * BLOCK))
        e = w["emb"].take(last, 0)
        h = (a @ _windows(v)).reshape(-1, WIDTH)
        h *= each[:, None]
        h += e
        r = h @ w["w1"]
        r += w["b1"]
        r += np.abs(r)  # rectified: twice the positive part
        r *= 0.5
        h2 = r @ w["w2"]
        h2 += h
        group = goal // GROUPS
        order = np.argsort(group.astype(np.int16), kind="stable")
        group_by, hs = group.take(order), h2.take(order, 0)
        rows = [last, before, last.take(order) * GROUPS + group_by, before.take(order) * GROUPS + group_by]
        direct = [x.take(at, 0) for x, at in zip(scaled or (t.group1, t.group2, t.member1, t.member2), rows)]
        lg, lm = h2 @ w["group"], np.empty((len(hs), GROUPS), hs.dtype)
        edges = np.searchsorted(group_by, np.arange(GROUPS + 1)).tolist()
        spans = [(i, slice(x, y)) for i, (x, y) in enumerate(zip(edges, edges[1:])) if x < y]
        for i, s in spans:
            np.matmul(hs[s], w["member"][i], out=lm[s])
        for i, (x, d) in enumerate(zip((lg, lg, lm, lm), direct)):
            x += d if scaled else w["scale"][i] * d
        return {"q": q, "k": k, "v": v, "a": a, "each": each, "e": e, "h": h, "r": r, "hs": hs, "group": group, "direct": direct, "lg": lg, "lm": lm, "order": order, "member": goal.take(order) % GROUPS, "spans": spans}

    def log_probs(self, blocks: Blocks, start_groups: int = GROUPS) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each target class (0 beyond a text's end), and of any class of
        the first groups there."""
        out, begins = np.zeros(blocks.targets.shape), np.zeros(blocks.targets.shape)
        n = len(blocks.cur)
        lead = Blocks(*(np.concatenate((x[:1], x)) for x in blocks))  # the first block has none before it
        for at in range(0, n, CHUNK):
            x = lead.part(at, min(at + CHUNK, n) + 1)
            f = self.forward(x, self.scaled)
            lg, lm = _bounded(f["lg"]), _bounded(f["lm"])
            cells = np.arange(len(lg)) * GROUPS
            lp = lg.ravel().take(cells + f["group"]).astype(np.float64)
            chosen = lm.ravel().take(cells + f["member"])
            chosen -= np.log(_sums(np.exp(lm, out=lm)))
            lp[f["order"]] += chosen
            np.exp(lg, out=lg)
            whole = np.log(_sums(lg))
            real = x.targets[1:] >= 0
            out[at : at + CHUNK] = np.where(real, (lp - whole).reshape(real.shape), 0)
            begins[at : at + CHUNK] = (np.log(_sums(lg[:, :start_groups])) - whole).reshape(real.shape)
        return out, begins

    @cached_property
    def scaled(self) -> tuple[np.ndarray, ...]:
        """The direct tables times their factors."""
        return tuple(f * x for f, x in zip(self.w["scale"], (self.t.group1, self.t.group2, self.t.member1, self.t.member2)))

    def gradient(self, b: Blocks) -> dict[str, np.ndarray]:
        """Gradient of the mean negative log probability of all blocks but the first."""
        w = self.w
        f = self.forward(b)
        h, hs, a, r, order = f["h"], f["hs"], f["a"], f["r"], f["order"]
        weight = (b.targets[1:].ravel() >= 0).astype(hs.dtype)
        weight /= max(1, weight.sum())
        dg, dm = _pull(f["lg"], f["group"], weight), _pull(f["lm"], f["member"], weight.take(order))
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        g = {"group": _product(hs.take(back, 0), dg), "member": np.zeros(SHAPES["member"], hs.dtype)}
        g["scale"] = np.array([np.vdot(x, d) for x, d in zip((dg, dg, dm, dm), f["direct"])])
        dhs, turned = np.empty_like(hs), np.ascontiguousarray(w["member"].transpose(0, 2, 1))
        for i, s in f["spans"]:
            np.matmul(hs[s].T, dm[s], out=g["member"][i])
            np.matmul(dm[s], turned[i], out=dhs[s])
        dh = dg @ w["group"].T
        dh += dhs.take(back, 0)
        g["w2"] = _product(r, dh)
        du = dh @ w["w2"].T
        du *= r > 0
        g["w1"], g["b1"] = _product(h, du), _sums(du.T)
        dh += du @ w["w1"].T
        dz = dh * f["each"][:, None]
        ds = dz.reshape(-1, BLOCK, WIDTH) @ _turned(f["v"])
        ds -= _sums((h - f["e"]) * dz).reshape(-1, BLOCK, 1)
        ds *= a
        g["far"] = np.bincount(_FAR.ravel(), np.where(_SEEN, _sums(ds.reshape(len(ds), -1).T).reshape(_SEEN.shape), 0).ravel(), 2 * BLOCK)
        own, dz = b.cur.ravel(), dz.reshape(-1, BLOCK, WIDTH)
        de = np.zeros((len(own), WIDTH), hs.dtype)
        de[BLOCK:] = dh
        dq = (ds @ _windows(f["k"])).reshape(-1, WIDTH)
        dq /= np.float32(math.sqrt(WIDTH))
        g["wq"] = _product(f["e"], dq)
        de[BLOCK:] += dq @ w["wq"].T
        e = w["emb"].take(own, 0)
        for name, x, y in (("wv", a, dz), ("wk", ds, f["q"])):
            d = np.zeros((len(b.cur), BLOCK, WIDTH), hs.dtype)
            np.matmul(x[:, :, :BLOCK].transpose(0, 2, 1), y, out=d[:-1])  # as context
            d[1:] += x[:, :, BLOCK:].transpose(0, 2, 1) @ y  # and in their own block
            d = d.reshape(-1, WIDTH)
            g[name] = _product(e, d)
            de += d @ w[name].T
        g["emb"] = np.zeros(SHAPES["emb"], hs.dtype)
        pair = np.result_type(hs.dtype, np.complex64)  # two columns at a time
        np.add.at(g["emb"].reshape(-1).view(pair), (own[:, None] * (WIDTH // 2) + np.arange(WIDTH // 2)).ravel(), de.reshape(-1).view(pair))
        return g


class Trainer:
    """Adam over blocks in the order they come; batches grow as the steps do."""

    def __init__(self, weights: dict[str, np.ndarray], tables: Tables, rate: float = 0.01, least: int = 32, most: int = 512):
        self.flat, self.tables, self.rate, self.least, self.most = pack_weights(weights).astype(np.float32), tables, rate, least, most
        self.m, self.v, self.step, self.seen = np.zeros_like(self.flat), np.zeros_like(self.flat), 0, 0
        self.pending: list[Blocks] = []
        self.waiting = 0

    def feed(self, blocks: Blocks, last: bool = False) -> None:
        self.pending.append(blocks)
        self.waiting += len(blocks.cur)
        if self.waiting < 4 * self.most and not last:
            return
        all_ = Blocks(*(np.concatenate(x) for x in zip(*self.pending, strict=True)))
        n = len(all_.cur)
        at = 1 if self.seen else 0  # the first of the pending blocks has been learned from already
        if not self.seen and n:
            all_ = Blocks(*(np.concatenate((x[:1], x)) for x in all_))
            at, n = 1, n + 1
        while at < n:
            size = min(self.most, self.least << (self.step // 100))
            if at + size > n and not last:
                break
            self._learn(all_.part(at - 1, min(at + size, n)))
            at += size
        self.pending = [all_.part(min(at, n) - 1, n)] if n else []
        self.waiting = len(self.pending[0].cur) if n else 0

    def _learn(self, b: Blocks) -> None:
        self.step += 1
        self.seen += int((b.targets[1:] >= 0).sum())
        g = Network(unpack_weights(self.flat), self.tables).gradient(b)
        g = np.concatenate([np.asarray(g[k], np.float32).ravel() for k in SHAPES])
        self.m += np.float32(0.1) * (g - self.m)
        self.v += np.float32(0.02) * (g * g - self.v)
        rate = self.rate * min(1.0, 3.0 / math.sqrt(1 + self.step / 20))
        self.flat -= np.float32(rate / (1 - 0.9**self.step)) * self.m / (np.sqrt(self.v / np.float32(1 - 0.98**self.step)) + np.float32(1e-7))


class Model:
    """Classes, weights and direct tables; scores id sequences."""

    def __init__(self, classes: Classes, weights: dict[str, np.ndarray], tables: Tables):
        self.classes, self.network = classes, Network(weights, tables)

    def words(self, ids: np.ndarray, offsets: np.ndarray, sizes: np.ndarray, word_offsets: np.ndarray) -> np.ndarray:
        """Log probability of every word, given what is before it and that a word begins."""
        blocks, place = blocked(self.classes.of[ids], offsets, self.classes.end)
        lp, begins = (x.ravel()[place] for x in self.network.log_probs(blocks, self.classes.start_groups))
        at = np.cumsum(sizes) - sizes
        out = np.bincount(np.repeat(np.arange(len(sizes)), sizes), lp + self.classes.share[ids], len(sizes))
        begins = begins[at]
        behind = np.r_[begins[1:], 0.0]
        behind[word_offsets[1:] - 1] = 0  # nothing follows an end
        return out - begins + behind

    def score(self, ids: np.ndarray, offsets: np.ndarray, sizes: np.ndarray, word_offsets: np.ndarray, known: np.ndarray, known_part: float = 0.0) -> np.ndarray:
        """log10 probability of each text; ``known``: shares of the words among all tokens."""
        lp = self.words(ids, offsets, sizes, word_offsets)
        if known_part:
            with np.errstate(divide="ignore"):
                lp = np.logaddexp(lp + math.log1p(-known_part), np.log(known) + math.log(known_part))
        return np.bincount(np.repeat(np.arange(len(offsets) - 1), np.diff(word_offsets)), lp, len(offsets) - 1) / math.log(10)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(col(docs, id_col).cast("long").alias("doc_id"), col(docs, text_col).cast("string").alias("text"))


def _merged(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order and the sum of ``n`` for each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys[starts], np.add.reduceat(n[order], starts) if len(keys) else n


def _bucketed(buckets: np.ndarray, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """A row for every run of equal buckets, with its keys and their counts."""
    edges = np.r_[np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]]), len(buckets)] if len(buckets) else np.zeros(1, np.int64)
    return pa.RecordBatch.from_pydict({"bucket": buckets[edges[:-1]].astype(np.int32), "keys": _binaries(keys, edges), "n": _binaries(n, edges)})


def word_counts(docs: DataFrame, most: int = 1_000_000) -> DataFrame:
    """Staged (kind, key, n) of the training rows: words (0, hash) and documents (2, 0).

    Counts travel as arrays, one for each range of hashes (``BUCKETS`` of them; -1 for the
    documents), and are added up range by range."""
    ship(docs.sparkSession)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        documents = waiting = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return _merged(*(np.concatenate(x) for x in zip(*found, strict=True)))

        for batch in batches:
            for part in pieces(batch):
                part = part.filter(pa.array([not held_out(i) for i in part.column("doc_id").to_pylist()], pa.bool_()))
                documents += part.num_rows
                words = ascii_words(part.column("text"))
                n = np.bincount(words.codes, minlength=len(words.distinct))
                real = np.flatnonzero(n)
                found.append((word_keys(words.distinct)[real].view(np.uint64), n[real].astype(np.int64)))
                waiting += len(real)
                if waiting > 2 * most:
                    found = [merged()]
                    waiting = len(found[0][0])
                    if waiting > most:
                        yield _bucketed(found[0][0] >> shift, *found[0])
                        found, waiting = [], 0
        if found:
            keys, n = merged()
            yield _bucketed(keys >> shift, keys, n)
        yield _bucketed(np.array([-1]), np.zeros(1, np.uint64), np.array([documents]))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"kind": np.full(len(keys), kind, np.int32), "key": keys.view(np.int64), "n": n})

        keys, n = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            of_words = np.array(batch.column("bucket")) >= 0
            for kind, rows in ((2, batch.filter(pa.array(~of_words))), (0, batch.filter(pa.array(of_words)))):
                if not rows.num_rows:
                    continue
                more, times = _joined(rows.column("keys"), np.uint64)[0], _joined(rows.column("n"), np.int64)[0]
                if kind == 2:
                    yield table(2, more[:1], times.sum(keepdims=True))
                    continue
                keys, n = _merged(np.concatenate((keys, more)), np.concatenate((n, times)))
                whole = int(np.searchsorted(keys >> shift, keys[-1] >> shift))  # the last range may go on in the next batch
                yield table(0, keys[:whole], n[:whole])
                keys, n = keys[whole:], n[whole:]
        yield table(0, keys, n)

    out = docs.mapInArrow(run, "bucket int, keys binary, n binary").repartition("bucket").sortWithinPartitions("bucket")
    return stage(out.mapInArrow(summed, "kind int, key long, n long"), "lm-counts")


def encoded(docs: DataFrame, known: pa.Table, documents: int, tokens: int, vocabulary: str) -> DataFrame:
    """Staged rows: ids of every text, its words' numbers of ids and shares among the
    training tokens (0 for words that are not frequent), the base score's sum over frequent
    words, and the hashes of all other words."""
    order = np.argsort(known.column("key").to_numpy())
    shared = docs.sparkSession.sparkContext.broadcast((known.column("key").to_numpy()[order], known.column("n").to_numpy()[order]))
    ids_in_all = id_count(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, counts = (np.append(x, 0) for x in shared.value)
        logs, shares = np.log10(counts + 1.0), (counts / max(1, tokens)).astype(np.float32)
        for batch in batches:
            for part in pieces(batch):
                words = ascii_words(part.column("text"))
                keys = word_keys(words.distinct)
                at = np.searchsorted(top[:-1], keys)
                at = np.where(top[at] == keys, at, len(top) - 1)  # the last entry stands for words that are not frequent
                of = at[words.codes]
                others = of == len(top) - 1
                owner = words.owners()
                rows = part.num_rows
                log_top = np.bincount(owner, logs[of], rows) + math.log10(documents + 1)
                n_other = np.bincount(owner[others], minlength=rows)
                rare = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n_other)], pa.int32()), pa.array(keys[words.codes[others]]))
                seq = sequences(words, vocabulary, ids_in_all - 1)
                known_shares = np.insert(shares[of], words.offsets[1:], documents / max(1, tokens))
                n_words = np.diff(seq.word_offsets)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "held_out": pa.array([held_out(i) for i in part.column("doc_id").to_pylist()], pa.bool_()),
                        "n_tokens": pa.array(n_words, pa.int64()),
                        "n_top": pa.array(n_words - 1 - n_other + (documents > 0), pa.int64()),
                        "log_top": pa.array(log_top, pa.float64()),
                        "rare": rare,
                        "ids": _binaries(seq.ids.astype(id_type(ids_in_all)), seq.offsets),
                        "sizes": _binaries(seq.sizes.astype(np.int32), seq.word_offsets),
                        "known": _binaries(known_shares, seq.word_offsets),
                    }
                )

    out = docs.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_top long, log_top double, rare array<long>, ids binary, sizes binary, known binary")
    out = out.withColumn("row", F.monotonically_increasing_id())
    return stage(out.withColumn("order", F.xxhash64(F.lit(23), "doc_id", "ids")), "lm-ids")


def _binaries(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Runs of an array as binary values."""
    return pa.array([values[a:b].tobytes() for a, b in zip(offsets, offsets[1:])], pa.binary())


def _joined(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Values of a binary column one behind the other, and the rows' offsets."""
    sizes = pc.binary_length(column).to_numpy().astype(np.int64) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(column.to_pylist()), kind), np.r_[0, np.cumsum(sizes)]


def _counted(rows: DataFrame, cells: int, count, width: int = 512) -> np.ndarray:
    """Sum over all rows of what ``count(n, batch)`` adds to an array of ``cells``.  Counts
    travel as arrays, one for each range of ``width`` cells; ranges are narrow, as a batch of
    rows is bounded by their number only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(cells, np.int64)
        for batch in batches:
            for part in pieces(batch, "ids", size=1_000_000):
                count(n, part)
        at = np.flatnonzero(n)
        yield _bucketed(at // width, at, n[at])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for r in batch.to_pylist():
                n = sums.setdefault(r["bucket"], np.zeros(width, np.int64))
                n[np.frombuffer(r["keys"], np.int64) - r["bucket"] * width] += np.frombuffer(r["n"], np.int64)
        for bucket, n in sums.items():
            at = np.flatnonzero(n)
            yield _bucketed(np.full(len(at), bucket), at + bucket * width, n[at])

    out = np.zeros(cells, np.int64)
    schema = "bucket int, keys binary, n binary"
    got = rows.select("ids").mapInArrow(run, schema).repartition("bucket").mapInArrow(summed, schema).toArrow().combine_chunks()  # ``cells`` counts at most
    for r in got.to_pylist():
        out[np.frombuffer(r["keys"], np.int64)] = np.frombuffer(r["n"], np.int64)
    return out


def id_counts(training: DataFrame, ids: int) -> np.ndarray:
    kind = id_type(ids)

    def count(n: np.ndarray, part: pa.RecordBatch) -> None:
        n += np.bincount(_joined(part.column("ids"), kind)[0], minlength=ids)

    return _counted(training, ids, count)


def pair_counts(training: DataFrame, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """Counts of class pairs one and two places apart over all training rows."""
    cells, kind = CLASSES * CLASSES, id_type(len(classes.of))

    def count(n: np.ndarray, part: pa.RecordBatch) -> None:
        ids, offsets = _joined(part.column("ids"), kind)
        goal = classes.of[ids]
        first = goal
        for at in (0, cells):
            first = np.roll(first, 1)
            first[offsets[:-1]] = classes.end
            n[at : at + cells] += np.bincount(first * CLASSES + goal, minlength=cells)

    n = _counted(training, 2 * cells, count)
    return n[:cells], n[cells:]


def learn_weights(training: DataFrame, classes: Classes, tables: Tables, tokens: int, shard_tokens: int = 4_000_000, rounds: int = 2) -> dict[str, np.ndarray]:
    """Weights after all rounds; ``tokens`` is the number of training ids."""
    weights, kind = start_weights(), id_type(len(classes.of))
    shards = max(1, math.ceil(tokens / rounds / shard_tokens))
    for turn in range(rounds):
        mine = training.where(F.pmod("order", F.lit(rounds)) == turn).select(F.pmod(F.shiftright("order", 20), F.lit(shards)).cast("int").alias("shard"), "order", "doc_id", "ids")
        mine = mine.repartition(shards, "shard").sortWithinPartitions("shard", "order", "doc_id", "ids").select("shard", "ids")

        def run(batches: Iterator[pa.RecordBatch], weights: dict = weights, turn: int = turn) -> Iterator[pa.RecordBatch]:
            trainer, shard = None, None
            n, total = 0, 0.0

            def closed() -> None:
                nonlocal n, total
                trainer.feed(blocked(np.empty(0, np.int64), np.zeros(1, np.int64), 0)[0], last=True)
                n, total = n + trainer.seen, total + trainer.flat.astype(np.float64) * trainer.seen

            for batch in batches:
                of_row = batch.column("shard").to_numpy()
                edges = np.r_[0, np.flatnonzero(np.diff(of_row)) + 1, len(of_row)] if len(of_row) else []
                for a, b in zip(edges, edges[1:]):
                    if of_row[a] != shard:
                        if trainer is not None:
                            closed()
                        trainer, shard = Trainer(weights, tables, least=32 if turn == 0 else 128), of_row[a]
                    for part in pieces(batch.slice(a, b - a), "ids", size=500_000):
                        ids, offsets = _joined(part.column("ids"), kind)
                        trainer.feed(blocked(classes.of[ids], offsets, classes.end)[0])
            if trainer is not None:
                closed()
            if n:
                yield pa.RecordBatch.from_pydict({"n": [n], "w": [total.tobytes()]})

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, w = 0, 0.0
            for batch in batches:
                for r in batch.to_pylist():
                    n, w = n + r["n"], w + np.frombuffer(r["w"])
            if n:
                yield pa.RecordBatch.from_pydict({"n": [n], "w": [w.tobytes()]})

        parts = mine.mapInArrow(run, "n long, w binary").repartition(8).mapInArrow(summed, "n long, w binary").collect()  # 8 rows at most
        if parts:
            weights = unpack_weights(sum(np.frombuffer(r["w"]) for r in parts) / sum(r["n"] for r in parts))
    return weights


def score_documents(docs: DataFrame, vocabulary: str = VOCABULARY, frequent: int = 65_536, known_part: float = 0.4, shard_tokens: int = 4_000_000, rounds: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per document."""
    spark = docs.sparkSession
    rows_of = _rows(docs, id_col, text_col)
    counts = word_counts(rows_of)
    of_kind = {r["kind"]: r for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct")).collect()}
    documents = of_kind[2]["n"] if 2 in of_kind else 0
    n_words, distinct = (of_kind[0]["n"], of_kind[0]["distinct"]) if 0 in of_kind else (0, 0)
    tokens, types = n_words + documents, distinct + (documents > 0)
    known = counts.where("kind = 0").orderBy(F.desc("n"), "key").limit(frequent).select("key", "n").toArrow()  # ``frequent`` rows
    rows = encoded(rows_of, known, documents, tokens, vocabulary)
    training = rows.where("not held_out")
    of_id = id_counts(training, id_count(vocabulary))
    classes = Classes(of_id, word_starts(vocabulary))
    tables = Tables(*pair_counts(training, classes))
    model = spark.sparkContext.broadcast(Model(classes, learn_weights(training, classes, tables, int(of_id.sum()), shard_tokens, rounds), tables))
    kind = id_type(len(of_id))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "ids", size=1_000_000):
                sizes, word_offsets = _joined(part.column("sizes"), np.int32)
                scores = model.value.score(*_joined(part.column("ids"), kind), sizes, word_offsets, _joined(part.column("known"), np.float32)[0], known_part)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(scores)], ["row", "score"])

    scores = rows.select("row", "ids", "sizes", "known").mapInArrow(run, "row long, score double")
    per_word = counts.where("kind = 0").select("key", F.col("n").alias("c"))
    found = rows.select("row", F.explode("rare").alias("key")).join(per_word, "key")
    rest = found.groupBy("row").agg(F.count(F.lit(1)).alias("n_rest"), F.sum(F.log10(F.col("c") + 1)).alias("log_rest"))
    out = rows.select("row", "doc_id", "held_out", "n_tokens", "n_top", "log_top").join(scores, "row").join(rest, "row", "left")
    log_total = math.log10(tokens + types + 1)
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_top") + F.coalesce("n_rest", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("log_top") + F.coalesce("log_rest", F.lit(0.0)) - F.col("n_tokens") * log_total).alias("base_score"),
        "score",
    )


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
