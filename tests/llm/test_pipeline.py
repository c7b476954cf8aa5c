"""The pipeline's stages, each against a plain-Python version of it over what the stage before kept."""

import math
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
from test_models import planted
from test_native import levels
from test_pairs import near
from tokenizers import Tokenizer

from gridloom.llm import toxicity
from gridloom.llm.tokens import VOCABULARY, vocabulary_path

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    ids = {r["doc_id"] for r in docs.collect()}
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, SF)
        rows = out.collect()
        assert {r["doc_id"] for r in rows} <= ids and rows
        if name != "packing":
            assert out.columns == columns
            if name in ("exact_dedup",):
                assert len({r["text"] for r in rows}) == len(rows) == docs.select("text").distinct().count()
            docs = spark.createDataFrame(rows, docs.schema)


def harmless(rows, weights, intercept):
    """Rows whose distinct words' n-grams weigh less than nothing."""

    def logit(text):
        words = {w.strip(toxicity.PUNCTUATION) for w in (text or "").lower().split()} - {""}
        return sum(weights.get(g, 0) for w in words for g in toxicity.grams(w)) + intercept

    return [r for r in rows if logit(r["text"]) < 0]


def greatest_of_equal(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["text"] or ""].append(r["doc_id"])
    return Counter((max((i for i in ids if i is not None), default=None), t) for t, ids in groups.items())


def mixture(spark, docs, rows):
    """How often each row is drawn: whole passes, then down the permutation over what overruns
    the quota, then the one that comes nearest to it."""
    count = lambda r: len((r["text"] or "").encode().split())
    keys = docs.selectExpr("doc_id", "text", "xxhash64(7919, doc_id, xxhash64(coalesce(text, ''))) AS h").collect()
    key_of = {(r["doc_id"], r["text"]): r["h"] for r in keys}
    cells, sizes, lines = math.isqrt(len(rows)), Counter(), defaultdict(list)
    for r in rows:
        h = key_of[r["doc_id"], r["text"]]
        sizes[r["source"]] += count(r)
        lines[r["source"]].append((int(((h % 2**64) >> 11) * 2.0**-53 * cells), h, r["doc_id"], count(r)))
    out = Counter()
    for s, target in levels(sizes).items():
        passes = int(target // sizes[s]) if sizes[s] else 0
        gap, left = target - passes * sizes[s], []
        for *_, i, n in sorted(lines[s], key=lambda x: x[:2]):
            took = 0 < n <= gap
            gap -= n * took
            left += [] if took else [(i, n)]
            out[i] += (passes + took) * (n > 0)
        nearer = [(abs(gap - n), k) for k, (_, n) in enumerate(left) if abs(gap - n) < gap]
        if nearer:
            out[left[min(nearer)[1]][0]] += 1
    return +out


def cut(rows, capacity=1024):
    """doc_id, piece, start, length, checksum of every piece."""
    tokenizer, out = Tokenizer.from_file(vocabulary_path(VOCABULARY)), []
    for r in rows:
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        ends = range(len(ids) % capacity or capacity, len(ids) + 1, capacity) if len(ids) > capacity else [len(ids)]
        at = 0
        for k, end in enumerate(ends):
            out.append((r["doc_id"], k, at, end - at, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[at:end]))))
            at = end
    return out


def bins(lengths, capacity=1024):
    """Number of sequences when single items are matched and best-fitted."""
    large = sorted(x for x in lengths if x > capacity // 3)
    gaps = []
    while large:
        big = large.pop()
        mate = max((k for k, x in enumerate(large) if x <= capacity - big), default=None)
        gaps.append(capacity - big - (0 if mate is None else large.pop(mate)))
    for x in sorted((x for x in lengths if x <= capacity // 3), reverse=True):
        best = min((k for k, g in enumerate(gaps) if g >= x), key=gaps.__getitem__, default=None)
        if best is None:
            gaps.append(capacity - x)
        else:
            gaps[best] -= x
    return len(gaps)


def test_run_against_plain_python(spark, tmp_path, monkeypatch, corpus, docs):
    """Nulls, empty and very long texts, repeated rows, near copies and clashing names, with planted toxic documents."""
    more, marks, bad = planted()
    rows = [*corpus, *([i + 1000, t, f"s{i % 5}"] for i, t in more)]
    bad = {i + 1000 for i in bad}
    table = spark.createDataFrame([(i, t, "en", s, len(t or ""), "d", 1, 2, 3, 4, 5, 6, "m", 7) for i, t, s in rows], docs.schema)
    table.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([*((i + 1000, y) for i, y in marks), *((i, 0) for i in range(100)), (None, 1), (7, None)], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")

    staged, frames, real = {}, {}, corpus_pipeline.stage

    def kept(df, name):
        out = real(df, name)
        staged[name.removeprefix("pipeline-")], frames[name.removeprefix("pipeline-")] = out.collect(), out
        return out

    monkeypatch.setattr(corpus_pipeline, "stage", kept)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert list(staged) == ["toxicity", "exact_dedup", "near_dedup", "mixing"]
    assert all(df.columns == docs.columns for df in frames.values())
    named = lambda rows: Counter((r["doc_id"], r["text"]) for r in rows)

    before = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = toxicity.learned(before, labels)
    assert named(staged["toxicity"]) == named(harmless(before.collect(), *model))
    left = {r["doc_id"] for r in staged["toxicity"]}
    assert len(left & bad) <= 0.03 * len(bad) and len({i for i, _, _ in rows} - bad - left) <= 0.01 * len(rows)

    assert Counter((r["doc_id"], r["text"] or "") for r in staged["exact_dedup"]) == greatest_of_equal(staged["toxicity"])

    groups = near([(r["doc_id"], r["text"]) for r in staged["exact_dedup"] if r["doc_id"] is not None], 5, 80, 100)
    want = [r for r in staged["exact_dedup"] if r["doc_id"] is None or groups[r["doc_id"]][1] == r["doc_id"]]
    assert named(staged["near_dedup"]) == named(want) and len(want) < len(staged["exact_dedup"])

    drawn = Counter(r["doc_id"] for r in staged["mixing"])
    assert drawn == mixture(spark, frames["near_dedup"], staged["near_dedup"]) and max(drawn.values()) > 1

    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == Counter(cut(staged["mixing"]))
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        parts.sort()
        ends = [0, *(a + n for a, n in parts)]
        assert [a for a, _ in parts] == ends[:-1] and ends[-1] <= 1024
    assert len(sequences) == bins([r["length"] for r in packed])
