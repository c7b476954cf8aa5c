"""Exact dedup, sharding and mixing against plain Python."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

from gridloom.llm import exact_dedup, mixing, sharding


def test_exact_groups(docs, corpus):
    groups = defaultdict(list)
    for i, t, _ in corpus:
        groups[t or ""].append(i)
    for keep, pick in (("max", max), ("min", min)):
        got = exact_dedup.dedup_groups(docs, keep=keep, fan_in=2).collect()
        assert len(got) == len(corpus)
        kept = Counter()
        for r in got:
            text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
            ids = [i for i in groups[text] if i is not None]
            assert r["group_size"] == len(groups[text]) and r["keep_id"] == (pick(ids) if ids else None)
            kept[text] += r["kept"]
        assert set(kept.values()) == {1}


def test_drop_copies_keeps_columns(docs, corpus, none):
    left = exact_dedup.drop_copies(docs, keep="max")
    assert left.columns == docs.columns
    assert Counter(r["text"] or "" for r in left.collect()) == Counter({t or "" for _, t, _ in corpus})
    assert exact_dedup.drop_copies(none).count() == 0 == exact_dedup.dedup_groups(none).count()


def test_shards(docs, corpus, none):
    got = sharding.interleave(docs, shards=7).collect()
    assert len(got) == len(corpus)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    sizes = [len(v) for v in by.values()]
    assert len(by) == 7 and max(sizes) - min(sizes) <= 1
    for v in by.values():
        assert sorted(r["slot"] for r in v) == list(range(len(v)))
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), s) for i, t, s in corpus)
    assert want == Counter((r["id"], r["size"], r["crc"], r["source"]) for r in got)
    total = Counter(s for _, _, s in corpus)
    for v in by.values():  # the mixture holds in each shard to one row of a source
        for s, n in Counter(r["source"] for r in v).items():
            assert abs(n - total[s] * len(v) / len(got)) <= 2
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, sharding.interleave(docs.repartition(3), shards=7).collect()), key=str)
    assert sharding.interleave(none).count() == 0


def levels(sizes, cap=3.0):
    """Shares reset by weight until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    total, done = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in done]
        left = total - sum(done.values())
        now = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        above = [s for s in rest if now[s] > cap * sizes[s]]
        if not above:
            return done | now
        done |= {s: cap * sizes[s] for s in above}


def test_mixing_plan(docs, corpus, none):
    count = lambda t: len((t or "").encode().split())
    sizes = Counter()
    for _, t, s in corpus:
        sizes[s] += count(t)
    want = levels(sizes)
    got = mixing.plan(docs).collect()
    assert len(got) == len(corpus)
    taken = Counter()
    for r in got:
        s = None if r["no_source"] else r["source"]
        assert r["source_size"] == sizes[s] and math.isclose(r["target"], want[s], rel_tol=1e-9)
        assert 0 <= r["copies"] <= 3
        taken[s] += r["copies"] * r["size"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(20, 0.05 * t) or sizes[s] < 200 or s == "s3"
    assert mixing.plan(none).count() == 0 == mixing.mix(none).count()


def test_mix_rows(docs, corpus):
    rows = mixing.mix(docs)
    assert rows.columns == docs.columns
    drawn = Counter(r["doc_id"] for r in rows.collect())
    planned = Counter()
    for r in mixing.plan(docs).collect():
        planned[r["id"]] += r["copies"]
    assert drawn == Counter({k: v for k, v in planned.items() if v})


def test_mixing_query_has_a_row_per_document(spark, tmp_path, corpus):
    """Repeated, null-id and empty rows, against plain counts; each source within one document."""
    rows = [*corpus, [50, "", "s0"], [50, "", "s0"], [50, "", "s0"], [None, "", "s0"], [None, "", "s0"], [None, "two words", None], [None, "two words", None]]
    df = spark.createDataFrame([(i, t, s) for i, t, s in rows], "doc_id long, text string, source string")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    count = lambda t: len((t or "").encode().split())
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += count(t)
    want = levels(sizes)
    out = mixing.op5_mixing(spark, str(tmp_path))
    assert out.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    got = out.collect()
    by_text = Counter((i, count(t), sizes[s]) for i, t, s in rows)
    assert Counter((r["doc_id"], r["size"], r["source_size"]) for r in got) == by_text
    source_of = {(i, count(t), sizes[s]): s for i, t, s in rows}
    taken, longest = Counter(), Counter()
    for r in got:
        s = source_of[r["doc_id"], r["size"], r["source_size"]]
        assert math.isclose(r["target"], want[s], rel_tol=1e-9)
        assert r["taken"] <= 3 * r["size"] and (r["taken"] == 0 if not r["size"] else r["taken"] % r["size"] == 0)
        assert r["taken"] == r["size"] * len(r["shards"])
        taken[s] += r["taken"]
        longest[s] = max(longest[s], r["size"])
    assert all(abs(taken[s] - t) <= longest[s] for s, t in want.items())
    key = lambda r: (str(r["doc_id"]), r["size"], r["source_size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, mixing.op5_mixing(spark, str(tmp_path)).collect()))


def test_quotas_are_exact(spark):
    goal = spark.createDataFrame([(False, f"s{k:03d}", float(1 + k * k % 977)) for k in range(100)] + [(True, "", 1e-6), (False, "none", 0.0)], "no_source boolean, source string, target double")
    got = mixing.quotas(goal, 500).collect()
    total = sum(r["target"] for r in got)
    assert len(got) == 101 and sum(r["quota"] for r in got) == 500
    assert all(r["quota"] >= 1 and abs(r["quota"] - 1 - (500 - 101) * r["target"] / total) < 1 for r in got)
    assert {r["quota"] for r in mixing.quotas(goal, 20).collect()} == {1}


def test_shards_hold_the_mixture(spark):
    """Every draw lies in one shard, and blocks of a source are spread as the law says."""
    df = spark.createDataFrame([(i, "w " * (5 + i % 9), f"s{i % 3}") for i in range(3000)], "doc_id long, text string, source string")
    planned = mixing.stage(mixing.plan(df), "test-plan")
    got = mixing.draws(planned, shard_words=4000, blocks_per_shard=64).collect()
    assert len(got) == sum(r["copies"] for r in planned.collect())
    words, shares = Counter(), defaultdict(Counter)
    for r in got:
        words[r["shard"]] += r["size"]
        shares[r["source"]][r["shard"]] += r["size"]
    assert len(words) == 8 and max(words.values()) < 1.4 * min(words.values())
    for s in shares.values():
        assert len(s) == 8  # about ten blocks of the rarest source in each of them


def test_tree_splits_blocks_evenly(spark):
    blocks = spark.createDataFrame([(False, f"s{k % 3}", k) for k in range(96)], "no_source boolean, source string, block long")
    got = mixing.split_tree(blocks, 3, 1).collect()
    assert set(Counter(r["shard"] for r in got).values()) == {12}


def misses(planned):
    """Per source what is missing, and the sizes of the documents its last pass left out."""
    out = {}
    for r in planned:
        miss, left = out.setdefault(r["source"], [r["target"], []])
        out[r["source"]][0] = miss - r["copies"] * r["size"]
        if r["size"] and r["copies"] == r["target"] // r["source_size"]:
            left.append(r["size"])
    return out


def test_no_document_left_out_brings_a_source_nearer(spark, docs):
    rows = [(100 * s + i, "w " * (3000 if i == 0 else 5 + i % 7), f"s{s}") for s in range(9) for i in range(90)]
    long_ones = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for df in (docs, long_ones):
        for miss, left in misses(mixing.plan(df).collect()).values():
            assert miss <= 1e-6 or all(abs(miss - size) >= miss - 1e-6 for size in left)


def test_merge_is_sorted_and_hands_over_runs(docs):
    """Every round exchanges by lane and run only, and aggregates sorted input."""
    base = exact_dedup.stage(exact_dedup.digests(docs), "test-digests")
    plan = exact_dedup.winners(base, "min", fan_in=2)._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.split("Initial Plan")[-1].split("\n")]
    exchanges = [x for x in lines if "Exchange" in x]
    assert len(exchanges) >= 3 and all("hashpartitioning(lane" in x and "digest" not in x.split("hashpartitioning")[1].split("]")[0] for x in exchanges)
    assert not [x for x in lines if "HashAggregate" in x]
    assert len([x for x in lines if "Sort [lane" in x]) == len(exchanges) and [x for x in lines if "SortAggregate" in x]


def test_copies_that_fill_the_table(spark):
    rows = [(i, "same") for i in range(3000)] + [(i, f"t{i % 700}") for i in range(3000, 6000)]
    got = exact_dedup.dedup_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    text = dict(rows)
    assert len(got) == len(rows) and all((r["keep_id"], r["group_size"], r["kept"]) == (min(g := groups[text[r["doc_id"]]]), len(g), r["doc_id"] == min(g)) for r in got)


def test_shards_against_a_plain_sort(spark, docs, corpus):
    """Shard and slot of every row from one sort of each source and one of the whole table."""
    shards, total = 7, len(corpus)
    cells = math.isqrt(total)
    facts = [(i, s, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, s in corpus]
    keyed = spark.createDataFrame(facts, "id long, source string, size long, crc long").selectExpr("id", "source", "size", "crc", "xxhash64(20240607, id, crc, size) AS key").collect()
    null_first = lambda x: (x is not None, x or 0)
    ties = lambda r: (r["key"], null_first(r["id"]), r["crc"], r["size"])
    by_source = defaultdict(list)
    for r in keyed:
        by_source[r["source"]].append(r)
    order = []
    for s, rows in by_source.items():
        rows.sort(key=lambda r: (int(((r["key"] % 2**64) >> 11) * 2.0**-53 * cells), ties(r)))
        order += [((k + 0.5) / len(rows), s is None, s or "", ties(r), r) for k, r in enumerate(rows)]
    order.sort(key=lambda x: x[:4])
    want = Counter()
    for pos, (*_, r) in enumerate(order):
        shard = pos * shards // total
        want[r["id"], r["source"], r["size"], r["crc"], shard, pos - -(-shard * total // shards)] += 1
    got = Counter((r["id"], r["source"], r["size"], r["crc"], r["shard"], r["slot"]) for r in sharding.interleave(docs, shards=shards).collect())
    assert got == want
