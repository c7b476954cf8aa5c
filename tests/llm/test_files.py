"""WARC archives, token files and packing: exact round trips."""

import hashlib
import io
import random
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridloom.llm import packing, textual, token_files, tokens, warc


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokens.vocabulary_path(tokens.VOCABULARY))


def test_warc_round_trip(spark):
    big = "<p>é</p>" * 50
    rows = [(1, "http://a/\n", big), (2, "http://ä/", big), (0, None, "short"), (9, "u", "short"), (3, "u", None), (4, "u", ""), (5, "u", "z" * 300_000), (None, "u", big), (2, "http://ä/", big), (7, "u", "y" * 100), (8, "u", "y" * 100)]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], "page_id long, url string, html string, digest int, refers_to string").repartition(3)
    got = warc.round_trip(df, keep_payload=True).collect()
    first = {big: 1, "y" * 100: 7}
    assert len(got) == len(rows)
    want = []
    for i, _, h in rows:
        h = h or ""
        f = first.get(h)
        again = f is not None and i != f
        want.append((i, len(h.encode()), hashlib.sha256(h.encode()).hexdigest(), "revisit" if again else "response", f if again else None))
    assert sorted(map(str, want)) == sorted(str((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])) for r in got)
    assert all(hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"] for r in got if r["record_type"] == "response")
    assert warc.round_trip(df.where("false")).count() == 0


def test_damaged_archives_raise():
    def record(payload, digest=None):
        return warc.member(1, "u", payload, digest or hashlib.sha256(payload).hexdigest(), None, False)

    whole = record(b"a" * 5000) + record(b"b")
    assert [r["payload_bytes"] for r in warc.read_records(io.BytesIO(whole), chunk=7)] == [5000, 1]
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.read_records(io.BytesIO(whole[:-6])))
    with pytest.raises(ValueError, match="digest"):
        list(warc.read_records(io.BytesIO(record(b"abc", "0" * 64))))


SPECIAL = "<|endoftext|>"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([SPECIAL, " ", "\n", "a", "Ab", "'s", ".", "1", "\t", "\x0b", "\x00", "\x01", "\x1c", "\x85", "\u3000", "\xa0", "é", "ß", "zqx", "<|", "漢"]), max_size=25).map("".join), max_size=6))
def test_ids_are_those_of_the_plain_library(tokenizer, texts):
    ids, offsets = tokens.encoder().encode(pa.array([*texts, None], pa.string()), 7)
    got = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    assert got == [[*tokenizer.encode(t, add_special_tokens=False).ids, 7] for t in [*texts, ""]]


def test_many_random_texts_with_special_tokens(tokenizer):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeéßz'-.,1") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choice(words) if rng.random() < 0.9 else rng.choice([SPECIAL, SPECIAL + SPECIAL, "x" + SPECIAL, SPECIAL + "y", "\n", ""]) for _ in range(rng.randint(0, 30))) for _ in range(10_000)]
    enc = tokens.Encoder(tokens.VOCABULARY)
    for some in (texts[:5000], texts[5000:]):  # the second part meets a memo
        ids, offsets = enc.encode(pa.array(some))
        want = [e.ids for e in tokenizer.encode_batch(some, add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want


def test_plain_reading_of_special_names():
    ids, _ = tokens.encoder(plain=True).encode(pa.array(["a " + SPECIAL]))
    assert 50256 not in ids and 50256 in tokens.encoder().encode(pa.array(["a " + SPECIAL]))[0]


def test_a_full_memo_keeps_ids_right(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO", 50)
    rng = random.Random(9)
    enc = tokens.Encoder(tokens.VOCABULARY)
    for _ in range(30):
        texts = [" ".join(str(rng.randrange(80)) + "x" for _ in range(10)) for _ in range(5)]
        ids, offsets = enc.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(enc.place) <= 100


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aB é\n\t\x0b\x0c\r\x1c\x85\u3000", max_size=20), max_size=5))
def test_words_and_pieces(texts):
    parts = textual.ascii_words(pa.array([*texts, None], pa.string()))
    names = parts.distinct.to_pylist()
    got = [[names[c].encode() for c in parts.codes[a:b]] for a, b in zip(parts.offsets, parts.offsets[1:])]
    assert got == [t.encode().lower().split() for t in [*texts, ""]]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    assert [t for p in textual.pieces(batch, rows=2, size=9) for t in p.column("text").to_pylist()] == texts


def ids_of(tokenizer, text, end):
    return array("I", [*tokenizer.encode(text or "", add_special_tokens=False).ids, end])


def test_token_files(docs, corpus, none, tokenizer):
    got = token_files.read_token_files(token_files.write_token_files(docs, folder(docs))).collect()
    want, start = [], 0
    for i, t, _ in sorted(corpus, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = ids_of(tokenizer, t, 0)
        want.append((i, len(ids), zlib.crc32(ids.tobytes())))
    got = sorted(got, key=lambda r: r["start"])
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["n_tokens"], r["ids_crc32"])) for r in got)
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    order = [r["doc_id"] for r in got]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    assert token_files.read_token_files(token_files.write_token_files(none, folder(none))).count() == 0


def folder(df):
    from gridloom.llm.common import scratch_path

    return scratch_path(df.sparkSession, "test")


def test_random_access_and_checksums(tmp_path):
    texts = {7: b"\1\0\0\0", None: b"", 9: bytes(range(256)) * 40}
    path = tmp_path / "x.tok.zst"
    with open(path, "wb") as f:
        w = token_files.Writer(f)
        for k, v in texts.items():
            w.add(k, v)
        w.close()
    with open(path, "rb") as f:
        r = token_files.Reader(f)
        assert r.find(9) == [texts[9]] and r.find(None) == [b""] and r.find(8) == []
        place = r.places[2]
    data = bytearray(path.read_bytes())
    data[place + 20] ^= 255
    with pytest.raises(Exception):
        token_files.Reader(io.BytesIO(bytes(data))).read(2)


def test_packing(docs, corpus, none, tokenizer):
    capacity = 64
    got = packing.pack(docs, capacity).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    want = defaultdict(list)
    total = 0
    for i, t, _ in corpus:
        ids = ids_of(tokenizer, t, 2)
        total += len(ids)
        for k, (a, n) in enumerate(packing.cut(len(ids), capacity)):
            want[i].append((k, a, n, zlib.crc32(ids[a : a + n].tobytes())))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    for v in bins.values():
        at = 0
        for offset, n in sorted(v):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(bins) <= -(-total // capacity) + 4
    assert packing.pack(none).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=200))
def test_pack_histogram_uses_every_item(items):
    counts = {x: items.count(x) for x in set(items)}
    classes = packing.pack_histogram(counts, 32)
    used = defaultdict(int)
    for pattern, n in classes:
        assert sum(x * k for x, k in pattern) <= 32
        for x, k in pattern:
            used[x] += k * n
    assert dict(used) == counts
    bins = sum(n for _, n in classes)
    ffd = []
    for x in sorted(items, reverse=True):
        at = next((k for k, free in enumerate(ffd) if free >= x), None)
        if at is None:
            ffd.append(32 - x)
        else:
            ffd[at] -= x
    assert bins <= len(ffd) + max(1, len(ffd) // 10)
    slots = packing.slot_table(classes)
    for x, rows in slots.items():
        assert rows[0, 0] == 0 and np.all(np.diff(rows[:, 0]) > 0)
