"""The registered queries over rows with nulls, repeats, long texts and clashing columns, and over no rows."""

import pytest

from gridloom.llm import exact_dedup, lm, minhash, mixing, packing, sharding, token_files, toxicity

RESULTS = {
    minhash.op2_minhash: "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    sharding.op4_sharding: "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    mixing.op5_mixing: "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    toxicity.op6_toxicity: "doc_id bigint, held_out boolean, score double, predicted int",
    lm.op7_lm: "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    token_files.op8_token_files: "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    packing.op9_packing: "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    exact_dedup.op10_exact_dedup: "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
}


@pytest.mark.parametrize("query", RESULTS, ids=lambda q: q.__name__)
def test_result_columns_and_rows(spark, tmp_path, docs, none, corpus, query):
    labels = spark.createDataFrame([(i, int(i % 9 == 0), None) for i in range(120)] + [(None, 1, 0), (3, None, 1)], "doc_id long, toxic int, quality int")
    for name, rows in (("some", docs), ("none", none)):
        rows.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    out = query(spark, f"{tmp_path}/some")
    got = out.collect()
    wanted = [x.split(" ") for x in RESULTS[query].split(", ")]
    assert [[n, t] for n, t in out.dtypes][: len(wanted)] == wanted
    firsts = [r for r in got if r["piece"] == 0] if query is packing.op9_packing else got
    assert sorted(str(r["doc_id"]) for r in firsts) == sorted(str(i) for i, _, _ in corpus)  # a row per row, repeats and null ids too
    optional = {"doc_id", "keep_id", "component_id", "grown_shard"}
    assert all(r[n] is not None for r in got for n, _ in wanted if n not in optional)
    assert query(spark, f"{tmp_path}/none").count() == 0
