"""Queries of this subpackage and their SQL, as ``__spark_entry__.py`` registers them."""

from __future__ import annotations

from . import exact_dedup, lm, minhash, mixing, packing, sharding, token_files, topk, toxicity, warc

QUERIES = {
    "op1_topk": topk.op1_topk,
    "op2_minhash": minhash.op2_minhash,
    "op3_warc": warc.op3_warc,
    "op4_sharding": sharding.op4_sharding,
    "op5_mixing": mixing.op5_mixing,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_lm": lm.op7_lm,
    "op8_token_files": token_files.op8_token_files,
    "op9_packing": packing.op9_packing,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
}

ORACLES = {
    "op1_topk": topk.ORACLE_SQL,
    "op3_warc": warc.ORACLE_SQL,
    "op10_exact_dedup": exact_dedup.ORACLE_SQL,
}
