"""One query for each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from shopstrata.llm import (
    bpe,
    chat_format,
    embedding_dedup,
    exact_dedup,
    hmm,
    mixing,
    near_dedup,
    oracles,
    periodic,
    sharding,
    spelling,
    substring,
    toxicity,
    warc,
)

QUERIES = {
    "op1_substring": substring.query,
    "op2_mixing": mixing.query,
    "op3_bpe": bpe.query,
    "op4_near_dedup": near_dedup.query,
    "op5_chat_format": chat_format.query,
    "op6_embedding_dedup": embedding_dedup.query,
    "op7_toxicity": toxicity.query,
    "op8_hmm": hmm.query,
    "op9_sharding": sharding.query,
    "op10_exact_dedup": exact_dedup.query,
    "op11_periodic": periodic.query,
    "op12_warc": warc.query,
    "op13_spelling": spelling.query,
}

ORACLES = {
    "op1_substring": oracles.REPEATS,
    "op2_mixing": mixing.SQL,
    "op4_near_dedup": oracles.NEAR,
    "op5_chat_format": chat_format.SQL,
    "op6_embedding_dedup": oracles.VECTORS,
    "op9_sharding": oracles.SHARDS,
    "op10_exact_dedup": exact_dedup.SQL,
    "op11_periodic": oracles.RUNS,
    "op12_warc": warc.SQL,
    "op13_spelling": oracles.SPELLING,
}
