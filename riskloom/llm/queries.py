"""Registered queries of this package and their DuckDB texts."""

from __future__ import annotations

from riskloom.llm import bpe, chat, collocations, decontam, divergence, exact_dedup, jaccard_join, lm_scoring, order_minhash, pii, quality, token_counts, warc

QUERIES = {
    "op1_quality": quality.query,
    "op2_bpe": bpe.query,
    "op3_chat_format": chat.query,
    "op4_warc": warc.query,
    "op5_minhash": order_minhash.query,
    "op6_decontam": decontam.query,
    "op7_pii": pii.query,
    "op8_lm_scoring": lm_scoring.query,
    "op9_token_counts": token_counts.query,
    "op10_exact_dedup": exact_dedup.query,
    "op11_jaccard_join": jaccard_join.query,
    "op12_divergence": divergence.query,
    "op13_collocations": collocations.query,
}
CHECKS = {
    "op3_chat_format": chat.CHECK,
    "op4_warc": warc.CHECK,
    "op10_exact_dedup": exact_dedup.CHECK,
    "op12_divergence": divergence.CHECK,
    "op13_collocations": collocations.CHECK,
}
