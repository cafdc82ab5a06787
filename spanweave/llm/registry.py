"""Queries of this subpackage by name, and their SQL."""

from __future__ import annotations

from spanweave.llm import chat_format, exact_dedup, hilbert_neighbours, jaccard_join, licenses, mix_sources, packing, pii, token_counts, toxicity


def queries() -> dict:
    return {
        "op1_toxicity": toxicity.op1,
        "op2_pii": pii.op2,
        "op3_chat_format": chat_format.op3,
        "op4_mix_sources": mix_sources.op4,
        "op5_token_counts": token_counts.op5,
        "op6_packing": packing.op6,
        "op7_exact_dedup": exact_dedup.op7,
        "op8_ngram_jaccard": jaccard_join.op8,
        "op9_licenses": licenses.op9,
        "op10_hilbert_neighbours": hilbert_neighbours.op10,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_chat_format": chat_format.OP3_SQL, "op4_mix_sources": mix_sources.OP4_SQL, "op7_exact_dedup": exact_dedup.OP7_SQL, "op10_hilbert_neighbours": hilbert_neighbours.OP10_SQL}
