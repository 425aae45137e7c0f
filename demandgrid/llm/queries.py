"""Queries of the corpus operators and the SQL that says the same, where SQL can."""

from __future__ import annotations

from demandgrid.llm import (alignment, chat, decontamination, lexical, mixing, near_dedup, pii, quality, repeats, secrets,
                            token_counts, toxicity, vectors_topk)

QUERIES = {
    "op10_repeats": repeats.op10_repeats,
    "op11_alignment": alignment.op11_alignment,
    "op12_lexical": lexical.op12_lexical,
    "op13_topk": vectors_topk.op13_topk,
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_mixing": mixing.op2_mixing,
    "op3_quality": quality.op3_quality,
    "op4_chat": chat.op4_chat,
    "op5_decontamination": decontamination.op5_decontamination,
    "op6_secrets": secrets.op6_secrets,
    "op7_near_dedup": near_dedup.op7_near_dedup,
    "op8_pii": pii.op8_pii,
    "op9_toxicity": toxicity.op9_toxicity,
}

ORACLES: dict[str, str] = {
    "op12_lexical": lexical.OP12_SQL,
    "op13_topk": vectors_topk.OP13_SQL,
    "op4_chat": chat.OP4_SQL,
}
