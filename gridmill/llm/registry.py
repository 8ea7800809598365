"""The registered queries of this subpackage, and SQL for those that SQL can say."""

from __future__ import annotations

from gridmill.llm import decontamination, media, mixing, perplexity, pieces, pii, repeats, search, secrets, similarity, tokens, toxicity, turns

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_perplexity": perplexity.op2_perplexity,
    "op3_similarity": similarity.op3_similarity,
    "op4_tokens": tokens.op4_tokens,
    "op5_pii": pii.op5_pii,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_media": media.op7_media,
    "op8_secrets": secrets.op8_secrets,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_repeats": repeats.op10_repeats,
    "op11_pieces": pieces.op11_pieces,
    "op12_search": search.op12_search,
    "op13_turns": turns.op13_turns,
}
ORACLE_SQL = {
    "op1_mixing": mixing.OP1_SQL,
    "op8_secrets": secrets.OP8_SQL,
    "op9_decontamination": decontamination.OP9_SQL,
    "op12_search": search.OP12_SQL,
    "op13_turns": turns.OP13_SQL,
}
