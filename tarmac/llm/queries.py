"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from tarmac.llm import (
    chat_events,
    collocations,
    curriculum,
    fm_dedup,
    fp_tree,
    itq_dedup,
    jaccard_join,
    lang_backoff,
    lbl_score,
    line_frequency,
    mil_toxicity,
    token_binary,
    winnowing,
)

QUERIES = {
    "op1_itq_dedup": itq_dedup.op1_query,
    "op2_winnowing_decontamination": winnowing.op2_query,
    "op3_fm_dedup": fm_dedup.op3_query,
    "op4_jaccard_join": jaccard_join.op4_query,
    "op5_lbl_score": lbl_score.op5_query,
    "op6_token_binary": token_binary.op6_query,
    "op7_chat_events": chat_events.op7_query,
    "op8_lang_backoff": lang_backoff.op8_query,
    "op9_curriculum_mix": curriculum.op9_query,
    "op10_mil_toxicity": mil_toxicity.op10_query,
    "op11_fp_tree_search": fp_tree.op11_query,
    "op12_line_frequency": line_frequency.op12_query,
    "op13_collocations": collocations.op13_query,
}
ORACLE = {
    "op1_itq_dedup": itq_dedup.OP1_SQL,
    "op2_winnowing_decontamination": winnowing.OP2_SQL,
    "op3_fm_dedup": fm_dedup.OP3_SQL,
    "op4_jaccard_join": jaccard_join.OP4_SQL,
    "op7_chat_events": chat_events.OP7_SQL,
    "op9_curriculum_mix": curriculum.OP9_SQL,
    "op11_fp_tree_search": fp_tree.OP11_SQL,
    "op12_line_frequency": line_frequency.OP12_SQL,
    "op13_collocations": collocations.OP13_SQL,
}
