"""Queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

import corpus_pipeline
from millrace.llm import (audit, chat, decontaminate, language, mixing, neardup, pieces, private, quality,
                          suffix_tree, toxicity, trie, wrappers)

QUERIES = {
    "op1_chat_format": chat.op1_chat_format,
    "op2_near_duplicates": neardup.op2_near_duplicates,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_language": language.op4_language,
    "op5_suffix_tree_scores": suffix_tree.op5_suffix_tree_scores,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_main_text": wrappers.op7_main_text,
    "op8_quality_rules": quality.op8_quality_rules,
    "op9_mix_sources": mixing.op9_mix_sources,
    "op10_personal_data": private.op10_personal_data,
    "op11_filter_audit": audit.op11_filter_audit,
    "op12_piece_ids": pieces.op12_piece_ids,
    "op13_prefix_trie": trie.op13_prefix_trie,
    "pipeline": corpus_pipeline.run,
}
SQL = {
    "op1_chat_format": chat.SQL_op1,
    "op2_near_duplicates": neardup.SQL_op2,
    "op6_decontaminate": decontaminate.SQL_op6,
    "op9_mix_sources": mixing.SQL_op9,
    "op11_filter_audit": audit.SQL_op11,
    "op13_prefix_trie": trie.SQL_op13,
}
