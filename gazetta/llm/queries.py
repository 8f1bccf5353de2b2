"""The registered queries of the subpackage and their DuckDB twins."""

from __future__ import annotations

from gazetta.llm import (
    byte_bpe, chat_trees, context_mixing, decontaminate, hard_negatives, minhash_dedup, periodic_runs, pu_quality, quality_rules,
    run_index, substring_dedup, token_files, warc,
)

QUERIES = {
    "op6_run_index": run_index.op6_run_index,
    "op2_context_mixing": context_mixing.op2_context_mixing,
    "op1_pu_quality": pu_quality.op1_pu_quality,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op3_warc": warc.op3_warc,
    "op8_token_files": token_files.op8_token_files,
    "op7_byte_bpe": byte_bpe.op7_byte_bpe,
    "op10_minhash_dedup": minhash_dedup.op10_minhash_dedup,
    "op4_substring_dedup": substring_dedup.op4_substring_dedup,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_chat_trees": chat_trees.op12_chat_trees,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}

ORACLE = {
    "op3_warc": warc.ORACLE,
    "op4_substring_dedup": substring_dedup.ORACLE,
    "op9_quality_rules": quality_rules.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_chat_trees": chat_trees.ORACLE,
    "op13_periodic_runs": periodic_runs.ORACLE,
}
