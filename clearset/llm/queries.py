"""The queries of this package and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from clearset.llm import decontamination, graph_ann, importance, lang_id, line_dedup, main_text, masked_lm, ngram_join, runs, secrets, sentencepiece_viterbi, token_files, toxicity

QUERIES = {
    "op1_token_files": token_files.op1_token_files,
    "op2_secret_ownership": secrets.op2_secret_ownership,
    "op3_graph_ann": graph_ann.op3_graph_ann,
    "op4_masked_lm": masked_lm.op4_masked_lm,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_language_id": lang_id.op6_language_id,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_decontamination": decontamination.op8_decontamination,
    "op9_sentencepiece": sentencepiece_viterbi.op9_sentencepiece,
    "op10_ngram_join": ngram_join.op10_ngram_join,
    "op11_runs": runs.op11_runs,
    "op12_importance": importance.op12_importance,
    "op13_main_text": main_text.op13_main_text,
}

SQL = {
    "op2_secret_ownership": secrets.OP2_SQL,
    "op5_line_dedup": line_dedup.OP5_SQL,
    "op8_decontamination": decontamination.OP8_SQL,
    "op10_ngram_join": ngram_join.OP10_SQL,
    "op12_importance": importance.OP12_SQL,
}
