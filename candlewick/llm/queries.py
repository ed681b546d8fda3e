"""The registered queries of this subpackage: one per operator, and the pipeline."""

from __future__ import annotations

import corpus_pipeline
from candlewick.llm.chunking import op4_substring_dedup
from candlewick.llm.fingerprints import op5_document_fingerprints
from candlewick.llm.lines import OP13_SQL, op13_line_dedup
from candlewick.llm.mixing import OP1_SQL, op1_mix_sources
from candlewick.llm.negatives import OP12_SQL, op12_hard_negatives
from candlewick.llm.neighbours import op2_nearest_neighbours
from candlewick.llm.packing import op7_best_fit_packing
from candlewick.llm.quality import op3_quality_classifier
from candlewick.llm.repair import OP11_SQL, op11_conversation_repair
from candlewick.llm.scoring import op10_lm_scoring
from candlewick.llm.simhash import op8_simhash_near_dedup
from candlewick.llm.suffixes import op6_suffix_array_dedup
from candlewick.llm.tokenfile import op9_token_files

QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_token_files": op9_token_files,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_line_dedup": op13_line_dedup,
    "pipeline": corpus_pipeline.run,
}
SQL = {
    "op1_mix_sources": OP1_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_line_dedup": OP13_SQL,
}
