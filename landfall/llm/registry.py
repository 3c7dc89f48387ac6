"""Registered queries of the operators in this folder and the SQL they must agree with."""

from __future__ import annotations

import corpus_pipeline
from landfall.llm import (
    chunks,
    exact,
    gridcodes,
    jaccard,
    langid,
    leaks,
    linejoin,
    lm,
    minhash,
    negatives,
    packing,
    quotes,
    severity,
)

QUERIES = {
    "op1_lm_scoring": lm.op1_lm_scoring,
    "op2_decontamination": leaks.op2_decontamination,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_exact_dedup": exact.op4_exact_dedup,
    "op5_quotation_linking": quotes.op5_quotation_linking,
    "quotation_chains": quotes.quotation_chains,
    "op6_line_dedup": linejoin.op6_line_dedup,
    "op7_substring_dedup": chunks.op7_substring_dedup,
    "op8_language_id": langid.op8_language_id,
    "op9_toxicity": severity.op9_toxicity,
    "op10_ngram_jaccard_join": jaccard.op10_ngram_jaccard_join,
    "op11_minhash_dedup": minhash.op11_minhash_dedup,
    "op12_grid_codes": gridcodes.op12_grid_codes,
    "op13_hard_negatives": negatives.op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op2_decontamination": leaks.OP2_SQL,
    "op4_exact_dedup": exact.OP4_SQL,
    "op5_quotation_linking": quotes.OP5_SQL,
    "quotation_chains": quotes.CHAINS_SQL,
    "op6_line_dedup": linejoin.OP6_SQL,
    "op10_ngram_jaccard_join": jaccard.OP10_SQL,
    "op11_minhash_dedup": minhash.OP11_SQL,
    "op12_grid_codes": gridcodes.OP12_SQL,
    "op13_hard_negatives": negatives.OP13_SQL,
}
