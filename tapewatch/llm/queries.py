"""The named queries of this subpackage and the SQL they must agree with."""

from __future__ import annotations

from tapewatch.llm import (collocations, exact_dedup, language_id, line_dedup, mixing, near_dedup, packing, repeats, search,
                           token_counts, token_files, two_fit, whitening)

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_top_k_search": search.op2_top_k_search,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_token_files": token_files.op4_token_files,
    "op5_near_dedup": near_dedup.op5_near_dedup,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_repeated_strings": repeats.op8_repeated_strings,
    "op9_pack_along_curve": packing.op9_pack_along_curve,
    "op10_language_id": language_id.op10_language_id,
    "op11_whiten": whitening.op11_whiten,
    "op12_best_two_fit": two_fit.op12_best_two_fit,
    "op13_collocations": collocations.op13_collocations,
}

ORACLES = {
    "op1_mix_sources": mixing.OP1_SQL,
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op7_line_dedup": line_dedup.OP7_SQL,
    "op13_collocations": collocations.OP13_SQL,
}
