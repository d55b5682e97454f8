"""The corpus queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from tallyline.llm.curriculum import OP7_SQL, op7_curriculum_mix
from tallyline.llm.disclosure import op4_disclosure
from tallyline.llm.doubling_dedup import OP11_SQL, op11_doubling_dedup
from tallyline.llm.html_paths import op2_tag_path_text
from tallyline.llm.merkle import op1_merkle_fingerprints
from tallyline.llm.packing import op9_best_fit_packing
from tallyline.llm.pair_bitmaps import op12_pair_bitmaps
from tallyline.llm.part_enum import OP8_SQL, op8_part_enum
from tallyline.llm.setm import OP13_SQL, op13_setm_phrases
from tallyline.llm.site_bayes import OP10_SQL, op10_site_bayes
from tallyline.llm.suffix_dedup import op6_suffix_dedup
from tallyline.llm.token_fst import op3_token_counts
from tallyline.llm.topk import OP5_SQL, op5_histogram_top_k

QUERIES = {
    f.__name__: f
    for f in (
        op1_merkle_fingerprints,
        op2_tag_path_text,
        op3_token_counts,
        op4_disclosure,
        op5_histogram_top_k,
        op6_suffix_dedup,
        op7_curriculum_mix,
        op8_part_enum,
        op9_best_fit_packing,
        op10_site_bayes,
        op11_doubling_dedup,
        op12_pair_bitmaps,
        op13_setm_phrases,
    )
}
ORACLES = {
    "op5_histogram_top_k": OP5_SQL,
    "op7_curriculum_mix": OP7_SQL,
    "op8_part_enum": OP8_SQL,
    "op10_site_bayes": OP10_SQL,
    "op11_doubling_dedup": OP11_SQL,
    "op13_setm_phrases": OP13_SQL,
}
