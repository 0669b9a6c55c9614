"""The subpackage's queries, one for each operator, and SQL for those that SQL can express."""

from __future__ import annotations

from . import (align, decontaminate, imatch, lang_id, licenses, near_dup, packing, quality, sharding, token_count, topk, url_filter,
               variants)

QUERIES = {
    "op1_url_filters": url_filter.op1,
    "op2_minhash_near_dedup": near_dup.op2,
    "op3_license_scans": licenses.op3,
    "op4_sharding": sharding.op4,
    "op5_exact_top_k": topk.op5,
    "op6_language_id": lang_id.op6,
    "op7_best_fit_packing": packing.op7,
    "op8_token_counts": token_count.op8,
    "op9_quality_classifier": quality.op9,
    "op10_benchmark_decontamination": decontaminate.op10,
    "op11_spelling_variants": variants.op11,
    "op12_document_fingerprints": imatch.op12,
    "op13_cross_tokenizer_alignment": align.op13,
}

ORACLES = {"op2_minhash_near_dedup": near_dup.ORACLE, "op5_exact_top_k": topk.ORACLE}
