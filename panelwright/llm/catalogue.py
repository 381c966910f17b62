"""The registered queries of this subpackage."""

from __future__ import annotations

import corpus_pipeline

from .bpe import op6_byte_bpe
from .counts import op11_token_counts
from .jaccard import op9_ngram_jaccard_join
from .language import op5_language_id
from .licenses import op3_license_scans
from .lm import op10_lm_scoring
from .merkle import OP12_SQL, op12_merkle_manifest
from .packing import op7_best_fit_packing
from .pii import op1_pii
from .quality import op2_quality_rules
from .repair import op13_conversation_repair
from .urls import OP4_SQL, op4_url_filters
from .vectors import op8_embedding_near_dedup


def queries() -> dict:
    return {
        "op1_pii": op1_pii,
        "op2_quality_rules": op2_quality_rules,
        "op3_license_scans": op3_license_scans,
        "op4_url_filters": op4_url_filters,
        "op5_language_id": op5_language_id,
        "op6_byte_bpe": op6_byte_bpe,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_embedding_near_dedup": op8_embedding_near_dedup,
        "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
        "op10_lm_scoring": op10_lm_scoring,
        "op11_token_counts": op11_token_counts,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_conversation_repair": op13_conversation_repair,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict:
    return {"op4_url_filters": OP4_SQL, "op12_merkle_manifest": OP12_SQL}
