"""Queries of the corpus operators and the SQL for those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from chronosift.llm import langid, line_dedup, mixing, packing, pii, pitman_yor, simhash, token_counts, topk, winnow

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_language_id": langid.op1_language_id,
    "op2_mixing": mixing.op2_mixing,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_pii": pii.op4_pii,
    "op5_simhash": simhash.op5_simhash,
    "op6_lm_score": pitman_yor.op6_lm_score,
    "op7_fingerprints": winnow.op7_fingerprints,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_topk": topk.op9_topk,
    "op10_packing": packing.op10_packing,
}
ORACLES = {"op2_mixing": mixing.OP2_SQL, "op3_line_dedup": line_dedup.OP3_SQL, "op7_fingerprints": winnow.OP7_SQL, "op9_topk": topk.OP9_SQL}
