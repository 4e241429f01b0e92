"""Queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from peakframe.llm import conversation_repair, fingerprint, jaccard_join, langid, mixing, packing, ranked_search, revisit, secrets, simhash, telephony, token_counts, toxicity

QUERIES = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_telephony": telephony.op2_telephony,
    "op3_fingerprint": fingerprint.op3_fingerprint,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_simhash": simhash.op5_simhash,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_revisits": revisit.op7_revisits,
    "op8_mixing": mixing.op8_mixing,
    "op9_best_fit": packing.op9_best_fit,
    "op10_language_id": langid.op10_language_id,
    "op11_ranked_search": ranked_search.op11_ranked_search,
    "op12_jaccard_join": jaccard_join.op12_jaccard_join,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
}
ORACLE_SQL = {"op7_revisits": revisit.OP7_SQL, "op8_mixing": mixing.OP8_SQL, "op11_ranked_search": ranked_search.OP11_SQL}
