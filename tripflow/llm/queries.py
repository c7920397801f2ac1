"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from tripflow.llm import (
    filter_audit, fingerprint, html_text, jaccard, language, mixing, packing, quality, spelling, token_counts, topk,
    toxicity, warc,
)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_warc": warc.op2_warc,
    "op3_topk": topk.op3_topk,
    "op4_mixing": mixing.op4_mixing,
    "op5_fingerprint": fingerprint.op5_fingerprint,
    "op6_html_text": html_text.op6_html_text,
    "op7_jaccard_join": jaccard.op7_jaccard_join,
    "op8_packing": packing.op8_packing,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_quality": quality.op10_quality,
    "op11_language": language.op11_language,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_spelling": spelling.op13_spelling,
}

ORACLES = {
    "op2_warc": warc.SQL,
    "op3_topk": topk.SQL,
    "op4_mixing": mixing.SQL,
    "op7_jaccard_join": jaccard.SQL,
    "op12_filter_audit": filter_audit.SQL,
}
