"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from stockyard.llm import alignment, chat, licenses, linequality, neardup, negatives, packing, quality, substring, tokens, topk, toxicity, warc

QUERIES = {
    "op1_licenses": licenses.op1_licenses,
    "op2_quality": quality.op2_quality,
    "op3_tokens": tokens.op3_tokens,
    "op4_packing": packing.op4_packing,
    "op5_revisits": warc.op5_revisits,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_substring": substring.op7_substring,
    "op8_chat": chat.op8_chat,
    "op9_topk": topk.op9_topk,
    "op10_neardup": neardup.op10_neardup,
    "op11_negatives": negatives.op11_negatives,
    "op12_linequality": linequality.op12_linequality,
    "op13_alignment": alignment.op13_alignment,
}
ORACLES = {
    "op7_substring": substring.ORACLE,
    "op8_chat": chat.ORACLE,
    "op9_topk": topk.ORACLE,
    "op10_neardup": neardup.ORACLE,
    "op11_negatives": negatives.ORACLE,
}
