"""Registered queries of this subpackage and their oracles."""

from __future__ import annotations

from carelake.llm import (decontaminate, hard_negatives, html_extract, importance, language_id, mixing, neighbours, ngram_join, secrets, token_counts,
                          toxicity, url_filter, warc)

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_neighbours": neighbours.op3_neighbours,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_mixing": mixing.op5_mixing,
    "op6_secrets": secrets.op6_secrets,
    "op7_url_filter": url_filter.op7_url_filter,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_ngram_join": ngram_join.op9_ngram_join,
    "op10_html_extract": html_extract.op10_html_extract,
    "op11_warc": warc.op11_warc,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_importance": importance.op13_importance,
}

ORACLES = {
    "op2_decontaminate": decontaminate.SQL,
    "op5_mixing": mixing.SQL,
    "op9_ngram_join": ngram_join.SQL,
    "op11_warc": warc.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_importance": importance.SQL,
}
