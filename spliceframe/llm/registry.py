"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from spliceframe.llm import decontam, html_text, inner_top, jaccard, licenses, line_dedup, mixing, neighbours, periodic_runs, pii, secrets, token_align, toxicity

QUERIES = {
    "op1_neighbours": neighbours.op1,
    "op2_html_text": html_text.op2,
    "op3_decontaminate": decontam.op3,
    "op4_licenses": licenses.op4,
    "op5_toxicity": toxicity.op5,
    "op6_source_mix": mixing.op6,
    "op7_pii": pii.op7,
    "op8_jaccard_join": jaccard.op8,
    "op9_secrets": secrets.op9,
    "op10_line_dedup": line_dedup.op10,
    "op11_periodic_runs": periodic_runs.op11,
    "op12_inner_top": inner_top.op12,
    "op13_token_alignment": token_align.op13,
}
ORACLE_SQL = {
    "op3_decontaminate": decontam.OP3_SQL,
    "op4_licenses": licenses.OP4_SQL,
    "op6_source_mix": mixing.OP6_SQL,
    "op7_pii": pii.OP7_SQL,
    "op9_secrets": secrets.OP9_SQL,
    "op10_line_dedup": line_dedup.OP10_SQL,
}
