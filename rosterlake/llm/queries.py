"""One query per operator, and the SQL of those that SQL can express."""

from . import (decontamination, filter_audit, html_text, licenses, mixing, near_duplicates, secrets, substring_dedup, surrogates,
               token_alignment, topk_search, toxicity, url_filter)

QUERIES = {
    "op1_secrets": secrets.op1_secrets,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_near_duplicates": near_duplicates.op3_near_duplicates,
    "op4_decontamination": decontamination.op4_decontamination,
    "op5_mixing": mixing.op5_mixing,
    "op6_html_text": html_text.op6_html_text,
    "op7_url_filter": url_filter.op7_url_filter,
    "op8_topk_search": topk_search.op8_topk_search,
    "op9_licenses": licenses.op9_licenses,
    "op10_surrogates": surrogates.op10_surrogates,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_token_alignment": token_alignment.op12_token_alignment,
    "op13_substring_dedup": substring_dedup.op13_substring_dedup,
}
ORACLES = {"op5_mixing": mixing.ORACLE, "op8_topk_search": topk_search.ORACLE,
           "op11_filter_audit": filter_audit.ORACLE}
