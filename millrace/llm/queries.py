"""Registered queries of this package and the SQL they are checked against."""

from millrace.llm import (
    byte_bpe,
    embedding_whitening,
    exact_dedup,
    html_extraction,
    jaccard_join,
    language_id,
    line_dedup,
    packing,
    secret_scan,
    spelling_variants,
    token_counts,
    topk_search,
    url_filter,
)

QUERIES = {
    "op1_jaccard_join": jaccard_join.query,
    "op2_secret_scan": secret_scan.query,
    "op3_byte_bpe": byte_bpe.query,
    "op4_token_counts": token_counts.query,
    "op5_packing": packing.query,
    "op6_url_filter": url_filter.query,
    "op7_line_dedup": line_dedup.query,
    "op8_topk_search": topk_search.query,
    "op9_exact_dedup": exact_dedup.query,
    "op10_language_id": language_id.query,
    "op11_spelling_variants": spelling_variants.query,
    "op12_embedding_whitening": embedding_whitening.query,
    "op13_html_extraction": html_extraction.query,
}

ORACLE_SQL = {
    "op6_url_filter": url_filter.SQL,
    "op7_line_dedup": line_dedup.SQL,
    "op8_topk_search": topk_search.SQL,
    "op9_exact_dedup": exact_dedup.SQL,
}
