"""The registered queries of this folder and the SQL of those that SQL can express."""

from __future__ import annotations

from . import (centroid_tables, exact_dedup, language_id, license_scan, mixing, ngram_join, packing, pii, quality,
               suffix_dedup, token_files, url_filter, vector_codes)

QUERIES = {
    "op1_source_mixing": mixing.query,
    "op2_quality_rules": quality.query,
    "op3_best_fit_packing": packing.query,
    "op4_suffix_dedup": suffix_dedup.query,
    "op5_language_id": language_id.query,
    "op6_ngram_jaccard_join": ngram_join.query,
    "op7_exact_dedup": exact_dedup.query,
    "op8_url_filter": url_filter.query,
    "op9_license_scan": license_scan.query,
    "op10_pii": pii.query,
    "op11_vector_codes": vector_codes.query,
    "op12_token_files": token_files.query,
    "op13_centroid_tables": centroid_tables.query,
}

ORACLE_SQL = {
    "op1_source_mixing": mixing.ORACLE,
    "op2_quality_rules": quality.ORACLE,
    "op7_exact_dedup": exact_dedup.ORACLE,
    "op8_url_filter": url_filter.ORACLE,
    "op11_vector_codes": vector_codes.ORACLE,
    "op13_centroid_tables": centroid_tables.ORACLE,
}
