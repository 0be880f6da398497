"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from . import decontaminate, html_extract, jaccard_join, language_id, media, packing, pii, secret_scan, sharding, suffix_dedup

QUERIES = {
    "op1_decontamination": decontaminate.query,
    "op2_language_id": language_id.query,
    "op3_secret_scan": secret_scan.query,
    "op4_html_extraction": html_extract.query,
    "op5_best_fit_packing": packing.query,
    "op6_sharding": sharding.query,
    "op7_ngram_jaccard_join": jaccard_join.query,
    "op8_media_columns": media.query,
    "op9_suffix_dedup": suffix_dedup.query,
    "op10_pii": pii.query,
}
ORACLE: dict[str, str] = {"op1_decontamination": decontaminate.SQL, "op7_ngram_jaccard_join": jaccard_join.SQL, "op9_suffix_dedup": suffix_dedup.SQL}
