"""The subpackage's queries and their SQL, by name."""

from __future__ import annotations

from kinfold.llm import cap_filters, jaccard_join, langid, line_windows, media, mixing, packing, pseudonyms, quality, url_filter

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_language_id": langid.op2_language_id,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_cap_filters": cap_filters.op4_cap_filters,
    "op5_mixing": mixing.op5_mixing,
    "op6_media": media.op6_media,
    "op7_pseudonyms": pseudonyms.op7_pseudonyms,
    "op8_quality": quality.op8_quality,
    "op9_line_windows": line_windows.op9_line_windows,
    "op10_jaccard_join": jaccard_join.op10_jaccard_join,
}

#: Where SQL can express the operator; the others are tested against brute force, round trips or held-out rows.
SQL = {
    "op3_url_filter": url_filter.OP3_SQL,
    "op4_cap_filters": cap_filters.OP4_SQL,
    "op5_mixing": mixing.OP5_SQL,
    "op9_line_windows": line_windows.OP9_SQL,
    "op10_jaccard_join": jaccard_join.OP10_SQL,
}
