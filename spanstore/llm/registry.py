"""Queries of the operators and the SQL that states them."""

from __future__ import annotations

from . import html_text, jaccard_join, langid, line_dedup, mixing, packing, periodic_runs, quality_rules, sharding, simhash, suffix_dedup, topk_search, vector_codes

QUERIES = {
    "op1_langid": langid.op1_langid,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_shard": sharding.op3_shard,
    "op4_topk": topk_search.op4_topk,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_html_text": html_text.op6_html_text,
    "op7_pack": packing.op7_pack,
    "op8_near_duplicates": jaccard_join.op8_near_duplicates,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_mix": mixing.op10_mix,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_simhash": simhash.op13_simhash,
}

ORACLE_SQL = {
    "op4_topk": topk_search.OP4_SQL,
    "op5_line_dedup": line_dedup.OP5_SQL,
    "op12_vector_codes": vector_codes.OP12_SQL,
}
