"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from edumart.llm import embedding_dedup, mixing, packing, pitman_yor, quality_rules, simhash, token_counts, token_records
from edumart.llm import fim, hard_negatives, html_extract, language_id, license_scan
from edumart.llm.quality_sql import QUALITY_SQL

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_embedding_dedup": embedding_dedup.op2_embedding_dedup,
    "op3_license_scan": license_scan.op3_license_scan,
    "op4_token_records": token_records.op4_token_records,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_lm_scoring": pitman_yor.op6_lm_scoring,
    "op7_simhash_dedup": simhash.op7_simhash_dedup,
    "op8_source_mixing": mixing.op8_source_mixing,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_language_id": language_id.op10_language_id,
    "op11_html_extraction": html_extract.op11_html_extraction,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_fill_in_middle": fim.op13_fill_in_middle,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op2_embedding_dedup": embedding_dedup.ORACLE,
    "op8_source_mixing": mixing.oracle(),
    "op9_quality_rules": QUALITY_SQL,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_fill_in_middle": fim.ORACLE,
}
