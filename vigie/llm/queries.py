"""The registered queries of this package: one per operator, over whole tables."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from vigie.llm import chunk_dedup, decontaminate, embedding_dedup, license_scan, line_dedup, mixing, periodic_runs, quality_model, quality_rules, spelling, token_files, url_filter
from vigie.llm.simhash import op8_simhash_pivots

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_attention_mil": quality_model.op1_attention_mil,
    "op2_token_files": token_files.op2_token_files,
    "op3_winnowing": decontaminate.op3_winnowing,
    "op4_sentence_rules": license_scan.op4_sentence_rules,
    "op5_fuzzy_lines": line_dedup.op5_fuzzy_lines,
    "op6_gear_chunks": chunk_dedup.op6_gear_chunks,
    "op7_mix_systematic": mixing.op7_mix_systematic,
    "op8_simhash_pivots": op8_simhash_pivots,
    "op9_quality_mcd": quality_rules.op9_quality_mcd,
    "op10_url_digests": url_filter.op10_url_digests,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_projection_passes": embedding_dedup.op13_projection_passes,
}
ORACLE: dict[str, str] = {
    "op3_winnowing": decontaminate.SQL,
    "op4_sentence_rules": license_scan.SQL,
    "op7_mix_systematic": mixing.SQL,
    "op9_quality_mcd": quality_rules.SQL,
    "op10_url_digests": url_filter.SQL,
    "op11_periodic_runs": periodic_runs.SQL,
    "op12_spelling_variants": spelling.SQL,
    "op13_projection_passes": embedding_dedup.SQL,
}
