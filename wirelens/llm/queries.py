"""The queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wirelens.llm import ann, jaccard_join, language_id, line_dedup, mixing, packing, preference, quality, repair, sharding, spelling, token_counts, url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": quality.op1_quality_rules,
        "op2_line_dedup": line_dedup.op2_line_dedup,
        "op3_chat_preference": preference.op3_chat_preference,
        "op4_best_fit_packing": packing.op4_best_fit_packing,
        "op5_jaccard_join": jaccard_join.op5_jaccard_join,
        "op6_language_id": language_id.op6_language_id,
        "op7_url_filter": url_filter.op7_url_filter,
        "op8_sharding": sharding.op8_sharding,
        "op9_pfair_mixing": mixing.op9_pfair_mixing,
        "op10_nearest_neighbours": ann.op10_nearest_neighbours,
        "op11_token_counts": token_counts.op11_token_counts,
        "op12_spelling_variants": spelling.op12_spelling_variants,
        "op13_conversation_repair": repair.op13_conversation_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": line_dedup.OP2_SQL,
        "op3_chat_preference": preference.OP3_SQL,
        "op12_spelling_variants": spelling.OP12_SQL,
        "op13_conversation_repair": repair.OP13_SQL,
    }
