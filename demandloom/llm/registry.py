"""Queries of the corpus operators, and the SQL that states the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from demandloom.llm import audio, curve, divergence, language, line_dedup, mixing, near_dedup, nearest, packing, pii, search, token_output, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_token_output": token_output.op2_token_output,
        "op3_graph_nearest": nearest.op3_graph_nearest,
        "op4_pii": pii.op4_pii,
        "op5_language_id": language.op5_language_id,
        "op6_curriculum_mixing": mixing.op6_curriculum_mixing,
        "op7_line_dedup": line_dedup.op7_line_dedup,
        "op8_audio_features": audio.op8_audio_features,
        "op9_bagminhash_near_dedup": near_dedup.op9_bagminhash_near_dedup,
        "op10_best_fit_packing": packing.op10_best_fit_packing,
        "op11_source_divergence": divergence.op11_source_divergence,
        "op12_curve_packing": curve.op12_curve_packing,
        "op13_ranked_search": search.op13_ranked_search,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_pii": pii.OP4_SQL, "op6_curriculum_mixing": mixing.OP6_SQL, "op7_line_dedup": line_dedup.OP7_SQL, "op11_source_divergence": divergence.OP11_SQL, "op13_ranked_search": search.OP13_SQL}
