"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import additive_ann, delta_lloyd, exact_dedup, license_scan, mixing, packing, pii, repetition, simhash, spelling, token_counts, token_files, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": exact_dedup.op1_exact_dedup,
        "op2_source_mixing": mixing.op2_source_mixing,
        "op3_additive_quantisation": additive_ann.op3_additive_quantisation,
        "op4_token_files": token_files.op4_token_files,
        "op5_packing": packing.op5_packing,
        "op6_license_scan": license_scan.op6_license_scan,
        "op7_toxicity": toxicity.op7_toxicity,
        "op8_simhash_near_dedup": simhash.op8_simhash_near_dedup,
        "op9_token_counts": token_counts.op9_token_counts,
        "op10_personal_data": pii.op10_personal_data,
        "op11_quality_rules": repetition.op11_quality_rules,
        "op12_delta_lloyd": delta_lloyd.op12_delta_lloyd,
        "op13_spelling_variants": spelling.op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": exact_dedup.ORACLE,
        "op2_source_mixing": mixing.oracle(),
        "op11_quality_rules": repetition.oracle(),
        "op12_delta_lloyd": delta_lloyd.oracle(),
        "op13_spelling_variants": spelling.ORACLE,
    }
