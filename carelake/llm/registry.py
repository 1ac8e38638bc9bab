"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from carelake.llm import bpe, centroid_search, hard_negatives, imatch, mixing, multi_index, pii, quality_crf, secrets, shingle_join, simhash, sql, substring_dedup, suffix_dedup


def queries() -> dict:
    return {
        "op1_secrets": secrets.op1_secrets,
        "op2_nearest": multi_index.op2_nearest,
        "op3_mixing": mixing.op3_mixing,
        "op4_substring_dedup": substring_dedup.op4_substring_dedup,
        "op5_quality": quality_crf.op5_quality,
        "op6_shingle_join": shingle_join.op6_shingle_join,
        "op7_pii": pii.op7_pii,
        "op8_bpe": bpe.op8_bpe,
        "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
        "op10_fingerprints": imatch.op10_fingerprints,
        "op11_hard_negatives": hard_negatives.op11_hard_negatives,
        "op12_simhash": simhash.op12_simhash,
        "op13_centroids": centroid_search.op13_centroids,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_mixing": mixing.OP3_SQL,
        "op4_substring_dedup": sql.OP4_SQL,
        "op6_shingle_join": sql.OP6_SQL,
        "op9_suffix_dedup": sql.OP9_SQL,
        "op11_hard_negatives": hard_negatives.OP11_SQL,
        "op13_centroids": centroid_search.OP13_SQL,
    }
