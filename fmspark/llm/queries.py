"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import (licenses, merkle, mixing, near_dedup, nearest, ordinal_quality, packing, paragraphs, pii,
               quality_rules, sharding, token_files, vector_codes)

QUERIES = {
    "op1_substring_dedup": paragraphs.query,
    "op2_quality_rules": quality_rules.query,
    "op3_mixing": mixing.query,
    "op4_nearest_neighbours": nearest.query,
    "op5_license_scan": licenses.query,
    "op6_sharding": sharding.query,
    "op7_pii": pii.query,
    "op8_packing": packing.query,
    "op9_quality_classifier": ordinal_quality.query,
    "op10_near_dedup": near_dedup.query,
    "op11_vector_codes": vector_codes.query,
    "op12_token_files": token_files.query,
    "op13_merkle_manifest": merkle.query,
}

ORACLES = {
    "op4_nearest_neighbours": nearest.ORACLE,
    "op11_vector_codes": vector_codes.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
