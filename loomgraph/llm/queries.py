"""Queries and oracle SQL of this folder's operators."""

from __future__ import annotations

from . import bpe, fingerprints, langid, licenses, mixing, near, neighbours, pages, pii, quality

QUERIES = {
    "op1_near": near.op1_near,
    "op2_pages": pages.op2_pages,
    "op3_language": langid.op3_language,
    "op4_quality": quality.op4_quality,
    "op5_byte_bpe": bpe.op5_byte_bpe,
    "op6_licenses": licenses.op6_licenses,
    "op7_pii": pii.op7_pii,
    "op8_fingerprints": fingerprints.op8_fingerprints,
    "op9_mixing": mixing.op9_mixing,
    "op10_neighbours": neighbours.op10_neighbours,
}

ORACLES = {
    "op1_near": near.OP1_SQL,
    "op9_mixing": mixing.OP9_SQL,
    "op10_neighbours": neighbours.OP10_SQL,
}
