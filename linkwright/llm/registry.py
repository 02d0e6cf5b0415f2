"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from linkwright.llm import caps, jaccard, licenses, line_dedup, mixing, packing, pii, quality, tiff, warc

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_embedding_near_dedup": caps.op2_embedding_near_dedup,
    "op3_licenses": licenses.op3_licenses,
    "op4_warc": warc.op4_warc,
    "op5_tiff": tiff.op5_tiff,
    "op6_pii": pii.op6_pii,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_ngram_jaccard_join": jaccard.op8_ngram_jaccard_join,
    "op9_quality": quality.op9_quality,
    "op10_mixing": mixing.op10_mixing,
}
ORACLE_SQL = {
    "op2_embedding_near_dedup": caps.ORACLE,
    "op4_warc": warc.ORACLE,
    "op7_line_dedup": line_dedup.ORACLE,
    "op8_ngram_jaccard_join": jaccard.ORACLE,
}
