"""Queries over whole tables for the corpus operators, with DuckDB SQL where SQL can express them."""

from brandtide.llm import langid, mixing, mpeg, near_dedup, packing, records, sharding, substrings, toxicity, winnowing

QUERIES = {
    "op1_media": mpeg.op1_media,
    "op2_language": langid.op2_language,
    "op3_mixing": mixing.op3_mixing,
    "op4_substrings": substrings.op4_substrings,
    "op5_fingerprints": winnowing.op5_fingerprints,
    "op6_sharding": sharding.op6_sharding,
    "op7_records": records.op7_records,
    "op8_packing": packing.op8_packing,
    "op9_near_duplicates": near_dedup.op9_near_duplicates,
    "op10_toxicity": toxicity.op10_toxicity,
}
ORACLE = {"op3_mixing": mixing.ORACLE}
