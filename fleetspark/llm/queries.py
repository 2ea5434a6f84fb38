"""The registered queries of the corpus operators and their DuckDB texts.

op4, op10, op11 and op13 can be expressed in SQL; the others are held against
brute force, round trips or held-out labels in ``tests/llm``."""

from __future__ import annotations

from . import ann, collocation, html_extract, lexical, license_scan, materialise, mixing, ngram_join, packing, quality, rules, suffix_dedup, toxicity

QUERIES = {
    "op1_training_order": materialise.op1,
    "op2_packing": packing.op2,
    "op3_kmeans_tree": ann.op3,
    "op4_license_scan": license_scan.op4,
    "op5_html_extraction": html_extract.op5,
    "op6_suffix_dedup": suffix_dedup.op6,
    "op7_ngram_join": ngram_join.op7,
    "op8_toxicity": toxicity.op8,
    "op9_quality": quality.op9,
    "op10_mixing": mixing.op10,
    "op11_collocations": collocation.op11,
    "op12_rule_ensemble": rules.op12,
    "op13_lexical_search": lexical.op13,
}
SQL = {"op4_license_scan": license_scan.sql4(), "op10_mixing": mixing.SQL10, "op11_collocations": collocation.SQL11, "op13_lexical_search": lexical.SQL13}
