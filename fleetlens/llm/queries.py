"""Registered queries of the operators, on the tables under ``sf_dir``."""

from __future__ import annotations

from . import collocations, decontaminate, exact_dedup, html_extract, importance, license_scan, lm_score, near_dup, packing, secret_scan, substring_dedup, toxicity, vector_search
from .common import table


def op1_secret_scan(spark, sf_dir):
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op2_html_extraction(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op3_suffix_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op4_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op5_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_vector_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return vector_search.top_k(vectors, vector_search.every(vectors))


def op7_context_mixing_lm(spark, sf_dir):
    return lm_score.score(table(spark, sf_dir, "documents"))


def op8_probminhash_near_dup(spark, sf_dir):
    return near_dup.classes(table(spark, sf_dir, "documents"))


def op9_benchmark_decontamination(spark, sf_dir):
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark, sf_dir):
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark, sf_dir):
    return importance.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_html_extraction": op2_html_extraction,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_toxicity": op5_toxicity,
    "op6_vector_top_k": op6_vector_top_k,
    "op7_context_mixing_lm": op7_context_mixing_lm,
    "op8_probminhash_near_dup": op8_probminhash_near_dup,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_importance_resampling": op13_importance_resampling,
}
ORACLES = {"op6_vector_top_k": vector_search.ORACLE, "op12_exact_dedup": exact_dedup.ORACLE}
