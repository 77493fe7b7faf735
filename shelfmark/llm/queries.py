"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from shelfmark.llm import (
    alignment,
    classlm,
    decontaminate,
    extract,
    fingerprint,
    language,
    licenses,
    neardup,
    pieces,
    spelling,
    suffixdedup,
    tokencount,
    toxicity,
)
from shelfmark.llm.common import table


def op1_near_duplicates(spark, sf_dir):
    return neardup.digest(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark, sf_dir):
    return extract.digest(table(spark, sf_dir, "pages"))


def op3_class_lm(spark, sf_dir):
    return classlm.digest(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark, sf_dir):
    return pieces.digest(table(spark, sf_dir, "documents"))


def op5_license_scan(spark, sf_dir):
    return licenses.digest(table(spark, sf_dir, "documents"))


def op6_toxicity(spark, sf_dir):
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_suffix_dedup(spark, sf_dir):
    return suffixdedup.digest(table(spark, sf_dir, "documents"))


def op8_fingerprints(spark, sf_dir):
    return fingerprint.digest(table(spark, sf_dir, "documents"))


def op9_token_counts(spark, sf_dir):
    return tokencount.digest(table(spark, sf_dir, "documents"))


def op10_decontamination(spark, sf_dir):
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_spelling_variants(spark, sf_dir):
    return spelling.digest(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark, sf_dir):
    return alignment.digest(table(spark, sf_dir, "documents"))


def op13_language_id(spark, sf_dir):
    return language.digest(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_duplicates,
        op2_html_extraction,
        op3_class_lm,
        op4_sentencepiece,
        op5_license_scan,
        op6_toxicity,
        op7_suffix_dedup,
        op8_fingerprints,
        op9_token_counts,
        op10_decontamination,
        op11_spelling_variants,
        op12_token_alignment,
        op13_language_id,
    )
}

ORACLE = {
    "op1_near_duplicates": neardup.SQL,
    "op10_decontamination": decontaminate.SQL,
    "op11_spelling_variants": spelling.SQL,
}
