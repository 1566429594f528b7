"""The subpackage's queries and their SQL."""

from __future__ import annotations

import corpus_pipeline
from tidemark.llm import bytecnn, decontaminate, mixing, neardup, quality_rules, sharding, substring, toxicity, urlrules, warc

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_substring_dedup": substring.op2_substring_dedup,
    "op3_warc": warc.op3_warc,
    "op4_url_filters": urlrules.op4_url_filters,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_decontamination": decontaminate.op6_decontamination,
    "op7_sharding": sharding.op7_sharding,
    "op8_near_dedup": neardup.op8_near_dedup,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_quality_classifier": bytecnn.op10_quality_classifier,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {"op1_mixing": mixing.oracle(), "op2_substring_dedup": substring.ORACLE, "op3_warc": warc.ORACLE, "op8_near_dedup": neardup.ORACLE, "op9_quality_rules": quality_rules.ORACLE}
