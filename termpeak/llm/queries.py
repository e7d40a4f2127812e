"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from termpeak.llm.collocations import COLLOCATION_SQL, collocation_query
from termpeak.llm.common import table
from termpeak.llm.decontaminate import DECONTAMINATION_SQL, decontamination_query
from termpeak.llm.simhash import simhash_query
from termpeak.llm.toxicity import toxicity_query
from termpeak.llm.line_dedup import LINE_DEDUP_SQL, line_dedup_query
from termpeak.llm.mixing import mixing_query
from termpeak.llm.quality_rules import quality_query
from termpeak.llm.token_counts import token_counts_query
from termpeak.llm.license_scan import license_query, license_sql
from termpeak.llm.lm_score import lm_query
from termpeak.llm.hard_negatives import HARD_NEGATIVE_SQL, hard_negative_query
from termpeak.llm.html_extract import extraction_query
from termpeak.llm.vector_dedup import VECTOR_DEDUP_SQL, vector_dedup_query

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op2_decontaminate": lambda spark, sf: decontamination_query(
        table(spark, sf, "documents"), table(spark, sf, "benchmark")
    ),
    "op8_simhash": lambda spark, sf: simhash_query(table(spark, sf, "documents")),
    "op10_toxicity": lambda spark, sf: toxicity_query(
        table(spark, sf, "documents"), table(spark, sf, "labels")
    ),
    "op6_line_dedup": lambda spark, sf: line_dedup_query(table(spark, sf, "documents")),
    "op5_mixing": lambda spark, sf: mixing_query(table(spark, sf, "documents")),
    "op7_quality_rules": lambda spark, sf: quality_query(table(spark, sf, "documents")),
    "op4_token_counts": lambda spark, sf: token_counts_query(table(spark, sf, "documents")),
    "op1_license_scan": lambda spark, sf: license_query(table(spark, sf, "documents")),
    "op9_lm_score": lambda spark, sf: lm_query(table(spark, sf, "documents")),
    "op12_collocations": lambda spark, sf: collocation_query(table(spark, sf, "documents")),
    "op11_hard_negatives": lambda spark, sf: hard_negative_query(
        table(spark, sf, "embeddings")
    ),
    "op13_vector_dedup": lambda spark, sf: vector_dedup_query(table(spark, sf, "embeddings")),
    "op3_html_extract": lambda spark, sf: extraction_query(table(spark, sf, "pages")),
}

ORACLE_SQL: dict[str, str] = {
    "op1_license_scan": license_sql(),
    "op2_decontaminate": DECONTAMINATION_SQL,
    "op6_line_dedup": LINE_DEDUP_SQL,
    "op11_hard_negatives": HARD_NEGATIVE_SQL,
    "op12_collocations": COLLOCATION_SQL,
    "op13_vector_dedup": VECTOR_DEDUP_SQL,
}
