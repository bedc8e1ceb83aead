"""All queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import cap_dedup, line_dedup, lm_scoring, mil_quality, mixing, near_dedup, packing, quality_rules, tokenfiles, url_filter

MODULES = (mil_quality, cap_dedup, tokenfiles, lm_scoring, line_dedup, near_dedup, quality_rules, packing, url_filter, mixing)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
