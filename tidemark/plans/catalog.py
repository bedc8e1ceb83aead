"""All queries of the point-in-time engine and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import collection, inputs, macro, market, news, outputs, statements

Query = Callable[[SparkSession, str], DataFrame]
MODULES = (market, statements, macro, news, collection, inputs, outputs)


def queries() -> dict[str, Query]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
