"""All queries of the library by name, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadline.plans import export_queries, label_queries, learn_queries, report_queries, split_queries, stream_queries, text_queries

MODULES = (report_queries, text_queries, export_queries, label_queries, learn_queries, split_queries, stream_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All registered queries."""
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """SQL of those that SQL can express."""
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
