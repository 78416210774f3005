"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, decontaminate, language, licenses, merkle, mixing, near_dedup, nearest, sharding, substring_dedup, templates, toxicity, url_filter

MODULES = (near_dedup, substring_dedup, sharding, licenses, decontaminate, toxicity, templates, language, mixing, nearest, url_filter, alignment, merkle)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries of the operators."""
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """SQL of those that SQL can express."""
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
