"""All registered queries of the audit operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapelens.plans import linkage, probes, profiles, reports, staging

Query = Callable[[SparkSession, str], DataFrame]
MODULES = (linkage, profiles, staging, probes, reports)


def queries() -> dict[str, Query]:
    return {name: query for m in MODULES for name, (query, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}
