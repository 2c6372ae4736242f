"""Every registered query of the library, with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioforge.plans import audits, books, builds, corpus, service, settings

MODULES = [service, corpus, books, builds, settings, audits]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for module in MODULES for name, f in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
