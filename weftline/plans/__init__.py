"""The query catalogue: every operator over whole tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftline.plans import catalog, definitions, lineage, ml, names, statements, streams

MODULES = (names, lineage, catalog, ml, statements, definitions, streams)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: run for module in MODULES for key, (run, _) in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {key: sql for module in MODULES for key, (_, sql) in module.QUERIES.items() if sql}
