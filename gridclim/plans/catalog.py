"""Every named query of the library and the SQL that gives the same rows."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridclim.plans import climate, floods, requests, spatial, workflows

MODULES = (climate, requests, spatial, floods, workflows)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
