"""Name -> query and name -> oracle SQL. Modules of queries add themselves to ``MODULES``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import aligned, core, formats, screening

MODULES: list = [core, screening, formats, aligned]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
