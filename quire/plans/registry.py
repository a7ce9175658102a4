"""Every query of the package's own operators, and the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ("profile", "sentence", "language", "document", "sampling", "packing", "tokens", "search")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for m in MODULES for k, v in import_module(f"quire.operators.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in import_module(f"quire.operators.{m}").SQL.items()}
