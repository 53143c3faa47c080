"""All queries of the retail library, with the SQL that states the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from demandloom.queries import base, cleaning, dims, exploration, files, panel  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.SQL)
