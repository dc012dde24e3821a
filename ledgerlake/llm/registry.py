"""Names of the corpus queries and the SQL they have to agree with."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def with_code(spark: SparkSession) -> SparkSession:
    """Let Python workers of this machine import the library, wherever the driver was started."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return spark


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = functools.wraps(run)(lambda spark, folder: run(with_code(spark), folder))
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run

    return register
