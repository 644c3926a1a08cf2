"""Registration of queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its name."""

    def add(function):
        QUERIES[function.__name__] = function
        if oracle:
            ORACLES[function.__name__] = oracle
        return function

    return add
