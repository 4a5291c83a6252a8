"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import paperloom
from paperloom.sources.datasets import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Tasks get the package's functions with the query, so that it need not be installed
# on the executors.
cloudpickle.register_pickle_by_value(paperloom)


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and its oracle where SQL can express it."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_table(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """A table for work that is heavy per row; small single-file inputs use all cores."""
    return spread(table(spark, folder, name), key)


def load_all() -> None:
    from contract import (  # noqa: F401
        conversion,
        embedding,
        extraction,
        search,
        selection,
        similarity,
        storage,
        text,
    )
