"""The registered queries, each with the SQL that gives the same result where there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from keyflow.session import configured


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None):
    """Registers a function under its own name."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with configured(spark):
                return function(spark, sf_dir)

        REGISTRY[function.__name__] = Query(run, sql)
        return function

    return register


def load() -> dict[str, Query]:
    from keyflow.catalog import files, keyed, processed, rowlevel, several, streams, windowed  # noqa: F401

    return REGISTRY
