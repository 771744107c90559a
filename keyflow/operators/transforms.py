"""Row-level operators. Every function serves tables and streams alike."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.functions.text import split_words


def project(df: DataFrame, *columns: Column | str) -> DataFrame:
    return df.select(*columns)


def increment(df: DataFrame, column: str, by: int = 1) -> DataFrame:
    return df.withColumn(column, F.col(column) + by)


def filter_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose column equals the parameter."""
    return df.filter(F.col(column) == F.lit(value))


def above(column: Column | str, threshold: Column | float) -> Column:
    """Strictly above a threshold; used as a predicate."""
    return (F.col(column) if isinstance(column, str) else column) > threshold


def remainder_key(column: Column | str, n: int) -> Column:
    """Remainder with the sign of the dividend."""
    return (F.col(column) if isinstance(column, str) else column) % n


def words(lines: DataFrame, column: str = "value", separator: str = " ") -> DataFrame:
    """One row per word."""
    keep = [name for name in lines.columns if name != column]
    return lines.select(*keep, F.explode(split_words(column, separator)).alias("word"))


def numbered_words(lines: DataFrame, column: str = "value", separator: str = " ") -> DataFrame:
    """One row per word, with its position in the line."""
    keep = [name for name in lines.columns if name != column]
    return lines.select(*keep, F.posexplode(split_words(column, separator)).alias("pos", "word"))


def map_with_setup(
    df: DataFrame,
    schema: str,
    function: Callable[[pd.DataFrame, object], pd.DataFrame],
    setup: Callable[[int], object],
    teardown: Callable[[object], None] = lambda resource: None,
) -> DataFrame:
    """Maps batches of rows with something opened once per task and closed at its end.

    ``setup`` gets the task's index; ``function`` gets a batch and what ``setup`` returned.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = setup(TaskContext.get().partitionId())
        try:
            for batch in batches:
                yield function(batch, resource)
        finally:
            teardown(resource)

    return df.mapInPandas(run, schema)
