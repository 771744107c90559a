"""Splitting one input into several outputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAIN = "main"


def route(df: DataFrame, routes: Mapping[str, Column]) -> DataFrame:
    """Adds ``route``: the first output whose condition holds, or the main one."""
    tag = F
    for name, condition in routes.items():
        tag = tag.when(condition, F.lit(name))
    return df.withColumn("route", tag.otherwise(F.lit(MAIN)))


def outputs(routed: DataFrame, names: list[str]) -> dict[str, DataFrame]:
    """One table per output. Every row is in exactly one."""
    return {name: routed.filter(F.col("route") == name).drop("route") for name in [*names, MAIN]}


def alert_side_output(df: DataFrame, value: str, threshold: int) -> tuple[DataFrame, DataFrame]:
    """All rows on the main output, and those strictly above the threshold as alerts too."""
    return df, df.filter(F.col(value) > threshold)
