"""Results that are withdrawn and replaced: rows with a ``change``, above 0 for added ones and below for withdrawn ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHANGE = "change"


def differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """The changes that turn ``before`` into ``after``, two tables with the same columns.

    Equal rows count as often as they stand there; nulls are equal to nulls. Rows that stay say nothing.
    """
    signed = before.withColumn(CHANGE, F.lit(-1)).unionByName(after.withColumn(CHANGE, F.lit(1)))
    return signed.groupBy(*before.columns).agg(F.sum(CHANGE).alias(CHANGE)).where(F.col(CHANGE) != 0)


def folded(changes: DataFrame) -> DataFrame:
    """The table that the changes leave, whatever the order they came in. Rows are repeated as often as they were added."""
    names = [name for name in changes.columns if name != CHANGE]
    left = changes.groupBy(*names).agg(F.sum(CHANGE).alias(CHANGE)).where(F.col(CHANGE) > 0)
    return left.select(*names, F.explode(F.array_repeat(F.lit(1), F.col(CHANGE).cast("int"))).alias("_copy")).drop("_copy")


def folded_totals(changes: DataFrame, keys: Sequence[str], *values: str) -> DataFrame:
    """Number of rows (``cnt``) and sums per key of the table that the changes leave, without folding it first.

    Keys that no row is left of are not there.
    """
    sums = [F.sum(F.col(value) * F.col(CHANGE)).alias(f"sum_{value}") for value in values]
    return changes.groupBy(*keys).agg(F.sum(CHANGE).alias("cnt"), *sums).where(F.col("cnt") > 0)
