"""User-level placement of rows on tasks.

Sending every row to one task is not offered. :func:`global_sequence` gives what one channel is
used for, a single order over all rows, without putting them in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.plans import hotsplit


def key_by(df: DataFrame, n: int, *keys: Column | str) -> DataFrame:
    """All rows of a key on one task. A task can hold many keys."""
    return df.repartition(n, *keys)


def shuffle(df: DataFrame, n: int, unique: Sequence[str], seed: int = 42) -> DataFrame:
    """Rows on pseudo-random tasks. Placement follows from the row itself, so that a task run again
    after a failure sends its rows to the same places."""
    return df.repartition(n, F.xxhash64(F.lit(seed), *unique))


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """Rows dealt out evenly, whatever their keys."""
    return df.repartition(n)


def rescale(df: DataFrame, n: int) -> DataFrame:
    """Fewer tasks, each taking over whole neighbouring ones; no shuffle."""
    return df.coalesce(n)


def replicate(df: DataFrame, n: int, task: str = "task") -> DataFrame:
    """Every row on every one of ``n`` tasks."""
    copies = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(task))
    return copies.repartitionById(n, F.col(task))


def partition_by(df: DataFrame, n: int, target: Column) -> DataFrame:
    """Rows on the task whose number the caller computes."""
    return df.repartitionById(n, target.cast("int"))


def global_sequence(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Numbers all rows 1, 2, 3, ... in one order."""
    return hotsplit.running(df, [], order, **{name: hotsplit.count()})
