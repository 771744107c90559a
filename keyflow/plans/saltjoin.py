"""Inner equi-joins that spread a key holding too many rows over several tasks.

``skew_join`` measures the keys of tables and lays the crowded ones out on a grid.

A key with L left and R right rows gets ``a = L / limit`` left slices and ``b = R / limit`` right
slices, and more of both if a task would still meet more than ``pairs`` pairs. A left row goes to its slice in
each of the ``b`` columns, a right row to its slice in each of the ``a`` rows, so every pair meets
exactly once and no task sees more than ``limit`` rows of either side. Keys below both limits are left
alone, and without hot keys this is a plain join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.plans.hotsplit import (
    as_right,
    hash_sample,
    match,
    max_chunks,
    rows_per_task,
    sample_step,
    small_copy,
)

# Pairs that one task may have to look at.
PAIRS_PER_TASK = 500_000_000


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_id: Sequence[str],
    right_id: Sequence[str],
    condition: Column | None = None,
    measured: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Joins on the shared columns ``on``; ``left_id`` and ``right_id`` tell the rows of a key apart.

    All other column names must differ between the sides. ``condition`` may narrow the pairs. Key
    sizes are taken from ``measured`` if given: cheaper tables with the same keys and ids, holding
    at least the rows of the sides.
    """
    on = list(on)
    grid = _grid(*(measured or (left, right)), on, left_id, right_id)
    if grid is None:
        return _join(left, right, on, condition)
    left = _place(left, grid, on, left_id, own="_a", other="_b")
    right = _place(right, grid, on, right_id, own="_b", other="_a")
    return _join(left, right, [*on, "_a", "_b"], condition).drop("_a", "_b")


def _join(left: DataFrame, right: DataFrame, on: list[str], condition: Column | None) -> DataFrame:
    # Null never equals null here, so such rows need not be shuffled.
    joined = left.join(right, on, "inner")
    return joined if condition is None else joined.filter(condition)


def _grid(
    left: DataFrame, right: DataFrame, on: list[str], left_id: Sequence[str], right_id: Sequence[str]
) -> DataFrame | None:
    base = rows_per_task(left.sparkSession)
    pairs = float(left.sparkSession.conf.get("keyflow.pairsPerTask", str(PAIRS_PER_TASK)))
    # The sample must show keys whose sides have the root of the pair limit each.
    step = sample_step(min(base, max(1, int(math.sqrt(pairs)))))
    sides = hash_sample(left, step, [*on, *left_id]).select(*on, F.lit(1).alias("l"), F.lit(0).alias("r"))
    sides = sides.unionByName(
        hash_sample(right, step, [*on, *right_id]).select(*on, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    counts = sides.dropna(subset=on).groupBy(*on).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    met = F.col("l").cast("double") * F.col("r") * float(step) ** 2
    size, biggest, most = counts.agg(F.sum(F.col("l") + F.col("r")), F.max(F.greatest("l", "r")), F.max(met)).first()
    limit = max(base, -(-(size or 0) * step // max_chunks(left.sparkSession)))
    # A key over the pair limit has more than its root in rows of a side, which bounds how many there are.
    if not size or (biggest * step <= limit and most <= pairs):
        return None
    hot = counts.filter((F.greatest("l", "r") * step > limit) | (met > pairs))
    by_rows = {side: F.greatest(F.lit(1), F.ceil(F.col(side) * step / limit)) for side in ("l", "r")}
    more = F.greatest(F.lit(1.0), F.sqrt(met / (by_rows["l"] * by_rows["r"]) / pairs))
    slices = []
    for side, name in (("l", "_na"), ("r", "_nb")):
        rows = F.greatest(F.lit(1), F.col(side) * step)
        slices.append(F.least(F.ceil(by_rows[side] * more), rows).cast("int").alias(name))
    return as_right(small_copy(hot.select(*on, *slices)), on)


def _place(
    df: DataFrame, grid: DataFrame, on: list[str], row_id: Sequence[str], own: str, other: str
) -> DataFrame:
    placed = df.join(F.broadcast(grid), match(df, grid, on), "left")
    own_slices = F.coalesce(F.col(f"_n{own[1:]}"), F.lit(1))
    other_slices = F.coalesce(F.col(f"_n{other[1:]}"), F.lit(1))
    return placed.select(
        *df.columns,
        F.pmod(F.xxhash64(*row_id), own_slices).cast("int").alias(own),
        F.explode(F.sequence(F.lit(0), other_slices - 1)).alias(other),
    )


def salted(
    left: DataFrame, right: DataFrame, salts: int, left_id: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a column ``_salt`` to join on as well, which spreads each key over ``salts`` tasks.

    Meant for streams, whose key sizes cannot be measured beforehand: left rows go to one salt each,
    right rows to all of them, so the smaller input belongs on the right.
    """
    left = left.withColumn("_salt", F.pmod(F.xxhash64(*left_id), F.lit(salts)).cast("int"))
    return left, right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
