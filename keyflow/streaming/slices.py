"""Handing a table to a stream in the order of an event or arrival time.

What a stream makes of records depends on their order, and files say nothing about that. Here a
table reaches the stream as consecutive slices of its order, one micro-batch each, however its rows
lie in files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.session import drop

# Rows of a slice for each core. A slice is handled as a table, so it grows with the cluster.
ROWS_PER_CORE = 4_000_000
LEAST_SLICES = 3

SLICE = "_slice"


def slice_count(df: DataFrame) -> int:
    """As many slices as keep each within reach of the cluster, and never a single one."""
    per_slice = ROWS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    return max(LEAST_SLICES, -(-df.count() // per_slice))


def run_in_slices(
    df: DataFrame, order: Sequence[str], folder: str, run: Callable[[DataFrame], None], slices: int | None = None
) -> None:
    """Calls ``run`` with a stream of the rows of ``df``, again and again as further slices arrive.

    ``run`` works off what is there, with one checkpoint for all its calls. Cut points are quantiles of
    the first order column; rows that are equal in it, or null there (first), share a slice. A slice's
    rows come in no order, as in any micro-batch.

    The table is written once, by ranges of its order, with a folder for each slice; a slice is then read from its
    own folder. So however many slices there are, the table itself is gone through as often.
    """
    spark = df.sparkSession
    slices = slices or slice_count(df)
    shares = [k / slices for k in range(1, slices)]
    at = df.agg(F.percentile_approx(order[0], shares, 10_000).alias("at")).first()["at"]
    cuts = sorted(set(at or []))
    kind = df.schema[order[0]].dataType
    passed = F.filter(F.array(*[F.lit(cut).cast(kind) for cut in cuts]), lambda cut: cut < F.col(order[0]))
    ranged = df.withColumn(SLICE, F.size(passed) if cuts else F.lit(0)).repartitionByRange(order[0])
    ranged.write.partitionBy(SLICE).parquet(f"{folder}/slices")
    placed = spark.read.schema(ranged.schema).parquet(f"{folder}/slices")
    for k in range(len(cuts) + 1):
        placed.where(F.col(SLICE) == k).drop(SLICE).write.mode("append").parquet(f"{folder}/in")
        run(spark.readStream.schema(df.schema).parquet(f"{folder}/in"))
    drop(spark, f"{folder}/slices")
