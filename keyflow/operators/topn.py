"""The most frequent values per window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyflow.operators.sliding import BOUNDS, sliding_window
from keyflow.plans import hotsplit


def window_top_n(df: DataFrame, value: str, time: str, size: str, slide: str, n: int) -> DataFrame:
    """The ``n`` most frequent values of each window; ties go to the smaller value.

    Each task keeps only its own best ``n`` per window before the ranking is shuffled.
    """
    return rank_counts(sliding_window(df, [value], time, size, slide, cnt=hotsplit.count()), value, n)


def rank_counts(counts: DataFrame, value: str, n: int) -> DataFrame:
    """Ranks finished counts per window.

    A stream emits all counts of a window in the micro-batch in which the watermark closes it, so
    this also ranks the batches of a stream of counts.
    """
    ranked = Window.partitionBy(*BOUNDS).orderBy(F.col("cnt").desc(), value)
    return counts.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= n)
