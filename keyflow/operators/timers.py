"""Event-time timers over tables. Timers of running streams are in ``keyflow.streaming.stateful``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.operators.lateness import final_watermark
from keyflow.plans import hotsplit


def event_timers(df: DataFrame, keys: Sequence[str], time: str, after: str, delay: str) -> DataFrame:
    """Each record sets a timer on its key. A timer fires once per key and time, when the watermark
    has reached it; timers past the last watermark never fire."""
    due = df.select(*keys, (F.col(time) + F.expr(f"INTERVAL {after}")).alias("fires_at"))
    return due.filter(F.col("fires_at") <= final_watermark(df, time, delay)).distinct()


def inactivity_alarm(df: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], silence: str, delay: str) -> DataFrame:
    """Fires when a key has been silent for longer than ``silence``: each record moves its key's timer."""
    limit = F.expr(f"INTERVAL {silence}")
    gaps = hotsplit.running(df, keys, order, last_ts=hotsplit.latest(time, order).before())
    broken = gaps.filter(F.col(time) > F.col("last_ts") + limit).select(*keys, "last_ts")
    ended = df.groupBy(*keys).agg(F.max(time).alias("last_ts"))
    ended = ended.filter(F.col("last_ts") + limit <= final_watermark(df, time, delay))
    return broken.unionByName(ended).withColumn("fires_at", F.col("last_ts") + limit)
