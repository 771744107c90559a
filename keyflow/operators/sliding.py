"""Windows that overlap, put together from what they share.

No row is copied for the windows it falls into. The order of a key is cut into blocks as long as a window, so that a
window is the end of one block and the beginning of the next: one running aggregate forwards and one backwards in
each block give every window in two parts. That takes any aggregate whose parts can be combined, extremes too,
and a crowded key is as many pieces of work as it has blocks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.plans import hotsplit
from keyflow.plans.hotsplit import Running

BOUNDS = ["window_start", "window_end"]


def _micros(length: str) -> int:
    return int(pd.Timedelta(length) / pd.Timedelta(microseconds=1))


def _down(position: Column, step: int) -> Column:
    return position - F.pmod(position, F.lit(step))


class _Clock:
    """Times as microseconds since the epoch and back, for both kinds of timestamps, whatever the time zone."""

    def __init__(self, df: DataFrame, time: str):
        zoned = isinstance(df.schema[time].dataType, T.TimestampType)
        self.epoch = F.expr("TIMESTAMP '1970-01-01 00:00:00Z'" if zoned else "TIMESTAMP_NTZ '1970-01-01 00:00:00'")

    def position(self, time: Column) -> Column:
        seconds = (time - self.epoch).cast(T.DayTimeIntervalType(3, 3)).cast("decimal(20, 6)")
        return (seconds * 1_000_000).cast("long")

    def time(self, position: Column) -> Column:
        return self.epoch + F.make_dt_interval(secs=(position.cast("decimal(20, 0)") / 1_000_000).cast("decimal(18, 6)"))


def sliding_window(df: DataFrame, keys: Sequence[str], time: str, size: str, slide: str, **scans: Running) -> DataFrame:
    """Aggregates per key and window of ``size`` every ``slide``, aligned to the epoch, for windows that hold a row.

    Rows are aggregated once per slice, the longest stretch that windows only hold whole, before any shuffle;
    then windows are combined from slices. Rows without a time are in no window.
    """
    length, step = _micros(size), _micros(slide)
    unit = math.gcd(length, step)
    clock, keys = _Clock(df, time), list(keys)
    at = _down(clock.position(F.col(time)), unit)
    slices = df.where(F.col(time).isNotNull()).groupBy(*keys, at.alias("_at")).agg(*[s.agg.alias(n) for n, s in scans.items()])

    # A window belongs to the last slice in it, so that each is named once.
    following = F.lead("_at").over(Window.partitionBy(*keys).orderBy("_at"))
    until = F.least(F.coalesce("_until", F.col("_at") + length), F.col("_at") + length)
    first, last = _down(F.col("_at") - length + step, step), _down(until - length, step)
    starts = F.when(first <= last, F.sequence(first, last, F.lit(step).cast("long")))
    named = slices.select(*keys, "_at", following.alias("_until")).select(*keys, F.explode(starts).alias("_from"))

    # The end of a window asks what its block holds up to there; the start, what the block before holds from there.
    end = F.col("_from") + length - unit
    asks = named.select(*keys, "_from", F.lit(True).alias("_forward"), end.alias("_at"))
    before = named.where(_down(F.col("_from"), length) != _down(end, length))
    asks = asks.union(before.select(*keys, "_from", F.lit(False), F.col("_from")))
    rows = slices.unionByName(asks, allowMissingColumns=True).withColumn("_block", _down(F.col("_at"), length))
    block = Window.partitionBy(*keys, "_block")
    asking = F.col("_from").isNotNull()
    up, down = block.orderBy("_at", asking), block.orderBy(F.desc("_at"), asking)
    parts = rows.select(*keys, "_from", *[_either(F.col("_forward"), s.combine(F.col(n)), up, down).alias(n) for n, s in scans.items()])
    whole = parts.where(F.col("_from").isNotNull()).groupBy(*keys, "_from").agg(*_combined(scans))
    return whole.select(
        *keys,
        clock.time(F.col("_from")).alias("window_start"),
        clock.time(F.col("_from") + length).alias("window_end"),
        *[s.finish(F.col(n)).alias(n) for n, s in scans.items()],
    )


def sliding_count_window(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, step: int, **scans: Running
) -> DataFrame:
    """Aggregates over the last ``size`` records of a key, every ``step`` records, where windows overlap.

    The first ones hold fewer records. ``firing`` is the number of the record that fired the window.
    """
    keys = list(keys)
    numbered = hotsplit.running(df, keys, order, _n=hotsplit.count())
    numbered = numbered.withColumn("_block", F.floor((F.col("_n") - 1) / size))
    block = Window.partitionBy(*keys, "_block")
    up, down = block.orderBy("_n"), block.orderBy(F.desc("_n"))
    aggs = [(n, s.agg) for n, s in scans.items()]
    both = [F.struct(*[a.over(_so_far(w)).alias(n) for n, a in aggs]) for w in (up, down)]
    # A record ends one window, and starts another unless that is the whole of its block.
    ends = F.struct(F.col("_n").alias("firing"), F.lit(True).alias("_ends"), F.col("_up").alias("_part"))
    begins = F.struct((F.col("_n") + size - 1).alias("firing"), F.lit(False).alias("_ends"), F.col("_down").alias("_part"))
    rows = numbered.select(*keys, "_n", both[0].alias("_up"), both[1].alias("_down"))
    parts = rows.select(*keys, F.inline(F.filter(
        F.array(F.when(F.col("_n") % step == 0, ends),
                F.when(((F.col("_n") - 1) % size != 0) & ((F.col("_n") + size - 1) % step == 0), begins)),
        lambda part: part.isNotNull(),
    )))
    parts = parts.select(*keys, "firing", "_ends", *[F.col(f"_part.{n}").alias(n) for n in scans])
    whole = parts.groupBy(*keys, "firing").agg(F.max("_ends").alias("_ends"), *_combined(scans))
    return whole.where("_ends").select(*keys, "firing", *[s.finish(F.col(n)).alias(n) for n, s in scans.items()])


def _so_far(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _either(forward: Column, value: Column, up, down) -> Column:
    return F.when(forward, value.over(_so_far(up))).otherwise(value.over(_so_far(down)))


def _combined(scans: dict[str, Running]) -> list[Column]:
    return [s.combine(F.col(n)).alias(n) for n, s in scans.items()]
