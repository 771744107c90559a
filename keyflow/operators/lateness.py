"""Event-time lateness as a record-at-a-time watermark would see it.

The watermark at a record follows from the largest event time that arrived before it. That is a
running maximum over all rows in arrival order, which :class:`KeyedOrder` computes in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.operators.windows import BOUNDS, with_window
from keyflow.plans import hotsplit

ON_TIME, ALLOWED, LATE = "on_time", "allowed", "late"


def with_max_seen(df: DataFrame, time: str, order: Sequence[str], start: Column | None = None) -> DataFrame:
    """Adds ``max_seen``, the largest event time arrived before the row.

    ``start`` is the largest one from before this table, when the table continues another.
    """
    seen = hotsplit.running(df, [], order, max_seen=hotsplit.highest(time).before())
    return seen if start is None else seen.withColumn("max_seen", F.greatest("max_seen", start))


def classify(
    df: DataFrame,
    time: str,
    size: str,
    delay: str,
    lateness: str,
    order: Sequence[str],
    start: Column | None = None,
) -> DataFrame:
    """Adds each row's tumbling window and whether the row came in time for it.

    ``on_time``: the window was still open. ``allowed``: it had fired, but lateness was granted.
    ``late``: too late. A window is past when ``max_seen - delay`` reaches its end.
    """
    seen = with_max_seen(with_window(df, time, size), time, order, start)
    watermark = F.col("max_seen") - F.expr(f"INTERVAL {delay}")
    open_until = F.col("window_end")
    allowed_until = open_until + F.expr(f"INTERVAL {lateness}")
    status = (
        F.when(watermark.isNull() | (open_until > watermark), ON_TIME)
        .when(allowed_until > watermark, ALLOWED)
        .otherwise(LATE)
    )
    return seen.withColumn("status", status)


def split_late(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and the rows for the late output."""
    return classified.filter(F.col("status") != LATE), classified.filter(F.col("status") == LATE)


def panes(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    size: str,
    delay: str,
    lateness: str,
    order: Sequence[str],
    value: str,
) -> DataFrame:
    """What each window emits: one pane when it fires, and one more per row allowed after that.

    Every pane carries count and sum of all rows accepted so far. Rows on time come before allowed
    ones in arrival order, so they are combined into one row per window before the scan.
    """
    group = [*keys, *BOUNDS]
    position = F.struct(*order)
    classified = classify(df, time, size, delay, lateness, order).filter(F.col("status") != LATE)
    # The pane of the rows on time has no position, and sorts first.
    allowed_at = F.when(F.col("status") == ALLOWED, position).alias("_at")
    firings = classified.groupBy(*group, allowed_at).agg(F.count("*").alias("_n"), F.sum(value).alias("_v"))
    emitted = hotsplit.running(
        firings,
        group,
        ["_at"],
        measured=with_window(df, time, size).withColumn("_at", position),
        pane=hotsplit.count(),
        cnt=hotsplit.total("_n"),
        **{f"sum_{value}": hotsplit.total("_v")},
    )
    return emitted.drop("_at", "_n", "_v")


def merge_sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both inputs in one table, told apart by ``side``. They need the same columns."""
    return left.withColumn("side", F.lit("left")).unionByName(right.withColumn("side", F.lit("right")))


def newest_of_sides(time: str) -> Column:
    """Aggregate: the newest event time of each side, as a struct."""
    return F.struct(*[F.max(F.when(F.col("side") == side, F.col(time))).alias(side) for side in ("left", "right")])


def classify_sides(
    merged: DataFrame, time: str, delay: str, order: Sequence[str], start: Column | None = None
) -> DataFrame:
    """Adds ``is_late`` to two inputs read together, whose watermark is the smaller of the two.

    A record is late if its time is before the watermark. There is none until both sides had a record.
    ``start`` holds the newest times from before this table, when the table continues another.
    """
    sided = merged
    for side in ("left", "right"):
        sided = sided.withColumn(f"_{side}", F.when(F.col("side") == side, F.col(time)))
    seen = hotsplit.running(
        sided, [], order, _max_left=hotsplit.highest("_left").before(), _max_right=hotsplit.highest("_right").before()
    )
    if start is not None:
        for side in ("left", "right"):
            seen = seen.withColumn(f"_max_{side}", F.greatest(f"_max_{side}", start[side]))
    both = F.when(
        F.col("_max_left").isNotNull() & F.col("_max_right").isNotNull(), F.least("_max_left", "_max_right")
    )
    watermark = both - F.expr(f"INTERVAL {delay}") - F.expr("INTERVAL 1 MILLISECOND")
    late = F.coalesce(F.col(time) < watermark, F.lit(False))
    return seen.select(*merged.columns, late.alias("is_late"))


def with_watermark_of_inputs(
    df: DataFrame, which: str, inputs: Sequence, time: str, arrival: str, order: Sequence[str], delay: str, silence: str
) -> DataFrame:
    """Adds ``watermark``, as the records that arrived before a row make it, where an input may fall silent.

    The column ``which`` names a row's input, one of the few in ``inputs``. The watermark is the newest time, less ``delay``, of the
    input that is furthest behind. An input from which nothing has arrived for longer than ``silence``
    (at the start: since the first record of any) is left out until it speaks again; one without a record holds the watermark
    back until then. The watermark never falls, and stays where it is while all inputs are silent.
    """
    limit = F.expr(f"INTERVAL {silence}")
    mine = {}
    for i, name in enumerate(inputs):
        own = F.col(which) == F.lit(name)
        mine |= {f"_time{i}": F.when(own, F.col(time)), f"_heard{i}": F.when(own, F.col(arrival))}
    scans = {f"{n}_": hotsplit.highest(n).before() for n in mine}
    seen = hotsplit.running(df.withColumns(mine), [], order, _first=hotsplit.lowest(arrival).before(), **scans)
    held, times = F.lit(False), []
    for i in range(len(inputs)):
        alive = F.col(arrival) <= F.coalesce(f"_heard{i}_", "_first") + limit
        held = held | (alive & F.col(f"_time{i}_").isNull())
        times.append(F.when(alive, F.col(f"_time{i}_")))
    behind = F.array_min(F.array(*times))  # of those that are not silent
    now = seen.withColumn("_now", F.when(~held, behind - F.expr(f"INTERVAL {delay}")))
    risen = hotsplit.running(now, [], order, measured=df, watermark=hotsplit.highest("_now"))
    return risen.select(*df.columns, "watermark")


def final_watermark(df: DataFrame, time: str, delay: str) -> Column:
    """The watermark after the last row, as a scalar subquery."""
    return df.agg((F.max(time) - F.expr(f"INTERVAL {delay}")).alias("w")).scalar()
