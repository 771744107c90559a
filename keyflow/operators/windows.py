"""Keyed windows: tumbling, sliding, session and count windows, and what is computed in them.

Windows are half-open and aligned to the epoch. Time windows are plain grouped aggregates, so rows
are combined before the shuffle and a crowded window or key costs nothing extra. They serve streams
(with a watermark set) as well as tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.functions.accumulator import Accumulator
from keyflow.operators import scan
from keyflow.operators.sliding import BOUNDS, sliding_count_window
from keyflow.plans import hotsplit
from keyflow.plans.hotsplit import KeyedOrder, Running


def event_time(seconds: Column | str) -> Column:
    """Event time from a field holding seconds."""
    return F.timestamp_seconds(seconds)


def processing_time(df: DataFrame, name: str = "processed_at") -> DataFrame:
    """Adds the time of processing, to be used as the time column of a window."""
    return df.withColumn(name, F.current_timestamp())


def time_window(
    df: DataFrame, keys: Sequence[str], time: str, size: str, slide: str | None = None, **aggs: Column
) -> DataFrame:
    """Aggregates per key and window. Without ``slide`` the windows tumble.

    With it, each row is copied into the windows it falls into, as streams need it; over tables, and where
    windows overlap much, ``sliding.sliding_window`` copies none.
    """
    spans = F.window(time, size, slide) if slide else F.window(time, size)
    grouped = df.groupBy(*keys, spans.alias("_span")).agg(*_named(aggs))
    return _flatten(grouped, keys, aggs, "_span")


def _named(aggs: dict[str, Column]) -> list[Column]:
    return [agg.alias(name) for name, agg in aggs.items()]


def _flatten(grouped: DataFrame, keys: Sequence[str], names, span: str) -> DataFrame:
    return grouped.select(
        *keys,
        F.col(f"{span}.start").alias("window_start"),
        F.col(f"{span}.end").alias("window_end"),
        *names,
    )


def with_window(df: DataFrame, time: str, size: str) -> DataFrame:
    """Adds the bounds of the tumbling window each row falls into."""
    spans = df.withColumn("_span", F.window(time, size))
    return spans.select(*df.columns, F.col("_span.start").alias("window_start"), F.col("_span.end").alias("window_end"))


def window_reduce(
    df: DataFrame, keys: Sequence[str], time: str, size: str, order: Sequence[str], value: str
) -> DataFrame:
    """Sum per window under the first record's time: the first record passes through as it is."""
    return time_window(
        df, keys, time, size, first_ts=F.min_by(time, F.struct(*order)), **{f"sum_{value}": F.sum(value)}
    )


def window_aggregate(
    df: DataFrame, keys: Sequence[str], time: str, size: str, result: Column, name: str = "result"
) -> DataFrame:
    """One incremental aggregate per window, as text."""
    return time_window(df, keys, time, size, **{name: result}).withColumn(name, F.col(name).cast("string"))


def window_fold(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    size: str,
    accumulator: Accumulator,
    inputs: Sequence[str],
    output: str,
    output_type,
) -> DataFrame:
    """A user-supplied accumulator per key and window."""
    return scan.fold(with_window(df, time, size), [*keys, *BOUNDS], accumulator, inputs, output, output_type)


def window_process(
    df: DataFrame, keys: Sequence[str], time: str, size: str, order: Sequence[str], element: Column
) -> DataFrame:
    """The elements of each window, one row each: bounds, ``position`` from 1, ``cnt`` of the window, ``element``."""
    ordered = KeyedOrder(with_window(df, time, size), [*keys, *BOUNDS], order)
    numbered = ordered.run(ordered.rows, position=hotsplit.count())
    counted = ordered.totals(numbered, "cnt", F.count(F.lit(1)), F.sum)
    return counted.select(*keys, *BOUNDS, "position", "cnt", element.alias("element"))


def window_lists(elements: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``window_process`` as one array per window. The caller vouches for windows that fit into a row."""
    pairs = F.array_sort(F.collect_list(F.struct("position", "element")))
    grouped = elements.groupBy(*keys, *BOUNDS).agg(F.max("cnt").alias("cnt"), pairs.alias("_list"))
    return grouped.withColumn("elements", F.col("_list.element")).drop("_list")


def window_pages(
    elements: DataFrame,
    keys: Sequence[str],
    function: Callable[[tuple, pa.Table], pa.Table],
    schema: T.StructType | str,
    page_rows: int = 10_000,
) -> DataFrame:
    """Calls ``function`` with key, bounds and page number, and the elements of that page of a window in order.

    The rows are those of ``window_process``. Every window is handed over in pages of ``page_rows``
    elements, so that no task holds a whole crowded one; each element carries the count of its window.
    """
    paged = elements.withColumn("page", F.floor((F.col("position") - 1) / page_rows).cast("int"))

    def call(key, page):
        return function(tuple(part.as_py() for part in key), page.sort_by("position"))

    return paged.groupBy(*keys, *BOUNDS, "page").applyInArrow(call, schema)


def session_window(
    df: DataFrame, keys: Sequence[str], time: str, gap_seconds: Column | int, order: Sequence[str], **aggs: Column
) -> DataFrame:
    """Aggregates per key and session. The gap is fixed or computed from each record.

    A record joins the open session if its time is not past the furthest ``time + gap`` seen so far
    in its key. Streams use Spark's own session windows.
    """
    gap = F.lit(gap_seconds) if isinstance(gap_seconds, int) else gap_seconds
    if df.isStreaming:
        span = F.session_window(time, F.concat(gap.cast("string"), F.lit(" seconds")))
        return _flatten(df.groupBy(*keys, span.alias("_span")).agg(*_named(aggs)), keys, aggs, "_span")
    return joined_spans(df.withColumn("_until", F.col(time) + F.make_dt_interval(secs=gap)), keys, time, "_until", order, **aggs)


def joined_spans(
    df: DataFrame, keys: Sequence[str], start: str, until: str, order: Sequence[str], **aggs: Column
) -> DataFrame:
    """Aggregates per key and union of the spans from ``start`` to ``until`` that touch one another.

    ``order`` begins with ``start``.
    """
    ordered = KeyedOrder(df, keys, order)
    rows = ordered.run(ordered.rows, _open_until=hotsplit.highest(until).before())
    opens = F.col("_open_until").isNull() | (F.col(start) > F.col("_open_until"))
    rows = ordered.run(rows.withColumn("_opens", F.when(opens, F.col(start))), window_start=hotsplit.highest("_opens"))
    grouped = rows.groupBy(*keys, "window_start").agg(F.max(until).alias("window_end"), *_named(aggs))
    return grouped.select(*keys, *BOUNDS, *aggs)


def count_window(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, step: int | None = None, **scans: Running
) -> DataFrame:
    """Windows over the last ``size`` records of a key, one every ``step`` records.

    Without ``step`` the windows tumble, and only full ones fire. With a smaller step the first
    firings hold fewer records. ``firing`` is the number of the record that fired the window.
    """
    step = step or size
    if step < size:
        return sliding_count_window(df, keys, order, size, step, **scans)
    numbered = hotsplit.running(df, keys, order, _n=hotsplit.count())
    # No record falls into two windows.
    placed = numbered.withColumn("firing", (F.ceil(F.col("_n") / step) * step).cast("long"))
    placed = placed.where(F.col("firing") < F.col("_n") + size)
    grouped = placed.groupBy(*keys, "firing").agg(F.max("_n").alias("_last"), *[s.agg.alias(n) for n, s in scans.items()])
    fired = grouped.where(F.col("_last") == F.col("firing"))
    return fired.select(*keys, "firing", *[s.finish(F.col(n)).alias(n) for n, s in scans.items()])
