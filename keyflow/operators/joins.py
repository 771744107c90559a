"""Operators over several inputs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.operators.lateness import classify_sides
from keyflow.plans import hotsplit
from keyflow.plans.saltjoin import salted, skew_join
from keyflow.plans.store import stored


def union_all(*inputs: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), inputs)


def connect(left: DataFrame, right: DataFrame, left_map: Sequence[Column], right_map: Sequence[Column]) -> DataFrame:
    """Two inputs of different types, each mapped in its own way to one output type."""
    return left.select(*left_map).unionByName(right.select(*right_map))


def keyed_connect(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_id: Sequence[str],
    right_id: Sequence[str],
    salts: int = 1,
) -> DataFrame:
    """Every pair of records with the same key, exactly once. Streams spread a key over ``salts`` tasks."""
    return _equi_join(left, right, keys, left_id, right_id, salts)


def _equi_join(left, right, on, left_id, right_id, salts) -> DataFrame:
    if not (left.isStreaming or right.isStreaming):
        return skew_join(left, right, on, left_id, right_id)
    if salts == 1:
        return left.join(right, list(on))
    left, right = salted(left, right, salts, left_id)
    return left.join(right, [*on, "_salt"]).drop("_salt")


def window_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    size: str,
    left_id: Sequence[str],
    right_id: Sequence[str],
    salts: int = 1,
) -> DataFrame:
    """Pairs with the same key in the same tumbling window. Streams spread a key over ``salts`` tasks."""
    left = left.withColumn("_span", F.window(left_time, size))
    right = right.withColumn("_span", F.window(right_time, size))
    joined = _equi_join(left, right, [*keys, "_span"], left_id, right_id, salts)
    bounds = [F.col("_span.start").alias("window_start"), F.col("_span.end").alias("window_end")]
    return joined.select("*", *bounds).drop("_span")


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    lower_seconds: int,
    upper_seconds: int,
    left_id: Sequence[str],
    right_id: Sequence[str],
    bucket_seconds: int | None = None,
    measured: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Pairs with the same key and ``left + lower <= right <= left + upper``, both ends included.

    Right rows are filed under their time bucket, left rows look into every bucket their interval
    touches, so that a key with many rows is matched only against its neighbourhood.
    """
    span = upper_seconds - lower_seconds
    width = (bucket_seconds or max(span, 1)) * 1_000_000
    lower, upper = lower_seconds * 1_000_000, upper_seconds * 1_000_000

    def bucket(micros: Column) -> Column:
        return F.floor(micros / F.lit(width)).cast("long")

    def file_left(df: DataFrame) -> DataFrame:
        time = _micros(left_time)
        return df.withColumn("_bucket", F.explode(F.sequence(bucket(time + lower), bucket(time + upper))))

    def file_right(df: DataFrame) -> DataFrame:
        return df.withColumn("_bucket", bucket(_micros(right_time)))

    near = (_micros(right_time) - _micros(left_time)).between(lower, upper)
    sizes = None if measured is None else (file_left(measured[0]), file_right(measured[1]))
    on = [*keys, "_bucket"]
    return skew_join(file_left(left), file_right(right), on, left_id, right_id, near, sizes).drop("_bucket")


def interval_join_stream(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    lower_seconds: int,
    upper_seconds: int,
    left_id: Sequence[str],
    salts: int = 1,
) -> DataFrame:
    """The same join of two streams with watermarks; rows past their reach leave the state.

    Each key is spread over ``salts`` tasks.
    """
    if salts > 1:
        left, right = salted(left, right, salts, left_id)
        keys = [*keys, "_salt"]
    lower, upper = F.make_dt_interval(secs=F.lit(lower_seconds)), F.make_dt_interval(secs=F.lit(upper_seconds))
    near = (F.col(right_time) >= F.col(left_time) + lower) & (F.col(right_time) <= F.col(left_time) + upper)
    right = right.withColumnsRenamed({key: f"_r_{key}" for key in keys})
    same = reduce(lambda a, b: a & b, [F.col(key) == F.col(f"_r_{key}") for key in keys])
    return left.join(right, same & near).drop("_salt", *[f"_r_{key}" for key in keys])


def interval_join_with_late(
    merged: DataFrame,
    keys: Sequence[str],
    time: str,
    order: Sequence[str],
    delay: str,
    lower_seconds: int,
    upper_seconds: int,
    row_id: str,
) -> tuple[DataFrame, DataFrame]:
    """Interval join of the records in time, and the late records of both sides.

    ``merged`` holds both inputs in one table with a ``side`` column. The sides' columns come out
    prefixed with ``left_`` and ``right_``. Lateness is worked out once and stored.
    """
    classified = stored(classify_sides(merged, time, delay, order), "sides")
    on_time = classified.filter(~F.col("is_late"))

    def one_side(both: DataFrame, side: str) -> DataFrame:
        rows = both.filter(F.col("side") == side)
        others = [name for name in merged.columns if name not in (*keys, "side")]
        return rows.select(*keys, *[F.col(name).alias(f"{side}_{name}") for name in others])

    joined = interval_join(
        one_side(on_time, "left"),
        one_side(on_time, "right"),
        keys,
        f"left_{time}",
        f"right_{time}",
        lower_seconds,
        upper_seconds,
        [f"left_{row_id}"],
        [f"right_{row_id}"],
        measured=(one_side(merged, "left"), one_side(merged, "right")),
    )
    return joined, classified.filter("is_late").drop("is_late")


def with_latest_config(
    merged: DataFrame, is_config: Column, config: Column, order: Sequence[str], default: int, start: Column | None = None
) -> DataFrame:
    """Adds to each record the newest config value that arrived before it.

    Config and records come in one table in arrival order. ``start`` is the config from before it.
    """
    flagged = merged.withColumn("_config", is_config)
    scan = hotsplit.latest(config, order, when=F.col("_config")).before()
    rows = hotsplit.running(flagged, [], order, threshold=scan)
    known = ["threshold", *([] if start is None else [start]), F.lit(default)]
    rows = rows.withColumn("threshold", F.coalesce(*known))
    return rows.filter(~F.col("_config")).drop("_config")


def broadcast_threshold(
    merged: DataFrame, is_config: Column, value: str, order: Sequence[str], default: int = 10, start: Column | None = None
) -> DataFrame:
    """Records strictly above the threshold in force when they arrived."""
    rows = with_latest_config(merged, is_config, F.col(value), order, default, start)
    return rows.filter(F.col(value) > F.col("threshold"))
