"""Streams whose results are revised: what late rows change is withdrawn and emitted anew.

A row's lateness is judged record by record, in the order of arrival, so it depends neither on files nor on where
micro-batches are cut. Micro-batches must come in that order. Each one writes the changes that it makes below ``changes``
(see ``operators.changelog``): folded up to any batch, they are the result of all rows accepted until then, as far as the
watermark has passed it. Rows that come too late, or have no time, go below ``late``.

What may still change is written below ``open`` with each micro-batch, and is as much as the rows of the time spans
that the watermark leaves open. A repeated batch starts from the same ``open`` and replaces what it had written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.operators import lateness, topn
from keyflow.operators.changelog import differences
from keyflow.operators.windows import BOUNDS, joined_spans, session_window
from keyflow.plans.hotsplit import Running
from keyflow.session import drop
from keyflow.sinks.writers import BatchWriter, batch_folders
from keyflow.streaming.carry import finish_batch, newest_before, watermark_after, written_batch

FIRED = "fired"


def _interval(length: str) -> Column:
    return F.expr(f"INTERVAL {length}")


def _revised(
    folder: str,
    time: str,
    delay: str,
    order: Sequence[str],
    split: Callable[[DataFrame, Column], tuple[DataFrame, DataFrame]],
    join: Callable[[DataFrame, DataFrame | None], DataFrame],
    result: Callable[[DataFrame], DataFrame],
    open_for: str,
) -> BatchWriter:
    """Runs the steps that both operators below have in common.

    ``split`` gives accepted and late rows of a micro-batch, by the watermark before each row; ``join`` puts accepted rows into
    the open windows (rows with ``BOUNDS``); ``result`` makes what is emitted of windows that have fired. A window stays
    open until the watermark is ``open_for`` past its end.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, before = batch.sparkSession, newest_before(batch.sparkSession, folder, batch_id)
        batch = written_batch(batch, folder, batch_id)
        watermark = watermark_after(batch, folder, time, delay, batch_id)
        accepted, late = split(lateness.with_max_seen(batch, time, order, before), F.col("max_seen") - _interval(delay))
        batch_folders(f"{folder}/late")(late, batch_id)
        was = None
        if before is not None:
            stays = F.col("window_end") + _interval(open_for) > before - _interval(delay)
            was = spark.read.parquet(f"{folder}/open/batch={batch_id - 1}").where(F.coalesce(stays, F.lit(True)))
        joined = join(accepted, None if was is None else was.drop(FIRED))
        joined = joined.withColumn(FIRED, F.coalesce(F.col("window_end") <= watermark, F.lit(False)))
        batch_folders(f"{folder}/open")(joined, batch_id)
        now = spark.read.schema(joined.schema).parquet(f"{folder}/open/batch={batch_id}")
        was = now.limit(0) if was is None else was
        changes = differences(*[result(windows.where(FIRED).drop(FIRED)) for windows in (was, now)])
        batch_folders(f"{folder}/changes")(changes, batch_id)
        if batch_id > 1:
            drop(spark, f"{folder}/open/batch={batch_id - 2}")
        finish_batch(spark, folder, batch_id)

    return write


def _unfired(spark: SparkSession, folder: str) -> DataFrame:
    """The windows that the watermark had not passed when the stream ended."""
    last = spark.read.parquet(f"{folder}/newest").agg(F.max("batch")).first()[0]
    return spark.read.parquet(f"{folder}/open/batch={last}").where(~F.col(FIRED)).drop(FIRED)


def session_changes(
    folder: str,
    keys: Sequence[str],
    time: str,
    gap_seconds: Column | int,
    longest_gap: str,
    delay: str,
    allowed: str,
    order: Sequence[str],
    **scans: Running,
) -> BatchWriter:
    """Sessions per key with aggregates, below ``changes``. The gap is fixed or computed from each record.

    A record spans its time and the gap after it; records whose spans touch are one session, however
    late the one arrives that joins two. A session fires when the watermark passes its end. If it grows
    after that it is withdrawn, and fires again with its new end. A record is late if the watermark was ``allowed`` or more
    past the end of its own span; all others count. Gaps must not be longer than ``longest_gap``, which says how long a
    session that has fired can still be joined.
    """
    gap = F.lit(gap_seconds) if isinstance(gap_seconds, int) else gap_seconds
    until = F.col(time) + F.make_dt_interval(secs=gap)

    def split(rows: DataFrame, watermark: Column) -> tuple[DataFrame, DataFrame]:
        late = F.coalesce(until + _interval(allowed) <= watermark, F.col(time).isNull())
        return rows.where(~late).drop("max_seen"), rows.where(late).drop("max_seen")

    def join(accepted: DataFrame, was: DataFrame | None) -> DataFrame:
        spans = session_window(accepted, keys, time, gap, [time, *order], **{name: scan.agg for name, scan in scans.items()})
        if was is None:
            return spans
        both = spans.withColumn("_new", F.lit(True)).unionByName(was.withColumn("_new", F.lit(False)))
        both = both.withColumnsRenamed({"window_start": "_start", "window_end": "_end"})
        joined = {name: scan.combine(F.col(name)) for name, scan in scans.items()}
        return joined_spans(both, keys, "_start", "_end", ["_start", "_end", "_new"], **joined)

    def result(sessions: DataFrame) -> DataFrame:
        return _finished(sessions, keys, scans)

    within = f"{allowed} {longest_gap}"
    return _revised(folder, time, delay, order, split, join, result, within)


def _finished(sessions: DataFrame, keys: Sequence[str], scans: dict[str, Running]) -> DataFrame:
    return sessions.select(*keys, *BOUNDS, *[scan.finish(F.col(name)).alias(name) for name, scan in scans.items()])


def unfired_sessions(spark: SparkSession, folder: str, keys: Sequence[str], **scans: Running) -> DataFrame:
    """The sessions that were still open when the stream ended."""
    return _finished(_unfired(spark, folder), keys, scans)


def top_changes(
    folder: str, value: str, time: str, size: str, slide: str, n: int, delay: str, allowed: str, order: Sequence[str]
) -> BatchWriter:
    """The ``n`` most frequent values of each sliding window, below ``changes``, ranked as ``topn.rank_counts`` does.

    A window is ranked when the watermark passes its end. Rows that come later, but before it is ``allowed`` past the end, change
    counts: then ranks that are no longer right are withdrawn and the right ones emitted. A row can be in time for one
    of its windows and late for another; below ``late`` it stands with each window that it missed.
    """

    def split(rows: DataFrame, watermark: Column) -> tuple[DataFrame, DataFrame]:
        span = F.window(time, size, slide)
        placed = rows.withColumn("_span", span).withColumns(
            {"window_start": F.col("_span.start"), "window_end": F.col("_span.end")}
        )
        late = F.coalesce(F.col("window_end") + _interval(allowed) <= watermark, F.lit(False))
        placed = placed.withColumn("_late", late).drop("max_seen", "_span")
        no_time = rows.where(F.col(time).isNull()).drop("max_seen")
        missed = placed.where("_late").drop("_late").unionByName(no_time, allowMissingColumns=True)
        return placed.where("NOT _late"), missed

    def join(accepted: DataFrame, was: DataFrame | None) -> DataFrame:
        counts = accepted.groupBy(*BOUNDS, value).agg(F.count("*").alias("cnt"))
        if was is None:
            return counts
        return counts.unionByName(was).groupBy(*BOUNDS, value).agg(F.sum("cnt").alias("cnt"))

    def result(counts: DataFrame) -> DataFrame:
        return topn.rank_counts(counts, value, n)

    return _revised(folder, time, delay, order, split, join, result, allowed)
