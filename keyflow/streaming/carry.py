"""Streams whose operator continues from what came before the micro-batch.

Spark's own watermark drops late rows without a trace and moves only between micro-batches. Here
each micro-batch is handled as a table, continuing from what the batches before it stored: one value,
or rows per key. It is stored last, under its batch number: a batch that failed half-way is repeated from
the same start and replaces what it had written.

A micro-batch is written once and read back, since several outputs are made from it; it is dropped
with the batch after it. Bound it at the source.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.operators import lateness, running
from keyflow.operators.joins import broadcast_threshold
from keyflow.operators.windows import BOUNDS
from keyflow.plans import hotsplit
from keyflow.plans.hotsplit import KeyedOrder, Running, as_right, match
from keyflow.session import drop
from keyflow.sinks.writers import BatchWriter, batch_folders

# Stored rows per key are those of changed keys; this often they are all written together.
COMPACT_EVERY = 10


def written_batch(batch: DataFrame, folder: str, batch_id: int) -> DataFrame:
    batch_folders(f"{folder}/input")(batch, batch_id)
    return batch.sparkSession.read.schema(batch.schema).parquet(f"{folder}/input/batch={batch_id}")


def finish_batch(spark: SparkSession, folder: str, batch_id: int) -> None:
    if batch_id > 0:
        drop(spark, f"{folder}/input/batch={batch_id - 1}")


def carried(
    folder: str,
    value: Callable[[DataFrame, Column | None], Column],
    parts: Callable[[DataFrame, Column | None], dict[str, DataFrame]],
) -> BatchWriter:
    """Writes the ``parts`` of each micro-batch below ``folder`` and carries ``value`` to the next.

    Both get the batch and, except in the first batch, the carried value as a scalar subquery.
    ``value`` is an aggregate over the batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = None
        if batch_id > 0:
            before = spark.read.parquet(f"{folder}/carry/batch={batch_id - 1}").select("carry").scalar()
        batch = written_batch(batch, folder, batch_id)
        for name, part in parts(batch, before).items():
            batch_folders(f"{folder}/{name}")(part, batch_id)
        kept = batch.agg(value(batch, before).alias("carry"))
        batch_folders(f"{folder}/carry")(kept.coalesce(1), batch_id)
        finish_batch(spark, folder, batch_id)

    return write


def late_split(folder: str, time: str, size: str, delay: str, allowed: str, order: Sequence[str]) -> BatchWriter:
    """Writes accepted rows below ``accepted`` and late rows below ``late``, each with its status."""

    def parts(batch: DataFrame, before: Column | None) -> dict[str, DataFrame]:
        classified = lateness.classify(batch, time, size, delay, allowed, order, before)
        accepted, late = lateness.split_late(classified)
        return {"accepted": accepted, "late": late}

    def value(batch: DataFrame, before: Column | None) -> Column:
        newest = F.max(time)
        return newest if before is None else F.greatest(newest, before)

    return carried(folder, value, parts)


def late_split_of_sides(folder: str, time: str, delay: str, order: Sequence[str]) -> BatchWriter:
    """Writes the records of two inputs, read together, below ``accepted`` or ``late``.

    The accepted ones can then be joined, as a table or as streams of that folder.
    """

    def parts(batch: DataFrame, before: Column | None) -> dict[str, DataFrame]:
        classified = lateness.classify_sides(batch, time, delay, order, before)
        return {
            "accepted": classified.filter(~F.col("is_late")).drop("is_late"),
            "late": classified.filter("is_late").drop("is_late"),
        }

    def value(batch: DataFrame, before: Column | None) -> Column:
        newest = lateness.newest_of_sides(time)
        if before is None:
            return newest
        return F.struct(*[F.greatest(newest[side], before[side]).alias(side) for side in ("left", "right")])

    return carried(folder, value, parts)


def threshold_alerts(folder: str, is_config: Column, value: str, order: Sequence[str], default: int = 10) -> BatchWriter:
    """Writes records above the newest config value below ``alerts``.

    The stream holds config and records together, in arrival order.
    """

    def parts(batch: DataFrame, before: Column | None) -> dict[str, DataFrame]:
        return {"alerts": broadcast_threshold(batch, is_config, value, order, default, before)}

    def newest(batch: DataFrame, before: Column | None) -> Column:
        config = F.max(F.when(is_config, F.struct(*order, F.col(value).alias("_value"))))["_value"]
        return config if before is None else F.coalesce(config, before)

    return carried(folder, newest, parts)


def _base(batch_id: int) -> int:
    """The newest batch up to this one that has stored all keys."""
    return batch_id - batch_id % COMPACT_EVERY


def stored(spark: SparkSession, folder: str, keys: Sequence[str], batch_id: int) -> DataFrame | None:
    """The newest stored row of each key after a batch; nothing before the first."""
    if batch_id < 0:
        return None
    paths = [f"{folder}/state/batch={k}" for k in range(_base(batch_id), batch_id + 1)]
    rows = spark.read.option("basePath", f"{folder}/state").parquet(*paths)
    values = [name for name in rows.columns if name not in (*keys, "batch")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_row"))
    return newest.select(*keys, "_row.*")


def keyed(
    folder: str,
    keys: Sequence[str],
    rows: Callable[[DataFrame, DataFrame | None], DataFrame],
    state: Callable[[DataFrame], DataFrame],
    merge: Callable[[dict[str, Column], dict[str, Column]], dict[str, Column]],
) -> BatchWriter:
    """Rows made from each micro-batch and what is stored per key, below ``rows``.

    ``rows`` gets the batch and the stored rows. ``state`` sums the batch up, one row per key; ``merge``
    joins the values stored earlier to those. Only keys of the batch are stored anew; every
    ``COMPACT_EVERY`` batches all are, and what is older is dropped.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = written_batch(batch, folder, batch_id)
        start = stored(spark, folder, keys, batch_id - 1)
        batch_folders(f"{folder}/rows")(rows(batch, start), batch_id)
        later = state(batch)
        if start is not None:
            later = _merged(start, later, keys, merge, every=batch_id == _base(batch_id))
        batch_folders(f"{folder}/state")(later, batch_id)
        finish_batch(spark, folder, batch_id)
        if batch_id == _base(batch_id) + 1 and batch_id > COMPACT_EVERY:
            for old in range(_base(batch_id) - COMPACT_EVERY, _base(batch_id)):
                drop(spark, f"{folder}/state/batch={old}")

    return write


def _merged(start: DataFrame, later: DataFrame, keys: Sequence[str], merge, every: bool) -> DataFrame:
    values = [name for name in later.columns if name not in keys]
    early = as_right(start.withColumnsRenamed({name: f"_start_{name}" for name in values}), keys)
    joined = later.join(early, match(later, early, keys), "left")
    both = merge({name: F.col(f"_start_{name}") for name in values}, {name: F.col(name) for name in values})
    changed = joined.select(*keys, *[both[name].alias(name) for name in values])
    if not every:
        return changed
    new = as_right(later.select(*keys), keys)
    return changed.unionByName(start.join(new, match(start, new, keys), "left_anti"))


def running_by_key(
    folder: str,
    keys: Sequence[str],
    order: Sequence[str],
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    **scans: Running,
) -> BatchWriter:
    """Running aggregates over a stream, one output row per record, below ``rows``.

    ``finish`` may work on these rows before they are written. A key that fills most of a micro-batch is
    cut into chunks like any table's. The stream's micro-batches must come in the order.
    """

    def rows(batch: DataFrame, start: DataFrame | None) -> DataFrame:
        ordered = KeyedOrder(batch, keys, order)
        return finish(ordered.close(ordered.run(ordered.rows, start, **scans)))

    def state(batch: DataFrame) -> DataFrame:
        return hotsplit.aggregates(batch, keys, **scans)

    def merge(early: dict[str, Column], late: dict[str, Column]) -> dict[str, Column]:
        return {name: scan.merge(early[name], late[name]) for name, scan in scans.items()}

    return keyed(folder, keys, rows, state, merge)


def top_by_key(folder: str, keys: Sequence[str], order: Sequence[str], value: str = "vc", n: int = 3) -> BatchWriter:
    """After each record the ``n`` largest levels of its key so far, as the array ``top``, below ``rows``."""

    def rows(batch: DataFrame, start: DataFrame | None) -> DataFrame:
        return running.top_running(batch, keys, order, value, n, start)

    def state(batch: DataFrame) -> DataFrame:
        best = running.top_final(batch, keys, order, value, n)
        return best.groupBy(*keys).agg(F.sort_array(F.collect_list(value), asc=False).alias("top"))

    def merge(early: dict[str, Column], late: dict[str, Column]) -> dict[str, Column]:
        return {"top": running.largest(n, late["top"], early["top"])}

    return keyed(folder, keys, rows, state, merge)


def newest_before(spark: SparkSession, folder: str, batch_id: int) -> Column | None:
    """The newest time of the batches before this one, as ``watermark_after`` has stored it."""
    return spark.read.parquet(f"{folder}/newest/batch={batch_id - 1}").select("newest").scalar() if batch_id > 0 else None


def watermark_after(batch: DataFrame, folder: str, time: str, delay: str, batch_id: int) -> Column:
    """The watermark after a batch, which is stored with it."""
    spark = batch.sparkSession
    newest, before = F.max(time), newest_before(spark, folder, batch_id)
    newest = newest if before is None else F.greatest(newest, before)
    batch_folders(f"{folder}/newest")(batch.agg(newest.alias("newest")).coalesce(1), batch_id)
    stored = spark.read.parquet(f"{folder}/newest/batch={batch_id}")
    return stored.select(F.col("newest") - F.expr(f"INTERVAL {delay}")).scalar()


def _split(rows: DataFrame, fires: Column, folder: str, batch_id: int) -> DataFrame:
    """Stores what does not fire yet below ``pending``, and returns the rest."""
    batch_folders(f"{folder}/pending")(rows.filter(~fires), batch_id)
    if batch_id > 1:
        drop(rows.sparkSession, f"{folder}/pending/batch={batch_id - 2}")
    return rows.filter(fires)


def event_timers(folder: str, keys: Sequence[str], time: str, after: str, delay: str) -> BatchWriter:
    """Each record sets a timer ``after`` its time. Timers that the watermark reaches come below ``fired``.

    The watermark moves with each micro-batch. Timers that have not fired are carried on; there are as
    many as records in the span of ``after`` and ``delay``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = written_batch(batch, folder, batch_id)
        watermark = watermark_after(batch, folder, time, delay, batch_id)
        due = batch.select(*keys, (F.col(time) + F.expr(f"INTERVAL {after}")).alias("fires_at"))
        if batch_id > 0:
            due = due.unionByName(spark.read.schema(due.schema).parquet(f"{folder}/pending/batch={batch_id - 1}"))
        fired = _split(due.distinct(), F.col("fires_at") <= watermark, folder, batch_id)
        batch_folders(f"{folder}/fired")(fired, batch_id)
        finish_batch(spark, folder, batch_id)

    return write


def silence_alarms(folder: str, keys: Sequence[str], time: str, order: Sequence[str], silence: str, delay: str) -> BatchWriter:
    """Fires, below ``fired``, when a key has been silent for longer than ``silence``.

    A record that ends a silence reports it, and so does the watermark that passes it, whichever is
    first. Keys that have not been reported are carried on with their last time.
    """
    limit = F.expr(f"INTERVAL {silence}")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = written_batch(batch, folder, batch_id)
        watermark = watermark_after(batch, folder, time, delay, batch_id)
        last = batch.groupBy(*keys).agg(F.max(time).alias("last_ts"))
        waiting = None
        if batch_id > 0:
            waiting = spark.read.schema(last.schema).parquet(f"{folder}/pending/batch={batch_id - 1}")
            last = last.unionByName(waiting).groupBy(*keys).agg(F.max("last_ts").alias("last_ts"))
        ordered = KeyedOrder(batch, keys, order)
        seen = ordered.close(ordered.run(ordered.rows, waiting, last_ts=hotsplit.highest(time).before()))
        broken = seen.filter(F.col(time) > F.col("last_ts") + limit).select(*keys, "last_ts")
        ended = _split(last, F.col("last_ts") + limit <= watermark, folder, batch_id)
        batch_folders(f"{folder}/fired")(broken.unionByName(ended).withColumn("fires_at", F.col("last_ts") + limit), batch_id)
        finish_batch(spark, folder, batch_id)

    return write


def late_panes(
    folder: str,
    keys: Sequence[str],
    time: str,
    size: str,
    delay: str,
    allowed: str,
    order: Sequence[str],
    value: str,
) -> BatchWriter:
    """What each tumbling window emits, below ``panes``, as ``lateness.panes`` gives it for a table.

    A window fires when the watermark passes its end, and again with each row allowed after that, with
    count and sum of all its rows so far. Windows that may still change are carried on, below ``open``;
    ``unfired_panes`` gives those that a stream which has ended leaves behind. Micro-batches must come
    in the order.
    """
    window = [*keys, *BOUNDS]
    total = f"sum_{value}"

    def grouped(rows: DataFrame, kind: str) -> DataFrame:
        counts = rows.groupBy(*window).agg(F.count("*").alias(f"n_{kind}"), F.sum(value).alias(f"s_{kind}"))
        return counts.withColumn("fired", F.lit(False))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = newest_before(spark, folder, batch_id)
        batch = written_batch(batch, folder, batch_id)
        watermark = watermark_after(batch, folder, time, delay, batch_id)
        classified = lateness.classify(batch, time, size, delay, allowed, order, before)
        batch_folders(f"{folder}/classified")(classified, batch_id)
        rows = spark.read.schema(classified.schema).parquet(f"{folder}/classified/batch={batch_id}")
        on_time = grouped(rows.filter(F.col("status") == lateness.ON_TIME), "on")
        extra = rows.filter(F.col("status") == lateness.ALLOWED)
        known = on_time if batch_id == 0 else on_time.unionByName(_open(spark, folder, batch_id - 1), allowMissingColumns=True)
        known = _joined_windows(known, window)

        since = F.coalesce("n_late", F.lit(0))
        start = known.select(
            *window,
            (F.when(F.col("n_on") > 0, 1).otherwise(0) + since).cast("long").alias("pane"),
            (F.coalesce("n_on", F.lit(0)) + since).alias("cnt"),
            F.coalesce(F.col("s_on") + F.col("s_late"), "s_on", "s_late").alias(total),
        )
        ordered = KeyedOrder(extra.withColumn("_n", F.lit(1)), window, order)
        scans = {"pane": hotsplit.count(), "cnt": hotsplit.total("_n"), total: hotsplit.total(value)}
        again = ordered.run(ordered.rows, start, **scans).select(*window, *scans)
        due = (F.col("n_on") > 0) & (F.col("window_end") <= watermark)
        first = known.filter(~F.col("fired") & due)
        batch_folders(f"{folder}/panes")(again.unionByName(_first_panes(first, window, total)), batch_id)

        later = known.withColumn("fired", F.col("fired") | F.coalesce(due, F.lit(False)))
        later = _joined_windows(later.unionByName(grouped(extra, "late"), allowMissingColumns=True), window)
        may_change = F.coalesce(F.col("window_end") + F.expr(f"INTERVAL {allowed}") > watermark, F.lit(True))
        batch_folders(f"{folder}/open")(later.filter(may_change), batch_id)
        drop(spark, f"{folder}/classified/batch={batch_id}")
        if batch_id > 1:
            drop(spark, f"{folder}/open/batch={batch_id - 2}")
        finish_batch(spark, folder, batch_id)

    return write


def _open(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
    return spark.read.parquet(f"{folder}/open/batch={batch_id}")


def _joined_windows(rows: DataFrame, window: Sequence[str]) -> DataFrame:
    """One row per window: counts and sums of rows on time and of those allowed later, and whether it has fired."""
    sums = [
        (F.sum(name) if name in rows.columns else F.lit(None).cast("long")).alias(name)
        for name in ("n_on", "s_on", "n_late", "s_late")
    ]
    return rows.groupBy(*window).agg(*sums, F.bool_or("fired").alias("fired"))


def _first_panes(rows: DataFrame, window: Sequence[str], total: str) -> DataFrame:
    one = F.lit(1).cast("long").alias("pane")
    return rows.select(*window, one, F.col("n_on").alias("cnt"), F.col("s_on").alias(total))


def unfired_panes(spark: SparkSession, folder: str, batch_id: int, keys: Sequence[str], value: str) -> DataFrame:
    """The panes of windows that the watermark had not passed when the stream ended with this batch."""
    left = _open(spark, folder, batch_id).filter(~F.col("fired") & (F.col("n_on") > 0))
    return _first_panes(left, [*keys, *BOUNDS], f"sum_{value}")
