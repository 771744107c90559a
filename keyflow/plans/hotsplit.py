"""Ordered scans over keyed rows that stay parallel when one key holds most of the data.

A running aggregate needs the rows of a key in order, which normally puts the whole key into one
window partition. Here a key with too many rows is cut into consecutive chunks of its order. Each
chunk is scanned on its own, and what came before it is added from a small table holding one
aggregate row per earlier chunk. The same cut makes a scan over *all* rows (no key at all)
parallel.

Only the layout depends on the row counts measured here, never the result:

* hot keys are found, and cut points chosen, from a hash sample of the rows;
* at most ``max_chunks`` chunks exist, a number that follows the cluster: beyond it the chunk size grows with the data. That bounds the
  hot-key list, the cut points and the table of earlier chunks, which are the only things
  broadcast.
"""

from __future__ import annotations

import dataclasses
import itertools
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_TASK = 4_000_000
MIN_ROWS_PER_TASK = 1_000
# Chunks of one order over all rows are small, since several of them can meet in a task.
ROWS_PER_CHUNK = 250_000
LEAST_MAX_CHUNKS = 20_000
CHUNKS_PER_CORE = 20
SAMPLES_PER_CHUNK = 64

CHUNK = "_chunk"
HOT = "_hot"

_POS = "_pos"
_CUTS = "_cuts"
_START = "_cuts_start"
_COUNT = "_cuts_count"


@dataclass(frozen=True)
class Running:
    """An aggregate of everything up to a row, in a form that can be cut into chunks.

    ``agg`` aggregates the rows of one chunk, ``combine`` aggregates the ``agg`` values of earlier
    chunks, and ``merge(earlier, local)`` joins the two. With ``exclusive`` the row itself is left
    out.
    """

    agg: Column
    combine: Callable[[Column], Column]
    merge: Callable[[Column, Column], Column]
    finish: Callable[[Column], Column] = lambda value: value
    exclusive: bool = False

    def before(self) -> Running:
        """The same aggregate over the rows strictly before the current one."""
        return dataclasses.replace(self, exclusive=True)


def total(value: Column | str) -> Running:
    return Running(F.sum(value), F.sum, lambda early, local: F.coalesce(early + local, early, local))


def count(value: Column | str | None = None) -> Running:
    agg = F.count(F.lit(1) if value is None else value)
    return Running(agg, F.sum, lambda early, local: F.coalesce(early, F.lit(0)) + local)


def highest(value: Column | str) -> Running:
    return Running(F.max(value), F.max, F.greatest)


def lowest(value: Column | str) -> Running:
    return Running(F.min(value), F.min, F.least)


def first(value: Column | str, order: Sequence[str]) -> Running:
    return Running(F.min(_tagged(value, order)), F.min, F.least, lambda pair: pair["_value"])


def latest(value: Column | str, order: Sequence[str], when: Column | None = None) -> Running:
    """The value of the newest row, or of the newest row for which ``when`` holds."""
    pair = _tagged(value, order)
    pair = pair if when is None else F.when(when, pair)
    return Running(F.max(pair), F.max, F.greatest, lambda pair: pair["_value"])


def _tagged(value: Column | str, order: Sequence[str]) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.struct(*order, value.alias("_value"))


def max_chunks(spark: SparkSession) -> int:
    """How many chunks there may be. It follows the cluster, whose driver holds and broadcasts a row for each."""
    return max(LEAST_MAX_CHUNKS, CHUNKS_PER_CORE * spark.sparkContext.defaultParallelism)


def rows_per_task(spark: SparkSession) -> int:
    return int(spark.conf.get("keyflow.rowsPerTask", str(ROWS_PER_TASK)))


def sample_step(limit: int) -> int:
    """Keep one row in this many and a group of ``limit`` rows still leaves enough samples."""
    return max(1, limit // SAMPLES_PER_CHUNK)


def hash_sample(df: DataFrame, step: int, unique: Sequence[str]) -> DataFrame:
    """A repeatable sample: the same rows are kept whenever and wherever it is evaluated."""
    if step == 1:
        return df
    return df.filter(F.pmod(F.xxhash64(*unique), F.lit(step)) == 0)


def small_copy(df: DataFrame) -> DataFrame:
    """Freezes a table whose size the caller has bounded, so that every use sees the same rows."""
    return df.sparkSession.createDataFrame(df.toArrow(), schema=df.schema)


def match(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Equality of the columns ``names`` with their ``_r_`` twins on the right, nulls matching."""
    return reduce(
        lambda a, b: a & b, [left[name].eqNullSafe(right[f"_r_{name}"]) for name in names]
    )


def as_right(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({name: f"_r_{name}" for name in names})


class KeyedOrder:
    """The rows of ``df``, ordered by ``order`` inside each key.

    ``order`` must be unique inside a key. With no keys there is one order over all rows. Scan
    ``rows`` with :meth:`run`, as often as needed, and hand the result to :meth:`close`.

    The key sizes are those of ``measured``, which has the same key and order columns. It may be
    given when ``df`` is expensive and its keys are no larger than those of something cheaper.
    ``share`` says which share of the rows it holds, if it is a sample itself.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        measured: DataFrame | None = None,
        share: float = 1.0,
    ):
        self.keys = list(keys)
        self.order = list(order)
        self.share = share
        self.cut = False
        self.rows = self._cut_rows(df, df if measured is None else measured)
        self.partition = self.keys + ([CHUNK] if self.cut else [])

    def _cut_rows(self, df: DataFrame, measured: DataFrame) -> DataFrame:
        spark = df.sparkSession
        base = rows_per_task(spark)
        measured = measured.select(*self.keys, *self.order)
        if not self.keys:
            size = int(measured.count() / self.share)
            spread = max(MIN_ROWS_PER_TASK, -(-size // spark.sparkContext.defaultParallelism))
            limit = max(min(base, spread, ROWS_PER_CHUNK), -(-size // max_chunks(spark)))
            if size <= limit:
                return df
            self.cut = True
            _, cuts, longest = self._cut_points(measured, limit)
            return self._locate(df, cuts, F.lit(0), F.lit(longest), longest).select(*df.columns, CHUNK)

        step = self._step(base)
        sample = hash_sample(measured, step, [*self.keys, *self.order])
        stands_for = step / self.share
        counts = sample.groupBy(*self.keys).agg((F.count("*") * stands_for).alias("n")).persist()
        try:
            size, biggest = counts.agg(F.sum("n"), F.max("n")).first()
            limit = max(base, math.ceil((size or 0) / max_chunks(spark)))
            if not size or biggest <= limit:
                return df
            hot = as_right(small_copy(counts.filter(F.col("n") > limit).drop("n")), self.keys)
        finally:
            counts.unpersist()
        self.cut = True
        hot_rows = measured.join(F.broadcast(hot), match(measured, hot, self.keys), "left_semi")
        ranges, cuts, longest = self._cut_points(hot_rows, limit)
        ranges = as_right(ranges, self.keys)
        ranged = df.join(F.broadcast(ranges), match(df, ranges, self.keys), "left")
        placed = self._locate(ranged, cuts, F.col(_START), F.col(_COUNT), longest)
        return placed.select(*df.columns, CHUNK, F.col(_COUNT).isNotNull().alias(HOT))

    def _step(self, limit: int) -> int:
        """One row in how many is kept of what is measured."""
        return max(1, int(sample_step(limit) * self.share))

    def _cut_points(self, df: DataFrame, limit: int) -> tuple[DataFrame, Column, int]:
        """Positions that cut the rows of each key into chunks of about ``limit`` rows.

        All cut points form one sorted array, given as a scalar subquery so that no row has to carry
        it. Comes with each key's range in that array, and the length of the longest range.
        """
        step = self._step(limit)
        every = max(1, int(limit * self.share) // step)
        sample = hash_sample(df, step, [*self.keys, *self.order]).select(*self.keys, F.struct(*self.order).alias(_POS))
        ranked = Window.partitionBy(*self.keys).orderBy(_POS)
        picked = sample.withColumn("_n", F.row_number().over(ranked)).filter(F.col("_n") % every == 0)
        per_key = picked.groupBy(*self.keys).agg(F.array_sort(F.collect_list(_POS)).alias(_CUTS))
        found = per_key.toArrow()

        lists = found.column(_CUTS).combine_chunks()
        counts = [len(points) for points in lists]
        starts = [0, *itertools.accumulate(counts)][: len(counts)]
        whole = pa.ListArray.from_arrays(pa.array([0, sum(counts)], pa.int32()), lists.flatten())
        spark = df.sparkSession
        cuts = spark.createDataFrame(pa.table({_CUTS: whole}), schema=per_key.select(_CUTS).schema).scalar()
        ranges = found.drop_columns([_CUTS])
        ranges = ranges.append_column(_START, pa.array(starts, pa.int32()))
        ranges = ranges.append_column(_COUNT, pa.array(counts, pa.int32()))
        kinds = T.StructType().add(_START, T.IntegerType()).add(_COUNT, T.IntegerType())
        schema = T.StructType([*per_key.drop(_CUTS).schema, *kinds])
        return spark.createDataFrame(ranges, schema=schema), cuts, max(counts, default=0)

    def _locate(self, df: DataFrame, cuts: Column, start: Column, count: Column, longest: int) -> DataFrame:
        """Adds how many of the key's cut points are at or before the row.

        This is a binary search, one column per halving of the step, which keeps it in compiled code.
        """
        steps = [1]
        while steps[0] <= longest:
            steps.insert(0, steps[0] * 2)
        df = df.withColumns({_CUTS: cuts, _POS: F.struct(*self.order), CHUNK: F.lit(0)})
        for step in steps:
            further = F.col(CHUNK) + step
            passed = (further <= count) & (F.get(_CUTS, start + further - 1) <= F.col(_POS))
            df = df.withColumn(CHUNK, F.when(passed, further).otherwise(F.col(CHUNK)))
        return df

    def hot(self, df: DataFrame) -> DataFrame:
        """The rows of keys that were cut. (Not a condition on the chunk, which is costly to compute.)"""
        return df.filter(HOT) if self.keys else df

    def window(self, exclusive: bool = False):
        frame = Window.partitionBy(*self.partition).orderBy(*self.order)
        return frame.rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)

    def run(self, df: DataFrame, start: DataFrame | None = None, **scans: Running) -> DataFrame:
        """Adds one column per running aggregate.

        When this table continues an earlier one, ``start`` has that one's aggregates per key, as
        made by :func:`aggregates`.
        """
        rows = df.select(
            "*", *[scan.agg.over(self.window(scan.exclusive)).alias(name) for name, scan in scans.items()]
        )
        values = {name: F.col(name) for name in scans}
        if self.cut:
            early = as_right(self._earlier(df, scans), self.partition)
            rows = rows.join(F.broadcast(early), match(rows, early, self.partition), "left")
            values = {name: scan.merge(F.col(f"_early_{name}"), values[name]) for name, scan in scans.items()}
        if start is not None:
            before = start.withColumnsRenamed({name: f"_start_{name}" for name in scans})
            before = self.spread_start(df, before)
            rows = rows.join(before, match(rows, before, self.partition), "left")
            values = {name: scan.merge(F.col(f"_start_{name}"), values[name]) for name, scan in scans.items()}
        finished = [scan.finish(values[name]).alias(name) for name, scan in scans.items()]
        return rows.select(*df.columns, *finished)

    def _earlier(self, df: DataFrame, scans: dict[str, Running]) -> DataFrame:
        """Per chunk of a hot key, the aggregate over all its earlier chunks."""
        chunks = self.summarise(df, **{name: scan.agg for name, scan in scans.items()})
        before = self.chunk_window(exclusive=True)
        return chunks.select(
            *self.partition,
            *[scan.combine(F.col(name)).over(before).alias(f"_early_{name}") for name, scan in scans.items()],
        )

    def summarise(self, df: DataFrame, **aggs: Column) -> DataFrame:
        """One row per chunk of a hot key. At most ``max_chunks`` rows, aggregated before the shuffle."""
        return self.hot(df).groupBy(*self.partition).agg(*[agg.alias(name) for name, agg in aggs.items()])

    def spread_start(self, df: DataFrame, start: DataFrame) -> DataFrame:
        """Values per key, given to each chunk of the key, so that joining them leaves the chunks where they are."""
        if not self.cut:
            return as_right(start, self.keys)
        chunks = as_right(self.summarise(df, _rows=F.count(F.lit(1))).select(*self.partition), self.keys)
        given = start.join(F.broadcast(chunks), match(start, chunks, self.keys), "left")
        given = given.select(*start.columns, F.coalesce(CHUNK, F.lit(0)).alias(CHUNK))
        return as_right(given, self.partition)

    def chunk_window(self, exclusive: bool):
        frame = Window.partitionBy(*self.keys).orderBy(CHUNK)
        return frame.rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)

    def totals(self, df: DataFrame, name: str, agg: Column, combine: Callable[[Column], Column]) -> DataFrame:
        """Adds an aggregate over the whole key to each of its rows."""
        whole = Window.partitionBy(*self.partition)
        local = df.withColumn(name, agg.over(whole))
        if not self.cut:
            return local
        chunks = self.summarise(df, _whole=agg)
        keyed = chunks.groupBy(*self.keys).agg(combine(F.col("_whole")).alias("_whole"))
        keyed = as_right(keyed, self.keys)
        joined = local.join(F.broadcast(keyed), match(local, keyed, self.keys), "left")
        return joined.withColumn(name, F.coalesce("_whole", name)).select(*df.columns, name)

    def close(self, df: DataFrame) -> DataFrame:
        return df.drop(CHUNK, HOT)


def aggregates(df: DataFrame, keys: Sequence[str], **scans: Running) -> DataFrame:
    """The aggregates of whole keys, in the form in which they can be continued."""
    return df.groupBy(*keys).agg(*[scan.agg.alias(name) for name, scan in scans.items()])


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measured: DataFrame | None = None,
    share: float = 1.0,
    **scans: Running,
) -> DataFrame:
    """``df`` with running aggregates per key, one output row per input row."""
    ordered = KeyedOrder(df, keys, order, measured, share)
    return ordered.close(ordered.run(ordered.rows, **scans))
