"""Per-key state and timers of running streams.

Each processor sees the rows of one key in one micro-batch, puts them in order, and keeps its state
in the state store between micro-batches. Bound the micro-batch at the source
(``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``): a key's rows of one batch are ordered in one task.
They suit many small keys and custom logic. Batches must come in order (see ``slices``). The functions
in ``carry`` do the same as table plans, which split a crowded key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

LONG = T.StructType().add("value", T.LongType())
SUM_COUNT = T.StructType().add("total", T.LongType()).add("n", T.LongType())


def keyed_process(
    df: DataFrame,
    keys: Sequence[str],
    processor: StatefulProcessor,
    output: T.StructType | None = None,
    mode: str = "append",
    time_mode: str = "None",
) -> DataFrame:
    """Runs a processor per key. ``time_mode`` is ``None``, ``ProcessingTime`` or ``EventTime``.

    The processors of this module say themselves what comes out of the rows they are given.
    """
    output = processor.output(df.schema, keys) if output is None else output
    return df.groupBy(*keys).transformWithState(processor, output, mode, time_mode)


class Ordered(StatefulProcessor):
    """Base of the processors: one output row per record, in the order of the columns ``order``.

    ``keep`` names the columns of a record that come out with it (those of key and order unless
    given), ``value`` the column that is worked on. Keys and columns can be of any type; values are whole
    numbers, a missing one counting as 0.
    """

    ADDED: tuple[T.StructField, ...] = ()

    def __init__(self, value: str = "vc", order: Sequence[str] = ("ts", "seq"), keep: Sequence[str] | None = None):
        self.value, self.order, self.keep = value, tuple(order), keep

    def output(self, schema: T.StructType, keys: Sequence[str]) -> T.StructType:
        if self.keep is None:
            self.keep = tuple(dict.fromkeys([*keys, *self.order]))
        return T.StructType([*[schema[name] for name in self.keep], *self.added(schema)])

    def added(self, schema: T.StructType) -> Sequence[T.StructField]:
        """The fields that the processor adds to a record."""
        return self.ADDED

    def out(self, row: Row, **made) -> Row:
        return Row(**{name: row[name] for name in self.keep}, **made)

    def level(self, row: Row) -> int:
        return row[self.value] or 0

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open()

    def open(self) -> None:
        """Declares the state."""

    def step(self, row: Row) -> Iterator[Row]:
        raise NotImplementedError

    def before(self) -> None:
        """Reads the state before a micro-batch's rows of a key."""

    def after(self) -> None:
        """Stores it afterwards."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self.before()
        for row in sorted(rows, key=lambda row: tuple(row[name] for name in self.order)):
            yield from self.step(row)
        self.after()


class JumpAlarm(Ordered):
    """Value state: the previous level, 0 at first. Reports jumps above ``jump``."""

    ADDED = (T.StructField("curr", T.LongType()), T.StructField("last", T.LongType()))

    def __init__(self, jump: int = 10, **columns):
        super().__init__(**columns)
        self.jump = jump

    def open(self):
        self.state = self.handle.getValueState("last", LONG)

    def before(self):
        stored = self.state.get()
        self.last = stored[0] if stored is not None else 0

    def step(self, row):
        level = self.level(row)
        if abs(level - self.last) > self.jump:
            yield self.out(row, curr=level, last=int(self.last))
        self.last = level

    def after(self):
        self.state.update((self.last,))


class TopLevels(Ordered):
    """List state: the ``n`` largest levels, largest first."""

    ADDED = (T.StructField("top", T.ArrayType(T.LongType())),)

    def __init__(self, n: int = 3, **columns):
        super().__init__(**columns)
        self.n = n

    def open(self):
        self.state = self.handle.getListState("top", LONG)

    def before(self):
        self.top = [int(entry[0]) for entry in self.state.get()] if self.state.exists() else []

    def step(self, row):
        self.top = sorted([*self.top, self.level(row)], reverse=True)[: self.n]
        yield self.out(row, top=list(self.top))

    def after(self):
        self.state.put([(level,) for level in self.top])


class LevelCounter(Ordered):
    """Map state: how often each level occurred. Reports the count of the record's own level."""

    def added(self, schema):
        return (T.StructField(self.value, T.LongType()), T.StructField("cnt", T.LongType()))

    def open(self):
        self.state = self.handle.getMapState("counts", LONG, LONG)

    def before(self):
        self.counts = {}

    def step(self, row):
        level = self.level(row)
        if level not in self.counts:
            stored = self.state.getValue((level,))
            self.counts[level] = 0 if stored is None else stored[0]
        self.counts[level] += 1
        yield self.out(row, **{self.value: level, "cnt": self.counts[level]})

    def after(self):
        for level, count in self.counts.items():
            self.state.updateValue((level,), (count,))


class RunningReduce(Ordered):
    """Reducing state: folds levels with an associative function, the first taken as it is."""

    ADDED = (T.StructField("value", T.LongType()),)

    def __init__(self, function, **columns):
        super().__init__(**columns)
        self.function = function

    def open(self):
        self.state = self.handle.getValueState("reduced", LONG)

    def before(self):
        stored = self.state.get()
        self.reduced = None if stored is None else stored[0]

    def step(self, row):
        level = self.level(row)
        self.reduced = level if self.reduced is None else self.function(self.reduced, level)
        yield self.out(row, value=self.reduced)

    def after(self):
        self.state.update((self.reduced,))


class RunningMean(Ordered):
    """Aggregating state: sum and count, reported as the mean."""

    ADDED = (T.StructField("mean", T.DoubleType()),)

    def open(self):
        self.state = self.handle.getValueState("sum_count", SUM_COUNT)

    def before(self):
        stored = self.state.get()
        self.total, self.n = (0, 0) if stored is None else (stored[0], stored[1])

    def step(self, row):
        self.total, self.n = self.total + self.level(row), self.n + 1
        yield self.out(row, mean=self.total / self.n)

    def after(self):
        self.state.update((self.total, self.n))


class TaskCounter(Ordered):
    """Operator state: how many records each bucket has counted."""

    ADDED = (T.StructField("cnt", T.LongType()),)

    def open(self):
        self.state = self.handle.getValueState("count", LONG)

    def before(self):
        stored = self.state.get()
        self.n = 0 if stored is None else stored[0]

    def step(self, row):
        self.n += 1
        yield self.out(row, cnt=self.n)

    def after(self):
        self.state.update((self.n,))


def _utc(millis: int) -> datetime:
    return datetime.fromtimestamp(millis / 1000, tz=timezone.utc)


def with_millis(df: DataFrame, time: str = "ts") -> DataFrame:
    """Adds ``ts_ms``, the event time in milliseconds: timers are set in milliseconds."""
    return df.withColumn("ts_ms", F.unix_millis(time))


class EventTimers(StatefulProcessor):
    """Each record sets a timer ``after_ms`` past its event time. Reports key and time when it fires.

    Spark drops records behind its watermark before they come here. ``carry.event_timers`` loses none.
    """

    def __init__(self, after_ms: int, time: str = "ts_ms"):
        self.after_ms, self.time, self.names = after_ms, time, ()

    def output(self, schema: T.StructType, keys: Sequence[str]) -> T.StructType:
        self.names = tuple(keys)
        return T.StructType([*[schema[name] for name in keys], T.StructField("fires_at", T.TimestampType())])

    def fired(self, key, millis: int) -> Row:
        return Row(**dict(zip(self.names, key)), fires_at=_utc(millis))

    def init(self, handle):
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues):
        for due in {row[self.time] + self.after_ms for row in rows}:
            self.handle.registerTimer(due)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield self.fired(key, expiredTimerInfo.getExpiryTimeInMs())


class ProcessingTimers(EventTimers):
    """Each record sets a timer ``after_ms`` past the current processing time."""

    def handleInputRows(self, key, rows, timerValues):
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.after_ms)
        return iter(())


class SilenceAlarm(EventTimers):
    """Fires when a key had no record for longer than ``after_ms`` of event time.

    Each record deletes the key's timer and sets a later one. A record that itself comes after the
    silence reports it, since its own micro-batch would delete the timer before it fires.
    """

    def init(self, handle):
        self.handle = handle
        self.state = handle.getValueState("timer", LONG)

    def handleInputRows(self, key, rows, timerValues):
        stored = self.state.get()
        armed = due = None if stored is None else stored[0]
        for time in sorted(row[self.time] for row in rows):
            if due is not None and time > due:
                yield self.fired(key, due)
            due = time + self.after_ms if due is None else max(due, time + self.after_ms)
        if due != armed:
            if armed is not None:
                self.handle.deleteTimer(armed)
            self.handle.registerTimer(due)
            self.state.update((due,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.state.clear()
        yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)
