"""A caller's own function over the records of a key, of one or several inputs, with state and event-time timers."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from datetime import datetime
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from keyflow.plans import hotsplit

_SIDE, _WATERMARK, _FINAL = "_side", "_watermark", "_final"


class Context:
    """What a function sees of its key: ``state`` to put anything into, the watermark, timers, and where results go."""

    def __init__(self):
        self.state: dict[str, Any] = {}
        self.watermark: datetime | None = None
        self.results: list[tuple] = []
        self._pending: set[datetime] = set()
        self._heap: list[datetime] = []

    def emit(self, *values: Any) -> None:
        self.results.append(values)

    def set_timer(self, at: datetime) -> None:
        """Rings once when the watermark has reached ``at``, however often it is set until then."""
        if at not in self._pending:
            self._pending.add(at)
            heapq.heappush(self._heap, at)

    def delete_timer(self, at: datetime) -> None:
        self._pending.discard(at)

    def delete_timers(self) -> None:
        self._pending.clear()

    def due(self, watermark: datetime | None) -> Iterator[datetime]:
        """Timers that a watermark has reached, the earliest first, those included that are set meanwhile."""
        while watermark is not None and self._heap and self._heap[0] <= watermark:
            at = heapq.heappop(self._heap)
            if at in self._pending:  # neither deleted nor set a second time after that
                self._pending.discard(at)
                yield at


class KeyedProcess:
    """To be implemented by the caller. One object serves all keys, so what belongs to a key goes into its context."""

    def on_record(self, context: Context, side: int, row: dict[str, Any]) -> None:
        """A record of input number ``side``. The watermark is that of the records which arrived before it."""
        raise NotImplementedError

    def on_timer(self, context: Context, at: datetime) -> None:
        """A timer that the watermark has reached. It rings before the next record of its key."""


def process(
    inputs: Sequence[DataFrame],
    keys: Sequence[str],
    time: str,
    order: Sequence[str],
    delay: str,
    function: KeyedProcess,
    schema: str | T.StructType,
) -> DataFrame:
    """Key columns and what ``function`` emits, for the records of all inputs in the one order ``order``.

    All inputs have the columns ``keys``, ``time`` and ``order``, which tells the records of an input apart;
    equal ones of two inputs go by the number of the input. The watermark is the largest time so far less ``delay``, of the input that
    is furthest behind; there is none before each input had a record. At the end, timers up to the last watermark ring.

    A key's records are one after the other by nature, so they are one task's work: it holds the state of one key,
    never the key's records. The watermark follows from a scan of all records in chunks.
    """
    keys, order = list(keys), list(order)
    fixed = list(dict.fromkeys([*keys, time, *order]))
    merged = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [df.select(*fixed, F.lit(i).alias(_SIDE), F.struct(*df.columns).alias(f"_row{i}")) for i, df in enumerate(inputs)],
    )
    newest = {f"_newest{i}": F.when(F.col(_SIDE) == i, F.col(time)) for i in range(len(inputs))}
    sided = merged.withColumns(newest)
    seen = hotsplit.running(sided, [], [*order, _SIDE], **{f"{n}_": hotsplit.highest(n).before() for n in newest})
    last = sided.agg(*[F.max(n).alias(n) for n in newest]).select(_behind([F.col(n) for n in newest], delay).alias("w"))
    rows = seen.withColumn(_WATERMARK, _behind([F.col(f"{n}_") for n in newest], delay)).withColumn(_FINAL, last.scalar())
    sides = [f"_row{i}" for i in range(len(inputs))]
    rows = rows.select(*fixed, _SIDE, _WATERMARK, _FINAL, *sides)
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, *order, _SIDE)
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    out = T.StructType([*[merged.schema[k] for k in keys], *fields])
    kinds = [to_arrow_type(f.dataType) for f in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, context, final, made = None, Context(), None, []

        def ring(watermark: datetime | None) -> None:
            for at in context.due(watermark):
                context.watermark = watermark
                function.on_timer(context, at)

        def collect() -> None:
            made.extend((*key, *values) for values in context.results)
            context.results = []

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in (*keys, _SIDE, _WATERMARK, _FINAL)]
            contents = [batch.column(n).to_pylist() for n in sides]
            for at, (*own, side, watermark, final_) in enumerate(zip(*columns)):
                if tuple(own) != key:
                    if key is not None:
                        ring(final)
                        collect()
                    key, context = tuple(own), Context()
                final = final_
                ring(watermark)
                context.watermark = watermark
                function.on_record(context, side, contents[side][at])
                collect()
            yield _batch(made, kinds, out.names)
            made = []
        if key is not None:
            ring(final)
            collect()
            yield _batch(made, kinds, out.names)

    return rows.mapInArrow(run, out)


def _behind(newest: list[Column], delay: str) -> Column:
    """The watermark: none unless there is a newest time of each input."""
    least = F.least(*newest) if len(newest) > 1 else newest[0]
    there = reduce(lambda a, b: a & b, [n.isNotNull() for n in newest])
    return F.when(there, least - F.expr(f"INTERVAL {delay}"))


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)
