"""Folds with a user-supplied accumulator: per record, per key and per window."""

from __future__ import annotations

import copy
import pickle
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from keyflow.functions.accumulator import Accumulator
from keyflow.plans.hotsplit import CHUNK, KeyedOrder

_STATE = "_state"

# A task folding unsorted rows hands its states on when it holds this many keys.
STATES_PER_TASK = 50_000


def _tuples(batch: pa.RecordBatch, names: Sequence[str]) -> list[tuple]:
    columns = [batch.column(name).to_pylist() for name in names]
    return list(zip(*columns)) if columns else [()] * batch.num_rows


def _frozen(result: object) -> object:
    """The result as it is now: accumulators may hand out the very state that they go on changing."""
    return result if isinstance(result, (str, int, float, bool, bytes, type(None))) else copy.deepcopy(result)


def fold(df: DataFrame, keys: Sequence[str], accumulator: Accumulator, inputs: Sequence[str], output: str, output_type: T.DataType) -> DataFrame:
    """One row per key with the accumulator's result. The fold must not depend on row order.

    Rows are folded where they are; only one state per task and key is shuffled and merged.
    """
    states = _partial_states(df, keys, accumulator, inputs)
    merged = _merge_states(states.repartition(*keys).sortWithinPartitions(*keys), keys, accumulator)
    return _results(merged, keys, accumulator, output, output_type)


def _state_schema(df: DataFrame, keys: Sequence[str]) -> T.StructType:
    return T.StructType([df.schema[key] for key in keys] + [T.StructField(_STATE, T.BinaryType())])


def _to_batch(keys: dict[tuple, object], types: list[pa.DataType], schema: T.StructType) -> pa.RecordBatch:
    columns = list(zip(*keys.keys())) if keys else [() for _ in types[:-1]]
    arrays = [pa.array(list(column), type=kind) for column, kind in zip(columns, types)]
    arrays.append(pa.array([pickle.dumps(state) for state in keys.values()], type=pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def _partial_states(df, keys, accumulator, inputs) -> DataFrame:
    schema = _state_schema(df, keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, object] = {}
        types = None
        for batch in batches:
            types = [batch.schema.field(key).type for key in keys] + [pa.binary()]
            for key, row in zip(_tuples(batch, keys), _tuples(batch, inputs)):
                state = states[key] if key in states else accumulator.create()
                states[key] = accumulator.add(state, row)
            if len(states) > STATES_PER_TASK:
                yield _to_batch(states, types, schema)
                states = {}
        if states:
            yield _to_batch(states, types, schema)

    needed = dict.fromkeys([*keys, *inputs])
    return df.select(*needed).mapInArrow(run, schema)


def _merge_states(sorted_states: DataFrame, keys, accumulator) -> DataFrame:
    schema = _state_schema(sorted_states, keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, types = None, None, None
        for batch in batches:
            types = [batch.schema.field(key).type for key in keys] + [pa.binary()]
            done: dict[tuple, object] = {}
            for key, blob in zip(_tuples(batch, keys), batch.column(_STATE).to_pylist()):
                if key == current:
                    state = accumulator.merge(state, pickle.loads(blob))
                    continue
                if current is not None:
                    done[current] = state
                current, state = key, pickle.loads(blob)
            if done:
                yield _to_batch(done, types, schema)
        if current is not None:
            yield _to_batch({current: state}, types, schema)

    return sorted_states.mapInArrow(run, schema)


def _results(states: DataFrame, keys, accumulator, output, output_type) -> DataFrame:
    schema = T.StructType([states.schema[key] for key in keys] + [T.StructField(output, output_type)])
    kind = to_arrow_type(output_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [accumulator.result(pickle.loads(blob)) for blob in batch.column(_STATE).to_pylist()]
            arrays = [batch.column(key) for key in keys] + [pa.array(made, type=kind)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return states.mapInArrow(run, schema)


def keyed_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    accumulator: Accumulator,
    inputs: Sequence[str],
    output: str,
    output_type: T.DataType,
) -> DataFrame:
    """After each record, the accumulator's result over its key so far. A task holds one state at a time.

    A key with too many rows is cut into chunks of its order. Each chunk then starts from the merged
    state of the chunks before it, which is fed in as a row sorting ahead of the chunk's own.
    """
    ordered = KeyedOrder(df, keys, order)
    rows = ordered.rows.withColumn(_STATE, F.lit(None).cast("binary"))
    if ordered.cut:
        rows = rows.unionByName(_seeds(ordered, accumulator, inputs), allowMissingColumns=True)
    rows = rows.repartition(*ordered.partition).sortWithinPartitions(
        *ordered.partition, F.col(_STATE).isNull(), *ordered.order
    )
    columns = df.columns
    partition = ordered.partition
    schema = T.StructType([*df.schema.fields, T.StructField(output, output_type)])
    kind = to_arrow_type(output_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            keep, made = [], []
            seeds = batch.column(_STATE).to_pylist()
            for key, seed, row in zip(_tuples(batch, partition), seeds, _tuples(batch, inputs)):
                if key != current:
                    current, state = key, accumulator.create()
                if seed is not None:
                    state = pickle.loads(seed)
                    keep.append(False)
                    continue
                state = accumulator.add(state, row)
                keep.append(True)
                made.append(_frozen(accumulator.result(state)))
            kept = batch.filter(pa.array(keep, type=pa.bool_()))
            arrays = [kept.column(name) for name in columns] + [pa.array(made, type=kind)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.mapInArrow(run, schema)


def _seeds(ordered: KeyedOrder, accumulator: Accumulator, inputs: Sequence[str]) -> DataFrame:
    """Per chunk of a hot key, the state at its start. One small row per chunk goes through here."""
    hot = ordered.hot(ordered.rows)
    keys = [*ordered.keys, CHUNK]
    in_order = hot.repartition(*keys).sortWithinPartitions(*keys, *ordered.order)
    parts = _merge_states(_partial_states(in_order, keys, accumulator, inputs), keys, accumulator)
    per_key = parts.repartition(*ordered.keys) if ordered.keys else parts.coalesce(1)
    per_key = per_key.sortWithinPartitions(*keys)
    schema = _state_schema(parts, keys)
    names = ordered.keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            starts = []
            for key, blob in zip(_tuples(batch, names), batch.column(_STATE).to_pylist()):
                if key != current:
                    current, state = key, accumulator.create()
                starts.append(pickle.dumps(state))
                state = accumulator.merge(state, pickle.loads(blob))
            arrays = [batch.column(key) for key in keys] + [pa.array(starts, type=pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return per_key.mapInArrow(run, schema)
