"""Every query over streams on tables that come as six shuffled files, in several micro-batches."""

import duckdb
import pytest
from pyspark.sql import functions as F
from test_registry import SF_DIR, TABLES, _compare

from keyflow import catalog
from keyflow.session import scratch_dir
from keyflow.streaming import carry
from keyflow.streaming.run import run_query
from keyflow.streaming.slices import run_in_slices


@pytest.fixture(scope="module")
def scattered(spark):
    """The smallest tables, events and documents hashed over six files each."""
    folder = scratch_dir(spark, "scattered")
    for name in ("events", "documents"):
        rows = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        rows.repartition(6, F.xxhash64(rows.columns[0], F.lit(7))).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", [name for name in catalog.load() if name.startswith("stream_")])
def test_streams_do_not_depend_on_files(spark, duck, scattered, name, monkeypatch):
    monkeypatch.setattr("keyflow.streaming.slices.LEAST_SLICES", 4)
    _compare(spark, duck, name, scattered)


def test_slices_come_in_order_and_whole(spark):
    rows = spark.range(1000).selectExpr("id", "IF(id % 50 = 0, NULL, (id * 7919) % 97) AS t").repartition(6)
    folder, seen = scratch_dir(spark, "slices"), []

    def write(batch, batch_id):
        seen.append([(row.t, row.id) for row in batch.collect()])

    run_in_slices(rows, ["t"], folder, lambda stream: run_query(stream, write, f"{folder}/checkpoint"), slices=5)
    assert len(seen) == 5 and sum(map(len, seen)) == 1000
    bounds = [[t for t, _ in batch if t is not None] for batch in seen]
    assert all(max(a) < min(b) for a, b in zip(bounds, bounds[1:]))


@pytest.mark.parametrize("slices", [2, 12])
def test_the_table_is_read_as_often_for_any_number_of_slices(spark, slices):
    met = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            met.add(batch.num_rows)
            yield batch

    rows = spark.range(600).repartition(3).mapInArrow(counting, "id long")
    folder, seen = scratch_dir(spark, "slices"), []
    run = lambda stream: run_query(stream, lambda b, i: seen.append(b.count()), f"{folder}/checkpoint")
    run_in_slices(rows, ["id"], folder, run, slices=slices)
    assert sum(seen) == 600 and len(seen) == slices
    assert met.value <= 4 * 600  # quantiles, the ranges' bounds, and the rows themselves


def test_stored_rows_are_compacted_and_dropped(spark, monkeypatch):
    """Only changed keys are stored; every few batches all are, and older folders go."""
    import os

    from keyflow.plans import hotsplit

    monkeypatch.setattr(carry, "COMPACT_EVERY", 3)
    rows = spark.range(60).selectExpr("id AS seq", "id AS t", "IF(id < 6, id, 100) AS k", "id AS v")
    folder = scratch_dir(spark, "stored")
    write = carry.running_by_key(folder, ["k"], ["t"], total=hotsplit.total("v"))
    run_in_slices(rows, ["t"], folder, lambda stream: run_query(stream, write, f"{folder}/checkpoint"), slices=8)
    got = {row.seq: row.total for row in spark.read.parquet(f"{folder}/rows").collect()}
    assert got == {n: n if n < 6 else sum(range(6, n + 1)) for n in range(60)}
    kept = sorted(name for name in os.listdir(f"{folder}/state".removeprefix("file:")) if name.startswith("batch="))
    assert kept == ["batch=6", "batch=7"]
    assert [spark.read.parquet(f"{folder}/state/{name}").count() for name in kept] == [7, 1]
    assert os.listdir(f"{folder}/input") == ["batch=7"]
