"""Joins of streams with a key that holds most of the rows."""

import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from keyflow.operators import joins
from keyflow.session import scratch_dir
from keyflow.streaming import heavy
from keyflow.streaming.run import read_batches, run_query, run_to_folder
from keyflow.streaming.slices import run_in_slices

IDS = (["left_seq"], ["right_seq"])


@pytest.fixture
def crowded(spark):
    """Nine of ten rows have one key, which only becomes heavy in the second half."""
    draw = random.Random(5)
    rows = []
    for seq in range(3000):
        key = 1 if draw.random() < (0.02 if seq < 1000 else 0.97) else draw.randrange(2, 60)
        rows.append((seq, key, None if seq % 500 == 3 else 10 * seq + draw.randrange(400), "left" if draw.random() < 0.8 else "right"))
    rows += [(5000, None, 9000, "left"), (5001, None, 9000, "right")]
    table = spark.createDataFrame(rows, "seq bigint, id bigint, s bigint, side string")
    return table.select("seq", "id", F.timestamp_seconds("s").alias("ts"), "side")


def sides(placed, *more):
    named = [(name, placed.where(F.col("side") == name)) for name in heavy.SIDES]
    return [df.select("id", *more, *[F.col(c).alias(f"{name}_{c}") for c in ("seq", "ts")]) for name, df in named]


def run_join(spark, crowded, slices):
    """Pairs from the stream, and the rows it has handed on."""
    folder = scratch_dir(spark, "crowded")
    place = heavy.place(folder, ["id"], F.window("ts", "1 hour").start)

    def pairs(placed):
        left, right = sides(placed, *heavy.SLICES)
        timed = left.withWatermark("left_ts", "1 hour"), right.withWatermark("right_ts", "1 hour")
        keys = ["id", *heavy.GRID]
        return joins.window_join(*heavy.on_grid(*timed, *IDS), keys, "left_ts", "right_ts", "1 hour", *IDS).select("id", "left_seq", "right_seq")

    def run(stream):
        run_query(stream, place, f"{folder}/placing")
        run_to_folder(pairs(heavy.placed_stream(spark, folder)), folder)

    run_in_slices(crowded, ["ts"], folder, run, slices=slices)
    placed = spark.read.parquet(f"{folder}/placed")
    return read_batches(spark, f"{folder}/out", pairs(heavy.placed_stream(spark, folder)).schema).drop("batch"), placed


@pytest.mark.parametrize("slices", [1, 4])
def test_a_key_that_becomes_heavy_is_spread_and_every_pair_is_found_once(spark, crowded, slices):
    spark.conf.set("keyflow.rowsPerTask", "50")
    try:
        got, placed = run_join(spark, crowded, slices)
    finally:
        spark.conf.unset("keyflow.rowsPerTask")
    want = joins.window_join(*sides(crowded), ["id"], "left_ts", "right_ts", "1 hour", *IDS).select("id", "left_seq", "right_seq")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

    cut = placed.where("_left_slices > 1").select("id").distinct().collect()
    assert [row.id for row in cut] == [1]  # light keys are not copied
    assert placed.count() == crowded.where("ts IS NOT NULL").count()  # F.window leaves the others out
    # All rows of a key and window agree on their slices, in whatever batch they came.
    agreed = placed.where("ts IS NOT NULL").groupBy("id", F.window("ts", "1 hour")).agg(F.count_distinct(*heavy.SLICES).alias("n"))
    assert agreed.where("n > 1").count() == 0
    if slices == 4:
        assert placed.where("id = 1").select("_left_slices").distinct().count() > 1  # whole at first, cut later


def test_tasks_of_the_join_have_about_as_much_to_do(spark):
    """One window, nine of ten rows in one key: no task of eight has over twice the median."""
    rows = spark.range(20_000).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id") % 977 + 2).alias("id"),
        F.timestamp_seconds(F.lit(60)).alias("ts"),
        F.when(F.col("id") % 7 == 0, "right").otherwise("left").alias("side"),
    )
    folder = scratch_dir(spark, "even")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("keyflow.rowsPerTask", "50")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        heavy.place(folder, ["id"], F.window("ts", "1 hour").start)(rows, 0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("keyflow.rowsPerTask")
    placed = spark.read.parquet(f"{folder}/placed")
    left, right = heavy.on_grid(*sides(placed, *heavy.SLICES), *IDS)
    tasks = Counter()
    for df in (left, right):
        for row in df.repartition(8, "id", *heavy.GRID).groupBy(F.spark_partition_id().alias("t")).count().collect():
            tasks[row.t] += row["count"]
    assert len(tasks) == 8
    assert max(tasks.values()) <= 2 * statistics.median(tasks.values())
    pairs = left.join(right, ["id", *heavy.GRID]).select("left_seq", "right_seq")
    plain = sides(rows)
    want = plain[0].join(plain[1], "id").count()
    assert pairs.count() == want


def test_a_repeated_batch_hands_the_same_rows_on(spark, crowded):
    folder = scratch_dir(spark, "again")
    place = heavy.place(folder, ["id"], F.window("ts", "1 hour").start)
    spark.conf.set("keyflow.rowsPerTask", "50")
    try:
        for batch_id, part in enumerate([crowded.where("seq < 1500"), crowded.where("seq >= 1500")]):
            place(part, batch_id)
        first = sorted(map(str, spark.read.parquet(f"{folder}/placed").collect()))
        place(crowded.where("seq >= 1500"), 1)
    finally:
        spark.conf.unset("keyflow.rowsPerTask")
    assert sorted(map(str, spark.read.parquet(f"{folder}/placed").collect())) == first


def test_summary_bounds(spark):
    """What the summary says is at most the truth, and short of it by no more than a share of all rows."""
    draw = random.Random(3)
    keys = [draw.choice([1, 1, 1, 1, 2, 2, 3]) if draw.random() < 0.6 else draw.randrange(4, 400) for _ in range(4000)]
    summary, capacity = None, 20
    for start in range(0, 4000, 500):
        counted = spark.createDataFrame([(k, 1) for k in keys[start : start + 500]], "id bigint, n bigint")
        summary = heavy.summarise(counted if summary is None else counted.unionByName(summary), ["id"], capacity)
    told, truth = {row.id: row.n for row in summary.collect()}, Counter(keys)
    assert len(told) <= capacity
    for key in truth:
        assert truth[key] - len(keys) / (capacity + 1) <= told.get(key, 0) <= truth[key]
    assert {1, 2, 3} <= set(told)


def test_empty_and_null(spark, crowded):
    folder = scratch_dir(spark, "empty")
    place = heavy.place(folder, ["id"], F.date_trunc("hour", "ts"))
    place(crowded.limit(0), 0)
    place(crowded.where("id IS NULL OR ts IS NULL"), 1)
    placed = spark.read.parquet(f"{folder}/placed")
    assert placed.count() == crowded.where("id IS NULL OR ts IS NULL").count()
    assert placed.where("_left_slices <> 1 OR _right_slices <> 1").count() == 0
