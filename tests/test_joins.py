import random

import pytest
from pyspark.sql import functions as F

from keyflow.operators import joins, lateness
from keyflow.plans.saltjoin import _grid, skew_join


def test_keyed_connect(spark, layout):
    left = spark.createDataFrame([(1, "a1"), (1, "a2"), (2, "b1"), (3, "c1")], "k int, x string")
    right = spark.createDataFrame([(1, "a3", 1), (1, "a4", 2), (2, "b2", 3), (3, "c2", 4)], "k int, y string, z int")
    pairs = joins.keyed_connect(left, right, ["k"], ["x"], ["y"])
    assert sorted((row.x, row.y) for row in pairs.collect()) == [
        ("a1", "a3"), ("a1", "a4"), ("a2", "a3"), ("a2", "a4"), ("b1", "b2"), ("c1", "c2")
    ]


@pytest.fixture
def sides(spark):
    left = [("a", 1), ("a", 2), ("b", 3), ("c", 4)]
    right = [("a", 1), ("a", 11), ("b", 2), ("b", 12), ("c", 8), ("d", 20)]

    def make(rows, side):
        table = spark.createDataFrame([(n, *row) for n, row in enumerate(rows)], f"{side}_n int, k string, {side}_s int")
        return table.withColumn(f"{side}_ts", F.timestamp_seconds(f"{side}_s").cast("timestamp_ntz"))

    return make(left, "left"), make(right, "right")


EXPECTED = [("a", 1, 1), ("a", 2, 1), ("b", 3, 2)]


def found(df):
    return sorted((row.k, row.left_s, row.right_s) for row in df.collect())


@pytest.mark.parametrize("bucket", [None, 1, 3, 100])
def test_interval_join(sides, layout, bucket):
    joined = joins.interval_join(*sides, ["k"], "left_ts", "right_ts", -2, 2, ["left_n"], ["right_n"], bucket)
    assert found(joined) == EXPECTED


def test_window_join(sides, layout):
    joined = joins.window_join(*sides, ["k"], "left_ts", "right_ts", "5 seconds", ["left_n"], ["right_n"])
    assert found(joined) == EXPECTED


@pytest.mark.parametrize("limit", [3, 10, 1000])
def test_salted_join_of_crowded_keys(spark, limit):
    draw = random.Random(5)
    keys = ["hot", "hot", "hot", "warm", "a", "b", None]
    left = [(n, draw.choice(keys)) for n in range(120)]
    right = [(n, draw.choice(keys + ["warm"] * 5)) for n in range(90)]
    spark.conf.set("keyflow.rowsPerTask", str(limit))
    try:
        joined = skew_join(
            spark.createDataFrame(left, "l int, k string"), spark.createDataFrame(right, "r int, k string"), ["k"], ["l"], ["r"]
        )
        pairs = sorted((row.l, row.r) for row in joined.collect())
    finally:
        spark.conf.unset("keyflow.rowsPerTask")
    assert pairs == sorted((n, m) for n, k in left for m, j in right if k is not None and k == j)


def test_interval_join_with_late(spark, layout):
    """Late is what comes before the smaller of both sides' newest times, less the delay."""
    rows = [("left", "a", 10), ("right", "a", 11), ("left", "a", 20), ("right", "a", 5), ("right", "a", 19),
            ("left", "a", 9), ("left", "a", 18), ("right", "a", 30), ("right", "a", 16), ("left", "a", 17)]
    table = spark.createDataFrame([(n, *row) for n, row in enumerate(rows)], "seq int, side string, k string, s int")
    merged = table.withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))
    joined, late = joins.interval_join_with_late(merged, ["k"], "ts", ["seq"], "3 seconds", -2, 2, "seq")

    expected_late, newest, kept = [], {}, {"left": [], "right": []}
    for seq, (side, _, second) in enumerate(rows):
        if len(newest) == 2 and second < min(newest.values()) - 3 - 0.001:
            expected_late.append(seq)
        else:
            kept[side].append(second)
        newest[side] = max(newest.get(side, 0), second)
    assert sorted(row.seq for row in late.collect()) == expected_late and expected_late
    assert found(joined) == sorted(("a", m, n) for m in kept["left"] for n in kept["right"] if abs(m - n) <= 2)


def test_merge_sides(readings):
    merged = lateness.merge_sides(readings(("a", 1, 1)), readings(("a", 2, 2)))
    assert sorted((row.side, row.vc) for row in merged.collect()) == [("left", 1), ("right", 2)]


def test_threshold_follows_config(readings, layout):
    rows = [("r", 1, 15), ("config", 2, 20), ("r", 3, 15), ("r", 4, 25), ("config", 5, 30), ("config", 6, 1), ("r", 7, 2)]
    alerts = joins.broadcast_threshold(readings(*rows), F.col("id") == "config", "vc", ["seq"]).orderBy("seq").collect()
    assert [(row.vc, row.threshold) for row in alerts] == [(15, 10), (25, 20), (2, 1)]


def test_a_key_with_too_many_pairs_is_spread(spark):
    """Few rows on each side, below the row limit, but many pairs."""
    left = spark.range(60).selectExpr("IF(id < 50, 1, id) AS k", "id AS x")
    right = spark.range(80).selectExpr("IF(id < 70, 1, id) AS k", "id AS y")
    want = sorted(map(tuple, left.join(right, "k").select("x", "y").collect()))
    plain = skew_join(left, right, ["k"], ["x"], ["y"])
    assert sorted(map(tuple, plain.select("x", "y").collect())) == want
    spark.conf.set("keyflow.pairsPerTask", "400")
    try:
        grid = _grid(left, right, ["k"], ["x"], ["y"])
        got = sorted(map(tuple, skew_join(left, right, ["k"], ["x"], ["y"]).select("x", "y").collect()))
    finally:
        spark.conf.unset("keyflow.pairsPerTask")
    (hot,) = grid.collect()
    assert hot["_r_k"] == 1 and 50 / hot["_na"] * 70 / hot["_nb"] <= 400
    assert got == want
