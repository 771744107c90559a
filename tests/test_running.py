import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.functions.accumulator import Accumulator, LevelCounts, Mean, Reduce
from keyflow.operators import running, scan
from keyflow.plans import hotsplit
from keyflow.schema import ARRIVAL_ORDER

from conftest import seconds

KEY = ["id"]


def by_seq(df):
    return df.orderBy("seq").collect()


@pytest.fixture
def four(readings):
    return readings(("s1", 1, 1), ("s1", 11, 1), ("s2", 2, 1), ("s3", 3, 1))


def test_reduce_keeps_first_record(four, layout):
    rows = by_seq(running.running_sum(four, KEY, ARRIVAL_ORDER, "vc"))
    assert [(row.id, seconds(row.first_ts), row.running_vc) for row in rows] == [
        ("s1", 1, 1), ("s1", 1, 2), ("s2", 2, 1), ("s3", 3, 1)
    ]


def test_max_by_keeps_earlier_on_ties(four, layout):
    rows = by_seq(running.running_max_by(four, KEY, ARRIVAL_ORDER, "vc"))
    assert [(row.id, seconds(row.best.ts), row.best.vc) for row in rows] == [
        ("s1", 1, 1), ("s1", 1, 1), ("s2", 2, 1), ("s3", 3, 1)
    ]
    rows = by_seq(running.running_max(four, KEY, ARRIVAL_ORDER, "vc"))
    assert [(row.id, seconds(row.first_ts), row.running_vc) for row in rows][1] == ("s1", 1, 1)


def test_jump_alarm(readings, layout):
    table = readings(("a", 1, 12), ("a", 2, 15), ("a", 3, 30), ("a", 4, 19), ("b", 1, None), ("b", 2, 11))
    rows = by_seq(running.jump_alarm(table, KEY, ARRIVAL_ORDER))
    assert [(row.curr, row["last"]) for row in rows] == [(12, 0), (30, 15), (19, 30), (11, 0)]


def test_top3(readings, layout):
    table = readings(*[("a", t, vc) for t, vc in enumerate([5, 1, 9, 7, 9])])
    rows = by_seq(running.top_running(table, KEY, ARRIVAL_ORDER))
    assert [row.top for row in rows] == [[5], [5, 1], [9, 5, 1], [9, 7, 5], [9, 9, 7]]
    final = running.top_final(table, KEY, ARRIVAL_ORDER).orderBy("rank").collect()
    assert [row.vc for row in final] == [9, 9, 7]


def test_mean(readings, layout):
    table = readings(("a", 1, 2), ("a", 2, 4), ("a", 3, 9))
    assert [row["mean"] for row in by_seq(running.running_mean(table, KEY, ARRIVAL_ORDER))] == [2.0, 3.0, 5.0]


@pytest.fixture
def crowded(readings):
    """One key with two thirds of the rows, equal times, missing levels and missing keys."""
    draw = random.Random(7)
    rows = []
    for _ in range(300):
        key = draw.choice(["hot", "hot", "hot", "hot", "a", None])
        rows.append((key, draw.randrange(40), draw.choice([None, *range(30)])))
    return readings(*rows), rows


def brute(rows, step):
    """``step(history)`` after each row, the history being the levels of its key so far."""
    out = {}
    histories = {}
    for seq, (key, _, level) in sorted(enumerate(rows), key=lambda item: (item[1][1], item[0])):
        histories.setdefault(key, []).append(level or 0)
        out[seq] = step(histories[key])
    return [out[seq] for seq in range(len(rows))]


def test_crowded_key(crowded, layout):
    table, rows = crowded
    level = table.withColumn("vc", running.level_or_zero())
    got = [row.running_vc for row in by_seq(running.running_sum(level, KEY, ARRIVAL_ORDER, "vc"))]
    assert got == brute(rows, sum)
    got = [row.running_vc for row in by_seq(running.running_min(level, KEY, ARRIVAL_ORDER, "vc"))]
    assert got == brute(rows, min)
    got = [row.top for row in by_seq(running.top_running(table, KEY, ARRIVAL_ORDER, n=4))]
    assert got == brute(rows, lambda levels: sorted(levels, reverse=True)[:4])
    got = [row.cnt for row in by_seq(running.level_counts_running(table, KEY, ARRIVAL_ORDER))]
    assert got == brute(rows, lambda levels: levels.count(levels[-1]))


def test_crowded_key_with_accumulators(crowded, layout):
    table, rows = crowded

    def scanned(accumulator, kind):
        out = scan.keyed_scan(table, KEY, ARRIVAL_ORDER, accumulator, ["vc"], "out", kind)
        return [row.out for row in by_seq(out)]

    assert scanned(Mean(), T.DoubleType()) == brute(rows, lambda levels: sum(levels) / len(levels))
    assert scanned(LevelCounts(), T.StringType()) == brute(
        rows, lambda levels: ",".join(f"{level}={levels.count(level)}" for level in sorted(set(levels)))
    )
    table = table.withColumn("vc", running.level_or_zero())
    assert scanned(Reduce(max), T.LongType()) == brute(rows, max)
    folded = scan.fold(table, KEY, Mean(), ["vc"], "mean", T.DoubleType()).collect()
    assert len(folded) == len({key for key, _, _ in rows})
    for row in folded:
        levels = [level or 0 for key, _, level in rows if key == row.id]
        assert row["mean"] == sum(levels) / len(levels)


def test_times_with_a_zone(crowded, layout):
    table, rows = crowded
    zoned = table.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("vc", running.level_or_zero())
    got = [row.running_vc for row in by_seq(running.running_max(zoned, KEY, ARRIVAL_ORDER, "vc"))]
    assert got == brute(rows, max)


def test_chunks_do_not_exceed_their_size(crowded, spark):
    from keyflow.plans.hotsplit import CHUNK, KeyedOrder

    spark.conf.set("keyflow.rowsPerTask", "25")
    try:
        ordered = KeyedOrder(crowded[0], KEY, ARRIVAL_ORDER)
        sizes = ordered.rows.groupBy("id", CHUNK).count().collect()
    finally:
        spark.conf.unset("keyflow.rowsPerTask")
    hot = [row for row in sizes if row.id == "hot"]
    assert len(hot) > 5 and max(row["count"] for row in hot) <= 25
    assert {row[CHUNK] for row in hot} == set(range(len(hot)))


def test_overall_plan_has_one_shuffle(crowded):
    from io import StringIO
    from contextlib import redirect_stdout

    text = StringIO()
    with redirect_stdout(text):
        running.running_mean(crowded[0], KEY, ARRIVAL_ORDER).explain()
    assert text.getvalue().count("Exchange") == 1


def test_bucket_counter(spark, layout):
    table = spark.range(20).withColumnRenamed("id", "seq")
    rows = by_seq(running.bucket_counter(table, 3, F.col("seq"), ["seq"]))
    assert [row.cnt for row in rows] == [seq // 3 + 1 for seq in range(20)]


def kept(kind):
    """Defined inside a function, so that it travels to the tasks as it is."""

    class Kept(Accumulator):
        """Hands out the very list, dict or nested list that it goes on changing."""

        def __init__(self, kind):
            self.kind = kind

        def create(self):
            return {} if self.kind == "dict" else []

        def add(self, state, row):
            level = row[0] or 0
            if self.kind == "dict":
                state[level] = state.get(level, 0) + 1
            else:
                state.append([level] if self.kind == "nested" else level)
            return state

        def merge(self, early, late):
            if self.kind == "dict":
                for level, n in late.items():
                    early[level] = early.get(level, 0) + n
                return early
            early.extend(late)
            return early

    return Kept(kind)


@pytest.mark.parametrize(
    "kind, out, want",
    [
        ("list", T.ArrayType(T.LongType()), list),
        ("nested", T.ArrayType(T.ArrayType(T.LongType())), lambda levels: [[level] for level in levels]),
        ("dict", T.MapType(T.LongType(), T.LongType()), lambda levels: {level: levels.count(level) for level in levels}),
    ],
)
def test_results_do_not_change_with_their_state(crowded, layout, kind, out, want):
    table, rows = crowded
    got = scan.keyed_scan(table, KEY, ARRIVAL_ORDER, kept(kind), ["vc"], "out", out)
    assert [row.out for row in by_seq(got)] == brute(rows, want)


@pytest.mark.parametrize("kind", ["string", "binary", "date", "boolean", "timestamp", "decimal(20,3)"])
def test_ties_by_other_order_columns(spark, layout, kind):
    """The earliest of equal records stays, whatever the type of the order column."""
    order = ["a", "ab", "b", "", "aé", "é", "ab0"] if kind in ("string", "binary") else list(range(7))
    if kind == "boolean":
        order = [1, 0]
    draw = random.Random(2)
    rows = [(k, draw.choice("xy"), value, draw.randrange(3)) for k, value in enumerate(order)]
    table = spark.createDataFrame(rows, f"seq bigint, id string, o {'string' if kind in ('string', 'binary') else 'int'}, vc int")
    if kind == "date":
        table = table.withColumn("o", F.date_from_unix_date("o"))
    else:
        table = table.withColumn("o", F.col("o").cast(kind))
    for name in ("o", ["o", "seq"]):
        by = [name] if isinstance(name, str) else name
        best = running.max_by_final(table, KEY, by, "vc").select("id", "best.vc", "best.seq").collect()
        keys = {row.seq: row.o for row in table.collect()}
        for row in best:
            mine = [(k, vc) for k, key, _, vc in rows if key == row.id]
            top = max(vc for _, vc in mine)
            first = min((key_of(keys[k]), k) for k, vc in mine if vc == top)
            assert (row.vc, key_of(keys[row.seq])) == (top, first[0])
        scanned = running.running_max_by(table, KEY, by, "vc").count()
        assert scanned == len(rows)


def key_of(value):
    return value.encode() if isinstance(value, str) else bytes(value) if isinstance(value, bytearray) else value


def test_sizes_from_a_sample_change_nothing(crowded, spark):
    table, rows = crowded
    spark.conf.set("keyflow.rowsPerTask", "20")
    try:
        level = table.withColumn("vc", running.level_or_zero())
        some = level.filter("seq % 3 = 0")
        got = hotsplit.running(level, KEY, ARRIVAL_ORDER, some, 1 / 3, n=hotsplit.total("vc"))
        assert [row.n for row in by_seq(got)] == brute(rows, sum)
    finally:
        spark.conf.unset("keyflow.rowsPerTask")


def test_chunks_of_one_order_are_small(spark, monkeypatch):
    from keyflow.plans import hotsplit

    monkeypatch.setattr(hotsplit, "ROWS_PER_CHUNK", 50, raising=False)
    ordered = hotsplit.KeyedOrder(spark.range(900), [], ["id"])
    sizes = [row["count"] for row in ordered.rows.groupBy(*ordered.partition).count().collect()]
    assert len(sizes) > 10 and max(sizes) <= 100 and sum(sizes) == 900
    assert [row.n for row in hotsplit.running(spark.range(900), [], ["id"], n=hotsplit.count()).orderBy("id").collect()] == list(range(1, 901))
