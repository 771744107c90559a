"""Changelogs of streams: folded up to each batch they are the result of the rows until then."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from keyflow.operators import changelog
from keyflow.plans import hotsplit
from keyflow.session import scratch_dir
from keyflow.streaming import revisions

START = datetime(2024, 1, 1)
DELAY, ALLOWED = timedelta(hours=1), timedelta(minutes=30)
SCHEMA = "seq long, id string, ts timestamp_ntz, vc int, arrival int"


def arrivals(n, seed):
    """Rows in the order of arrival, some of them hours late; one key has most of them. Now and then there is a pause."""
    pick = random.Random(seed)
    out = []
    for k in range(n):
        ts = START + timedelta(hours=5 * ((k + 10) // 60), minutes=4 * k - pick.choice([0, 0, 5, 40, 100, 200, 600]) + pick.randrange(3))
        out.append((k, pick.choice(["a", "a", "a", "b", None]), ts, pick.randrange(4), k))
    return out


def judged(rows, ends, allowed=ALLOWED):
    """Each row's end that is in time, and the watermark after the last row."""
    newest, kept, late = None, [], []
    for row in rows:
        for end in ends(row):
            in_time = newest is None or end + allowed > newest - DELAY
            (kept if in_time else late).append((row, end))
        newest = row[2] if newest is None else max(newest, row[2])
    return kept, late, newest - DELAY


def sessions(rows):
    until = lambda row: row[2] + timedelta(hours=1 + row[3])
    kept, late, watermark = judged(rows, lambda row: [until(row)])
    found = []
    for row, end in sorted(kept, key=lambda x: (str(x[0][1]), x[0][2], x[0][0])):
        if found and found[-1][0] == row[1] and row[2] <= found[-1][2]:
            found[-1][2] = max(found[-1][2], end)
            found[-1][3] += 1
            found[-1][4] += row[3]
        else:
            found.append([row[1], row[2], end, 1, row[3]])
    return [tuple(s) for s in found if s[2] <= watermark], [tuple(s) for s in found if s[2] > watermark], late


def ranks(rows):
    half = timedelta(minutes=30)
    ends = lambda row: [row[2] - (row[2] - START) % half + half * k for k in (1, 2)]
    kept, late, watermark = judged(rows, ends)
    out = []
    counts = Counter((end, row[3]) for row, end in kept if end <= watermark)
    for end in {end for end, _ in counts}:
        best = sorted((-n, vc) for (e, vc), n in counts.items() if e == end)[:2]
        out += [(end - 2 * half, end, vc, -n, rank) for rank, (n, vc) in enumerate(best, 1)]
    return out, late


def batches(spark, rows, write, cuts):
    """Hands over the rows in micro-batches, one of them twice, as after a failure."""
    for k, (low, high) in enumerate(zip(cuts, cuts[1:])):
        part = rows[low:high]
        df = spark.createDataFrame(random.Random(k).sample(part, len(part)), SCHEMA).repartition(3)
        for _ in range(2 if k == 2 else 1):
            write(df, k)


def prefix(spark, folder, batch_id):
    changes = spark.read.parquet(f"{folder}/changes").where(f"batch <= {batch_id}").drop("batch")
    return Counter(tuple(r) for r in changelog.folded(changes).collect()), changes


def sums():
    return {"cnt": hotsplit.count(), "sum_vc": hotsplit.total("vc")}


@pytest.mark.parametrize("rows_per_task", [None, 25])
def test_sessions_folded_up_to_each_batch(spark, rows_per_task, monkeypatch):
    if rows_per_task:
        spark.conf.set("keyflow.rowsPerTask", str(rows_per_task))
    try:
        rows, cuts = arrivals(180, 3), [0, 50, 51, 120, 180]
        folder = scratch_dir(spark, "revised")
        gap = (1 + F.col("vc")) * 3600
        write = revisions.session_changes(
            folder, ["id"], "ts", gap, "4 hours", "1 hour", "30 minutes", ["arrival", "seq"], **sums()
        )
        batches(spark, rows, write, cuts)
        for k, high in enumerate(cuts[1:]):
            fired, unfired, late = sessions(rows[:high])
            got, changes = prefix(spark, folder, k)
            assert got == Counter(fired), k
        assert changes.where("change < 0").count() > 0 and late
        assert Counter(tuple(r) for r in revisions.unfired_sessions(spark, folder, ["id"], **sums()).collect()) == Counter(unfired)
        missed = [r["seq"] for r in spark.read.parquet(f"{folder}/late").collect()]
        assert sorted(missed) == sorted(row[0] for row, _ in late)
    finally:
        spark.conf.unset("keyflow.rowsPerTask")


def test_top_n_folded_up_to_each_batch(spark):
    rows, cuts = arrivals(180, 4), [0, 60, 61, 130, 180]
    folder = scratch_dir(spark, "revised")
    write = revisions.top_changes(folder, "vc", "ts", "1 hour", "30 minutes", 2, "1 hour", "30 minutes", ["arrival", "seq"])
    batches(spark, rows, write, cuts)
    for k, high in enumerate(cuts[1:]):
        want, late = ranks(rows[:high])
        got, changes = prefix(spark, folder, k)
        assert got == Counter(want), k
    assert changes.where("change < 0").count() > 0 and late
    missed = [(r["seq"], r["window_end"]) for r in spark.read.parquet(f"{folder}/late").collect()]
    assert sorted(missed) == sorted((row[0], end) for row, end in late)


def test_rows_without_time_and_empty_batches(spark):
    rows = [(0, "a", None, 1, 0), (1, "a", START, 1, 1), (2, None, None, 1, 2)]
    for make in (
        lambda f: revisions.session_changes(f, ["id"], "ts", 60, "1 minute", "1 hour", "1 hour", ["arrival"], **sums()),
        lambda f: revisions.top_changes(f, "vc", "ts", "1 hour", "30 minutes", 2, "1 hour", "1 hour", ["arrival"]),
    ):
        folder = scratch_dir(spark, "revised")
        write = make(folder)
        write(spark.createDataFrame([], SCHEMA), 0)
        write(spark.createDataFrame(rows, SCHEMA), 1)
        write(spark.createDataFrame([], SCHEMA), 2)
        write(spark.createDataFrame([(3, "a", START + timedelta(hours=9), 1, 3)], SCHEMA), 3)
        assert sorted(r["seq"] for r in spark.read.parquet(f"{folder}/late").collect()) == [0, 2]
        got = [r["window_start"] for r in changelog.folded(spark.read.parquet(f"{folder}/changes")).collect()]
        assert got and max(got) == START


def test_changes_of_repeated_rows(spark):
    table = lambda *rows: spark.createDataFrame(rows, "k string, v int")
    was, now = table(("a", 1), ("a", 1), (None, 2), ("b", 3)), table(("a", 1), (None, 2), ("c", 4), ("c", 4))
    changes = changelog.differences(was, now)
    assert Counter(tuple(r) for r in changes.collect()) == Counter([("a", 1, -1), ("b", 3, -1), ("c", 4, 2)])
    whole = changes.unionByName(was.withColumn("change", F.lit(1)))
    assert Counter(tuple(r) for r in changelog.folded(whole).collect()) == Counter(tuple(r) for r in now.collect())
    totals = changelog.folded_totals(whole, ["k"], "v").collect()
    assert Counter(tuple(r) for r in totals) == Counter([("a", 1, 1), (None, 1, 2), ("c", 2, 8)])
    assert changelog.folded(changes.limit(0)).count() == 0
