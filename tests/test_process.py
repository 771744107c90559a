import random
import sys
from datetime import datetime, timedelta

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from keyflow.operators import lateness
from keyflow.operators.process import Context, KeyedProcess, process
from keyflow.schema import ARRIVAL_ORDER

from conftest import seconds

KEY = ["id"]

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def time(s):
    return datetime(1970, 1, 1) + timedelta(seconds=s)


class Pairs(KeyedProcess):
    def on_record(self, context, side, row):
        for other in context.state.setdefault(1 - side, []):
            a, b = (row, other) if side == 0 else (other, row)
            context.emit(a["vc"], b["vc"])
        context.state.setdefault(side, []).append(row)


def test_a_function_over_two_inputs_remembers_both(readings):
    left = readings((1, 1, 1), (1, 2, 2), (2, 3, 3), (3, 4, 4), (None, 9, 9))
    right = readings((1, 1, 11), (1, 8, 12), (2, 2, 13), (3, 4, 14), (4, 5, 15), (None, 5, 16))
    out = process([left, right], KEY, "ts", ARRIVAL_ORDER, "0 seconds", Pairs(), "a int, b int")
    pairs = {(r.id, r.a, r.b) for r in out.collect()}
    assert pairs == {("1", 1, 11), ("1", 1, 12), ("1", 2, 11), ("1", 2, 12), ("2", 3, 13), ("3", 4, 14), (None, 9, 16)}
    assert process([left.limit(0), right], KEY, "ts", ARRIVAL_ORDER, "0 seconds", Pairs(), "a int, b int").count() == 0
    assert process([left.limit(0)], KEY, "ts", ARRIVAL_ORDER, "0 seconds", Pairs(), "a int, b int").count() == 0


class Log(KeyedProcess):
    """Level 1 sets a timer five seconds ahead, 2 deletes it, 3 sets one that sets another."""

    def on_record(self, context, side, row):
        context.emit("record", row["ts"], context.watermark)
        if row["vc"] == 1:
            context.set_timer(row["ts"] + timedelta(seconds=5))
            context.set_timer(row["ts"] + timedelta(seconds=5))
        elif row["vc"] == 2:
            context.delete_timers()
        elif row["vc"] == 3:
            context.set_timer(row["ts"] + timedelta(seconds=1))

    def on_timer(self, context, at):
        context.emit("timer", at, context.watermark)
        if at.second % 2:
            context.set_timer(at + timedelta(seconds=1))


def test_timers_ring_between_records_by_the_watermark(readings):
    rows = readings(("a", 0, 1), ("b", 4, 0), ("a", 5, 2), ("b", 9, 1), ("a", 8, 1), ("b", 15, 3), ("a", 12, 0), ("b", 30, 1))
    out = process([rows], KEY, "ts", ["seq"], "2 seconds", Log(), "what string, at timestamp_ntz, watermark timestamp_ntz")
    got = {}
    for r in out.collect():
        got.setdefault(r.id, []).append((r.what, seconds(r.at), None if r.watermark is None else seconds(r.watermark)))
    # The watermark is of all keys. a's timer at 5 is deleted before it (the watermark is 2), those at 13 and 14 ring at 13 and later.
    assert got["a"] == [("record", 0, None), ("record", 5, 2), ("record", 8, 7), ("timer", 13, 13), ("record", 12, 13), ("timer", 14, 28)]
    assert got["b"] == [("record", 4, -2), ("record", 9, 3), ("record", 15, 7), ("record", 30, 13), ("timer", 14, 28), ("timer", 16, 28)]


def test_a_timer_deleted_and_set_again_rings_once():
    context = Context()
    for _ in range(3):
        context.set_timer(time(5))
        context.delete_timer(time(5))
    context.set_timer(time(5))
    context.set_timer(time(3))
    assert list(context.due(time(4))) == [time(3)] and list(context.due(time(9))) == [time(5)] and not list(context.due(time(9)))
    assert not list(context.due(None))


def plain_watermarks(rows, inputs, delay, silence):
    newest, heard, first, risen, out = {}, {}, None, None, []
    for name, ts, arrival in rows:
        if first is not None:
            alive = [i for i in inputs if arrival <= heard.get(i, first) + silence]
            if alive and all(i in newest for i in alive):
                now = min(newest[i] for i in alive) - delay
                risen = now if risen is None else max(risen, now)
        out.append(risen)
        first = arrival if first is None else first
        newest[name], heard[name] = max(ts, newest.get(name, ts)), max(arrival, heard.get(name, arrival))
    return out


@pytest.mark.parametrize("silence", [3, 40, 10_000])
def test_silent_inputs_do_not_hold_the_watermark_back(spark, layout, silence):
    pick, rows, now = random.Random(8), [], 0
    for _ in range(200):
        now += pick.choice([0, 1, 1, 2, 30])
        names = "ab" if now % 200 < 120 else "a"
        rows.append((pick.choice(names + ("c" if now > 400 else "")), now - pick.randrange(20), now))
    table = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "seq long, name string, t long, got long")
    table = table.withColumns({n: F.timestamp_seconds(n).cast("timestamp_ntz") for n in ("t", "got")})
    marked = lateness.with_watermark_of_inputs(table, "name", ["a", "b", "c"], "t", "got", ["got", "seq"], "4 seconds", f"{silence} seconds")
    got = [None if r.watermark is None else seconds(r.watermark) for r in marked.orderBy("seq").collect()]
    assert got == plain_watermarks(rows, "abc", 4, silence)
    assert (got[-1] is None) == (silence == 10_000 and not any(r[0] == "c" for r in rows[:-1]))
