import random

from pyspark.sql import functions as F

from keyflow.operators import lateness, sliding, timers, topn, windows
from keyflow.plans import hotsplit
from keyflow.schema import ARRIVAL_ORDER

from conftest import seconds

KEY = ["id"]


def spans(df, *names):
    rows = df.collect()
    rows = sorted(rows, key=lambda row: (row.id, row.window_start, *([row.position] if "position" in df.columns else [])))
    return [(seconds(row.window_start), seconds(row.window_end), *[row[name] for name in names]) for row in rows]


def test_tumbling_and_sliding(readings):
    table = readings(("a", 0, 1), ("a", 9, 2), ("a", 10, 4))
    sums = {"s": F.sum("vc")}
    assert spans(windows.time_window(table, KEY, "ts", "10 seconds", **sums), "s") == [(0, 10, 3), (10, 20, 4)]
    assert spans(windows.time_window(table, KEY, "ts", "10 seconds", "5 seconds", **sums), "s") == [
        (-5, 5, 1), (0, 10, 3), (5, 15, 6), (10, 20, 4)
    ]


def test_window_reduce_and_process(readings, layout):
    table = readings(("a", 3, 1), ("a", 1, 2), ("a", 9, 3), ("a", 12, 4))
    reduced = windows.window_reduce(table, KEY, "ts", "10 seconds", ARRIVAL_ORDER, "vc")
    assert [(seconds(row.first_ts), row.sum_vc) for row in reduced.orderBy("window_start").collect()] == [(1, 6), (12, 4)]
    rows = windows.window_process(table, KEY, "ts", "10 seconds", ARRIVAL_ORDER, F.col("vc"))
    assert spans(rows.orderBy("position"), "position", "cnt", "element") == [(0, 10, 1, 3, 2), (0, 10, 2, 3, 1), (0, 10, 3, 3, 3), (10, 20, 1, 1, 4)]
    assert spans(windows.window_lists(rows, KEY), "cnt", "elements") == [(0, 10, 3, [2, 1, 3]), (10, 20, 1, [4])]


def test_windows_have_one_shape_whatever_their_size(readings):
    """Far above the ten thousand elements at which windows once came in another shape."""
    table = readings(*[("a", second % 10, second) for second in range(12_000)])
    rows = windows.window_process(table, KEY, "ts", "10 seconds", ARRIVAL_ORDER, F.col("vc")).collect()
    assert len(rows) == 12_000 and {row.cnt for row in rows} == {12_000}
    in_order = [row.element for row in sorted(rows, key=lambda row: row.position)]
    assert in_order == sorted(range(12_000), key=lambda vc: (vc % 10, vc))


def test_function_over_pages_of_a_window(readings):
    import pyarrow as pa

    table = readings(*[("a", second % 10, second) for second in range(23)], ("b", 1, 7))
    rows = windows.window_process(table, KEY, "ts", "10 seconds", ARRIVAL_ORDER, F.col("vc"))

    def total(key, page):
        return pa.table({"id": [key[0]], "page": [key[3]], "n": [page.num_rows], "s": [sum(page["element"].to_pylist())]})

    got = windows.window_pages(rows, KEY, total, "id string, page long, n long, s long", page_rows=10).collect()
    assert sorted((r.id, r.page, r.n) for r in got) == [("a", 0, 10), ("a", 1, 10), ("a", 2, 3), ("b", 0, 1)]
    assert sum(r.s for r in got) == sum(range(23)) + 7


def test_session_fixed_gap(readings, layout):
    table = readings(("a", 0, 1), ("a", 5, 1), ("a", 11, 1))
    sessions = windows.session_window(table, KEY, "ts", 5, ARRIVAL_ORDER, n=F.count("*"))
    assert spans(sessions, "n") == [(0, 10, 2), (11, 16, 1)]


def test_session_dynamic_gap(readings, layout):
    table = readings(("b", 0, 2), ("b", 1, 9), ("b", 5, 1))
    sessions = windows.session_window(table, KEY, "ts", F.col("vc"), ARRIVAL_ORDER, n=F.count("*"))
    assert spans(sessions, "n") == [(0, 10, 3)]


def test_sessions_equal_those_of_streams(readings, spark, layout):
    """Sessions of a table are what Spark's own session windows give."""
    draw = random.Random(3)
    table = readings(*[(draw.choice("ab"), draw.randrange(600), draw.randrange(1, 12)) for _ in range(120)])
    ours = windows.session_window(table, KEY, "ts", F.col("vc"), ARRIVAL_ORDER, n=F.count("*"), s=F.sum("vc"))
    span = F.session_window("ts", F.concat(F.col("vc").cast("string"), F.lit(" seconds")))
    theirs = table.groupBy("id", span.alias("w")).agg(F.count("*").alias("n"), F.sum("vc").alias("s"))
    theirs = theirs.select("id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "s")
    assert sorted(ours.collect()) == sorted(theirs.collect())


def test_count_windows(readings, layout):
    table = readings(*[("a", second, 1) for second in range(7)])
    tumbling = windows.count_window(table, KEY, ARRIVAL_ORDER, 3, n=hotsplit.count()).orderBy("firing").collect()
    assert [(row.firing, row.n) for row in tumbling] == [(3, 3), (6, 3)]
    sliding = windows.count_window(table, KEY, ARRIVAL_ORDER, 3, 1, n=hotsplit.count()).orderBy("firing").collect()
    assert [row.n for row in sliding][:4] == [1, 2, 3, 3]
    gaps = windows.count_window(table, KEY, ARRIVAL_ORDER, 1, 3, n=hotsplit.count(), t=hotsplit.lowest("seq")).orderBy("firing")
    assert [(row.firing, row.n, row.t) for row in gaps.collect()] == [(3, 1, 2), (6, 1, 5)]


STREAM = [("a", 1, 1), ("a", 9, 2), ("b", 4, 1), ("a", 13, 1), ("a", 5, 7), ("a", 14, 1), ("a", 2, 100), ("a", 30, 1)]


def statuses(table, allowed):
    rows = lateness.classify(table, "ts", "10 seconds", "3 seconds", allowed, ["seq"]).orderBy("seq").collect()
    return [row.status for row in rows]


def test_lateness(readings, layout):
    table = readings(*STREAM)
    on = lateness.ON_TIME
    allowed = lateness.ALLOWED
    assert statuses(table, "2 seconds") == [on, on, on, on, allowed, on, allowed, on]
    late = lateness.LATE
    assert statuses(table, "0 seconds") == [on, on, on, on, late, on, late, on]


def test_in_order_rows_are_never_late(readings, layout):
    table = readings(*sorted(STREAM, key=lambda row: row[1]))
    assert set(statuses(table, "0 seconds")) == {lateness.ON_TIME}


def test_panes(readings, layout):
    emitted = lateness.panes(readings(*STREAM), KEY, "ts", "10 seconds", "3 seconds", "2 seconds", ["seq"], "vc")
    first = emitted.filter("id = 'a' AND window_start = TIMESTAMP_NTZ '1970-01-01'").orderBy("pane").collect()
    assert [(row.pane, row.cnt, row.sum_vc) for row in first] == [(1, 2, 3), (2, 3, 10), (3, 4, 110)]


def test_sliding_windows_without_copies(readings):
    """Any pair of lengths, times before the epoch and without a window start, null keys, against plain sums."""
    pick = random.Random(6)
    made = [(pick.choice(["a", "b", None]), pick.randrange(-500, 500) * pick.choice([1, 7]), pick.randrange(-9, 9)) for _ in range(300)]
    table = readings(*made)
    for size, slide in ((60, 7), (10, 10), (12, 8), (1000, 10), (5, 60)):
        got = sliding.sliding_window(
            table, KEY, "ts", f"{size} seconds", f"{slide} seconds", n=hotsplit.count(), s=hotsplit.total("vc"),
            least=hotsplit.lowest("vc"), last=hotsplit.latest("vc", ["ts", "seq"]),
        )
        want = {}
        for seq, (key, at, vc) in sorted(enumerate(made), key=lambda e: (e[1][1], e[0])):
            for start in range(at - size + 1 + (-(at - size + 1)) % slide, at + 1, slide):
                want.setdefault((key, start), []).append(vc)
        rows = {(r.id, seconds(r.window_start)): (r.n, r.s, r.least, r.last) for r in got.collect()}
        assert rows == {k: (len(v), sum(v), min(v), v[-1]) for k, v in want.items()}
    zoned = table.withColumn("ts", F.col("ts").cast("timestamp"))
    same = sliding.sliding_window(zoned, KEY, "ts", "12 seconds", "8 seconds", n=hotsplit.count())
    plain = windows.time_window(zoned, KEY, "ts", "12 seconds", "8 seconds", n=F.count("*"))
    assert same.exceptAll(plain).isEmpty() and plain.exceptAll(same).isEmpty()


def test_windows_share_slices(readings):
    """Nothing is copied size / slide times: the plan has no expansion, and generates one row a window."""
    day = sliding.sliding_window(readings(("a", 0, 1)), KEY, "ts", "1 day", "15 minutes", n=hotsplit.count())
    assert "Expand" not in day._jdf.queryExecution().optimizedPlan().toString() and day.count() == 96


def test_long_count_windows_read_each_row_twice(readings, layout):
    pick = random.Random(3)
    made = [(pick.choice("aab"), i, pick.randrange(100)) for i in range(700)]
    for size, step in ((100, 1), (64, 7), (3, 2)):
        out = windows.count_window(readings(*made), KEY, ARRIVAL_ORDER, size, step, s=hotsplit.total("vc"), m=hotsplit.highest("vc"))
        want = {}
        for key in "ab":
            values = [vc for k, _, vc in made if k == key]
            want |= {(key, n): values[max(0, n - size) : n] for n in range(step, len(values) + 1, step)}
        assert {(r.id, r.firing): (r.s, r.m) for r in out.collect()} == {k: (sum(v), max(v)) for k, v in want.items()}


def test_top_n_breaks_ties_by_value(readings):
    table = readings(("a", 0, 3), ("b", 1, 3), ("a", 2, 2), ("a", 3, 1), ("a", 4, 1))
    rows = topn.window_top_n(table, "vc", "ts", "10 seconds", "10 seconds", 2).orderBy("rank").collect()
    assert [(row.vc, row.cnt) for row in rows] == [(1, 2), (3, 2)]


def test_timers_fire_once_and_not_past_the_watermark(readings):
    table = readings(("a", 1, 0), ("a", 1, 0), ("a", 6, 0), ("b", 20, 0))
    fired = timers.event_timers(table, KEY, "ts", "5 seconds", "3 seconds").orderBy("fires_at").collect()
    assert [(row.id, seconds(row.fires_at)) for row in fired] == [("a", 6), ("a", 11)]


def test_inactivity(readings, layout):
    table = readings(("a", 0, 0), ("a", 3, 0), ("a", 9, 0), ("a", 11, 0), ("b", 30, 0))
    alarms = timers.inactivity_alarm(table, KEY, "ts", ARRIVAL_ORDER, "5 seconds", "0 seconds").orderBy("fires_at")
    assert [(row.id, seconds(row.fires_at)) for row in alarms.collect()] == [("a", 8), ("a", 16)]


def test_processing_time_windows(readings):
    table = windows.processing_time(readings(("a", 0, 1), ("a", 1, 2)))
    sums = windows.time_window(table, KEY, "processed_at", "10 seconds", s=F.sum("vc"))
    assert sums.agg(F.sum("s")).first()[0] == 3


def test_event_time_from_seconds(spark):
    row = spark.range(1).select(windows.event_time(F.lit(5)).cast("timestamp_ntz").alias("t")).first()
    assert seconds(row.t) == 5
