import random
import time

import pytest
from pyspark.sql import functions as F

from keyflow.operators import joins, lateness, running, topn, transforms, windows
from keyflow.plans import hotsplit
from keyflow.schema import ARRIVAL_ORDER
from keyflow.session import scratch_dir
from keyflow.sinks import writers
from keyflow.sources import lines
from keyflow.streaming import carry, stateful
from keyflow.streaming.run import latest_update, read_batches, read_state, run_query, run_to_folder, start

DDL = "seq bigint, id bigint, ts timestamp_ntz, vc int"


@pytest.fixture
def disordered(spark):
    """Rows in arrival order, cut into files that arrive one per micro-batch."""
    draw = random.Random(11)
    rows = [(seq, draw.choice([1, 1, 1, 2, 3]), 20 * seq + draw.randrange(300), draw.randrange(40)) for seq in range(200)]
    table = spark.createDataFrame(rows, "seq bigint, id bigint, s bigint, vc int")
    table = table.select("seq", "id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "vc")
    return table.orderBy("seq")


class Feed:
    """A folder that tables are dropped into, read as a stream with one file per micro-batch."""

    def __init__(self, spark):
        self.spark = spark
        self.folder = scratch_dir(spark, "feed")
        self.path = f"{self.folder}/in"

    def drop(self, table, pieces=1, column="seq"):
        rows = table.orderBy(column).collect()
        size = -(-len(rows) // pieces)
        for begin in range(0, len(rows), size):
            part = self.spark.createDataFrame(rows[begin : begin + size], table.schema)
            part.coalesce(1).write.mode("append").parquet(self.path)
            time.sleep(0.01)  # files are taken in the order of their times
        return self

    def stream(self, schema):
        return lines.parquet_stream(self.spark, self.path, schema, files_per_trigger=1)


@pytest.fixture
def feed(spark):
    return Feed(spark)


def same(got, want):
    columns = sorted(want.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(
        map(tuple, want.select(*columns).collect()), key=str
    )


def batches(df):
    return df.select("batch").distinct().count()


def test_word_count_goes_on_after_restart(spark, feed):
    text = spark.createDataFrame([(n, f"w{n % 3} w{n % 5}") for n in range(20)], "seq int, value string")
    total = None
    for part in (text.filter("seq < 8"), text.filter("seq >= 8")):
        counts = running.word_count(transforms.words(feed.drop(part, 2).stream(text.schema)))
        total = run_to_folder(counts, feed.folder, "update", name="words")
    assert batches(total) == 4
    same(latest_update(total, ["word"]), running.word_count(transforms.words(text)))
    stored = read_state(spark, f"{feed.folder}/checkpoint").select("key.word", "value.count")
    assert {row.word: row["count"] for row in stored.collect()} == {
        row.word: row.cnt for row in latest_update(total, ["word"]).collect()
    }


def test_running_aggregates_continue_across_batches(disordered, feed, layout):
    stream = feed.drop(disordered, 4).stream(disordered.schema)
    scans = {
        "sum_vc": hotsplit.total("vc"),
        "top_vc": hotsplit.highest("vc"),
        "n_before": hotsplit.count().before(),
        "last": hotsplit.latest("vc", ["seq"]).before(),
        "first_vc": hotsplit.first("vc", ["seq"]),
    }
    run_query(stream, carry.running_by_key(feed.folder, ["id"], ["seq"], **scans), f"{feed.folder}/checkpoint")
    got = feed.spark.read.parquet(f"{feed.folder}/rows")
    assert batches(got) == 4
    same(got.drop("batch"), hotsplit.running(disordered, ["id"], ["seq"], **scans))


def test_processors_equal_tables(disordered, feed):
    ordered = disordered.withColumn("ts", F.timestamp_seconds("seq").cast("timestamp_ntz"))
    feed.drop(ordered, 3)

    def stream_of(processor, keys=("id",)):
        source = feed.stream(ordered.schema).withColumn("ts", F.col("ts").cast("timestamp"))
        source = source.withColumn("bucket", F.pmod("seq", F.lit(3)))
        out = stateful.keyed_process(source, list(keys), processor)
        out = run_to_folder(out, scratch_dir(feed.spark, "processor"))
        assert batches(out) == 3
        return out

    key = ["id"]
    got = stream_of(stateful.JumpAlarm()).select("seq", "curr", "last")
    same(got, running.jump_alarm(ordered, key, ARRIVAL_ORDER).select("seq", "curr", "last"))
    got = stream_of(stateful.TopLevels()).select("seq", "top")
    same(got, running.top_running(ordered, key, ARRIVAL_ORDER).select("seq", "top"))
    got = stream_of(stateful.LevelCounter()).select("seq", "vc", "cnt")
    same(got, running.level_counts_running(ordered, key, ARRIVAL_ORDER).select("seq", "vc", "cnt"))
    got = stream_of(stateful.RunningMean()).select("seq", "mean")
    same(got, running.running_mean(ordered, key, ARRIVAL_ORDER).select("seq", "mean"))
    got = stream_of(stateful.RunningReduce(max)).select("seq", F.col("value").cast("int").alias("running_vc"))
    same(got, running.running_max(ordered, key, ARRIVAL_ORDER, "vc").select("seq", "running_vc"))
    got = stream_of(stateful.TaskCounter(), ["bucket"]).select("seq", "cnt")
    same(got, running.bucket_counter(ordered, 3, F.col("seq"), ["seq"]).select("seq", "cnt"))


def test_processors_take_any_key_and_columns(feed):
    """The package's own readings: a text key, time in whole seconds, a second key column, another value."""
    rows = feed.spark.range(60).selectExpr("id AS n", "concat('s', id % 3) AS id", "id * 10 AS ts", "id % 2 AS part", "CAST(id * 7 % 23 AS INT) AS level")
    feed.drop(rows, 3, "n")
    columns = {"value": "level", "order": ["ts"], "keep": ["id", "part", "n"]}

    def stream_of(processor):
        out = stateful.keyed_process(feed.stream(rows.schema), ["id", "part"], processor)
        return run_to_folder(out, scratch_dir(feed.spark, "columns")).drop("batch")

    keys = ["id", "part"]
    got = stream_of(stateful.RunningMean(**columns))
    assert got.columns == ["id", "part", "n", "mean"]
    same(got.select("n", "mean"), running.running_mean(rows, keys, ["ts"], "level").select("n", "mean"))
    got = stream_of(stateful.JumpAlarm(5, **columns)).select("n", "curr", "last")
    same(got, running.jump_alarm(rows, keys, ["ts"], "level", 5).select("n", "curr", "last"))


def test_late_split_survives_a_failure(disordered, feed, monkeypatch):
    """A batch that fails between its outputs is repeated, and nothing is lost or doubled."""
    stream = feed.drop(disordered, 5).stream(disordered.schema)
    write = carry.late_split(feed.folder, "ts", "1 minute", "30 seconds", "20 seconds", ["seq"])
    original, failed = writers.batch_folders, []

    def failing(path):
        def attempt(batch, batch_id):
            if batch_id == 2 and path.endswith("/late") and not failed:
                failed.append(batch_id)
                raise RuntimeError("lost")
            original(path)(batch, batch_id)

        return attempt

    monkeypatch.setattr(carry, "batch_folders", failing)
    with pytest.raises(Exception, match="lost"):
        run_query(stream, write, f"{feed.folder}/checkpoint")
    run_query(stream, write, f"{feed.folder}/checkpoint")
    assert failed == [2]
    want = lateness.classify(disordered, "ts", "1 minute", "30 seconds", "20 seconds", ["seq"])
    accepted, late = lateness.split_late(want)
    for name, part in (("accepted", accepted), ("late", late)):
        same(feed.spark.read.parquet(f"{feed.folder}/{name}").select("seq", "status"), part.select("seq", "status"))
    assert late.count() > 10


def test_threshold_is_carried(disordered, feed):
    stream = feed.drop(disordered, 4).stream(disordered.schema)
    config = F.col("id") == 3
    write = carry.threshold_alerts(feed.folder, config, "vc", ["seq"])
    run_query(stream, write, f"{feed.folder}/checkpoint")
    got = feed.spark.read.parquet(f"{feed.folder}/alerts").select("seq", "threshold")
    same(got, joins.broadcast_threshold(disordered, config, "vc", ["seq"]).select("seq", "threshold"))


def test_late_records_of_two_inputs(disordered, feed):
    merged = disordered.withColumn("side", F.when(F.col("id") == 1, "left").otherwise("right"))
    write = carry.late_split_of_sides(feed.folder, "ts", "20 seconds", ["seq"])
    run_query(feed.drop(merged, 4).stream(merged.schema), write, f"{feed.folder}/checkpoint")
    want = lateness.classify_sides(merged, "ts", "20 seconds", ["seq"])
    for name, part in (("accepted", want.filter("NOT is_late")), ("late", want.filter("is_late"))):
        assert part.count() > 10
        same(feed.spark.read.parquet(f"{feed.folder}/{name}").select("seq"), part.select("seq"))


def timed(stream, delay="5 minutes", column="ts"):
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def closed(table, windows_of_table, delay):
    newest = table.agg(F.max("ts") - F.expr(f"INTERVAL {delay}")).first()[0]
    return windows_of_table.filter(F.col("window_end") <= F.lit(newest))


def test_windows_equal_tables(disordered, feed):
    """No row is later than the watermark waits, so every closed window is complete."""
    feed.drop(disordered, 4)

    def stream():
        return timed(feed.stream(disordered.schema))

    def written(df):
        out = run_to_folder(df, scratch_dir(feed.spark, "windows")).drop("batch")
        return out.withColumns({name: F.col(name).cast("timestamp_ntz") for name in windows.BOUNDS})

    sums = {"n": F.count("*"), "s": F.sum("vc")}
    for slide in (None, "30 seconds"):
        want = windows.time_window(disordered, ["id"], "ts", "1 minute", slide, **sums)
        got = written(windows.time_window(stream(), ["id"], "ts", "1 minute", slide, **sums))
        same(got, closed(disordered, want, "5 minutes"))
    for gap in (40, 30 + F.col("vc")):
        want = windows.session_window(disordered, ["id"], "ts", gap, ARRIVAL_ORDER, **sums)
        got = written(windows.session_window(stream(), ["id"], "ts", gap, ARRIVAL_ORDER, **sums))
        same(got, closed(disordered, want, "5 minutes"))

    counts = windows.time_window(stream(), ["vc"], "ts", "1 minute", cnt=F.count("*"))
    folder = scratch_dir(feed.spark, "top")
    rank = writers.fan_out({f"{folder}/out": lambda batch: topn.rank_counts(batch, "vc", 2)})
    run_query(counts, rank, f"{folder}/checkpoint")
    got = read_batches(feed.spark, f"{folder}/out", counts.withColumn("rank", F.lit(0)).schema).drop("batch")
    got = got.withColumns({name: F.col(name).cast("timestamp_ntz") for name in windows.BOUNDS})
    want = topn.window_top_n(disordered, "vc", "ts", "1 minute", "1 minute", 2)
    same(got, closed(disordered, want, "5 minutes"))


def test_joins_equal_tables(disordered, feed):
    feed.drop(disordered, 3)

    def side(df, keep, name):
        return df.filter(keep).select("id", *[F.col(c).alias(f"{name}_{c}") for c in ("seq", "ts")])

    halves = [("seq % 2 = 0", "left"), ("seq % 2 = 1", "right")]
    tables = [side(disordered, *half) for half in halves]
    streams = [timed(side(feed.stream(disordered.schema), *half), "5 minutes", f"{half[1]}_ts") for half in halves]
    pair = ["id", "left_seq", "right_seq"]
    ids = (["left_seq"], ["right_seq"])

    got = joins.interval_join_stream(*streams, ["id"], "left_ts", "right_ts", -30, 60, ["left_seq"], salts=3)
    got = run_to_folder(got, scratch_dir(feed.spark, "j"))
    same(got.select(*pair), joins.interval_join(*tables, ["id"], "left_ts", "right_ts", -30, 60, *ids).select(*pair))
    got = joins.window_join(*streams, ["id"], "left_ts", "right_ts", "1 minute", *ids, salts=2).select(*pair)
    want = joins.window_join(*tables, ["id"], "left_ts", "right_ts", "1 minute", *ids).select(*pair)
    same(run_to_folder(got, scratch_dir(feed.spark, "j")).drop("batch"), want)
    plain = [side(feed.stream(disordered.schema), *half) for half in halves]
    got = run_to_folder(joins.keyed_connect(*plain, ["id"], *ids).select(*pair), scratch_dir(feed.spark, "j"))
    same(got.drop("batch"), joins.keyed_connect(*tables, ["id"], *ids).select(*pair))
    union = joins.union_all(*[feed.stream(disordered.schema) for _ in range(2)]).select("seq")
    assert run_to_folder(union, scratch_dir(feed.spark, "u")).count() == 2 * disordered.count()


@pytest.mark.parametrize("policy, expected", [("min", 0), ("max", 5)])
def test_idle_input(spark, policy, expected):
    """One input has stopped: the smaller watermark stands still, the larger one goes on."""
    busy, idle = Feed(spark), Feed(spark)
    rows = spark.range(7).select("id", F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    busy.drop(rows, 7, "id")
    idle.drop(rows.limit(1), 1, "id")
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)
    try:
        both = [feed.stream(rows.schema).withWatermark("ts", "0 seconds") for feed in (busy, idle)]
        counts = windows.time_window(joins.union_all(*both), [], "ts", "1 minute", n=F.count("*"))
        closed_windows = run_to_folder(counts, busy.folder).count()
    finally:
        spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")
    assert closed_windows >= expected if expected else closed_windows == 0


def test_event_timers_and_silence(spark, feed):
    rows = spark.createDataFrame([(0, 1, 10), (1, 1, 13), (2, 1, 13), (3, 1, 19), (4, 2, 40)], "seq int, id bigint, s bigint")
    rows = rows.withColumn("ts", F.timestamp_seconds("s"))
    feed.drop(rows, 5)

    def fired(processor):
        source = stateful.with_millis(feed.stream(rows.schema).withWatermark("ts", "0 seconds"))
        out = stateful.keyed_process(source, ["id"], processor, time_mode="EventTime")
        out = run_to_folder(out, scratch_dir(spark, "timers"))
        return sorted((row.id, row.s) for row in out.select("id", F.unix_seconds("fires_at").alias("s")).collect())

    assert fired(stateful.EventTimers(5000)) == [(1, 15), (1, 18), (1, 24)]
    assert fired(stateful.SilenceAlarm(5000)) == [(1, 18), (1, 24)]


def test_processing_time_timers(spark, feed):
    rows = spark.createDataFrame([(0, 7)], "seq int, id bigint")
    source = feed.drop(rows).stream(rows.schema)
    out = stateful.keyed_process(source, ["id"], stateful.ProcessingTimers(200), time_mode="ProcessingTime")
    writer = out.writeStream.outputMode("append").foreachBatch(writers.batch_folders(f"{feed.folder}/out"))
    running_query = start(writer, f"{feed.folder}/checkpoint", every="200 milliseconds")
    try:
        deadline = time.time() + 60
        found = []
        while not found and time.time() < deadline:
            time.sleep(0.5)
            if running_query.lastProgress:
                found = read_batches(spark, f"{feed.folder}/out", out.schema).collect()
    finally:
        running_query.stop()
    assert [row.id for row in found] == [7]


def test_fan_out_writes_every_row_once(disordered, feed):
    folder = feed.folder
    write = writers.fan_out(
        {f"{folder}/low": lambda batch: batch.filter("vc <= 10"), f"{folder}/high": lambda batch: batch.filter("vc > 10")}
    )
    run_query(feed.drop(disordered, 2).stream(disordered.schema), write, f"{folder}/checkpoint")
    parts = [feed.spark.read.parquet(f"{folder}/{name}").drop("batch") for name in ("low", "high")]
    same(joins.union_all(*parts), disordered)


def test_bucketed_files(disordered, feed):
    source = feed.drop(disordered, 2).stream(disordered.schema)
    pattern = "yyyy-MM-dd HH"
    writer = writers.bucketed_text_stream(source, f"{feed.folder}/out", "ts", F.concat_ws(",", "id", "vc"), rows_per_file=20)
    start(writer, f"{feed.folder}/checkpoint").awaitTermination()
    writers.write_bucketed_text(disordered, f"{feed.folder}/table", "ts", F.concat_ws(",", "id", "vc"))
    want = disordered.select(F.date_format("ts", pattern).alias("bucket"), F.concat_ws(",", "id", "vc").alias("value"))
    for name in ("out", "table"):
        written = feed.spark.read.schema("value string, bucket string").text(f"{feed.folder}/{name}")
        same(written.select("bucket", "value"), want)


def test_text_stream_and_console(spark, tmp_path):
    (tmp_path / "a.txt").write_text("s1,1,5\n")
    stream = lines.parse(lines.text_stream(spark, str(tmp_path), files_per_trigger=1))
    out = run_to_folder(stream, scratch_dir(spark, "text"))
    assert [tuple(row) for row in out.drop("batch").collect()] == [("s1", 1, 5)]
    query = start(writers.console(stream, "main"), scratch_dir(spark, "console"))
    query.awaitTermination()
    assert query.exception() is None


def test_retries():
    calls = []

    def write(batch, batch_id):
        calls.append(batch_id)
        if len(calls) < 3:
            raise OSError("down")

    writers.with_retries(write, retries=3, pause_seconds=0)(None, 4)
    assert calls == [4, 4, 4]
    with pytest.raises(OSError):
        writers.with_retries(lambda *_: (_ for _ in ()).throw(OSError()), retries=1, pause_seconds=0)(None, 0)


def test_connector_options(spark, monkeypatch):
    monkeypatch.setenv("KEYFLOW_JDBC_USER", "someone")
    monkeypatch.delenv("KEYFLOW_JDBC_PASSWORD", raising=False)
    options = writers.jdbc_options("jdbc:x://host/db", "ws", driver="d.Driver")
    assert options == {"url": "jdbc:x://host/db", "dbtable": "ws", "batchsize": "100", "driver": "d.Driver", "user": "someone"}
    assert lines.kafka_options("h:1", "first", "g", "earliest") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "first", "startingOffsets": "earliest", "kafka.group.id": "g"
    }
    assert writers.kafka_options("h:1", "first") == {"kafka.bootstrap.servers": "h:1", "topic": "first"}
    assert writers.kafka_rows(spark.range(1), F.col("id")).dtypes == [("value", "string")]
