"""Streaming twins: the tables are read as streams, worked off, and the written result read back."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.catalog import query
from keyflow.catalog.keyed import LEVEL_COUNTS_SQL, TOP3_SQL
from keyflow.catalog.several import (
    LATE_OF_SIDES_SQL,
    ON_TIME_PAIRS_SQL,
    PAIR,
    THRESHOLD_SQL,
    clicks_and_purchases,
    interval_sql,
    side,
)
from keyflow.catalog.sql import ARRIVALS, READINGS, WORDS, bucket
from keyflow.catalog.windowed import LATE_CLASSIFY_SQL, LATE_PANES_SQL, SLIDING_SQL, SUMS
from keyflow.operators import changelog, joins, running, topn, transforms, windows
from keyflow.plans import hotsplit
from keyflow.schema import ARRIVAL_ORDER, DOCUMENT, EVENT, as_readings, readings, table, text_lines, with_arrival
from keyflow.session import scratch_dir
from keyflow.sinks.writers import BatchWriter, bucketed_text_stream
from keyflow.sources.lines import parquet_stream
from keyflow.streaming import carry, heavy, revisions
from keyflow.streaming.run import latest_update, read_batches, run_query, run_to_folder, start
from keyflow.streaming.slices import run_in_slices

HOUR = 3600

def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as a stream, in no order. The glob takes one file as well as a folder of files."""
    return as_readings(parquet_stream(spark, f"{sf_dir}/[e]vents.parquet", EVENT))


def timed(df: DataFrame, delay: str) -> DataFrame:
    """With event time and watermark; watermarks need a time with a zone."""
    return df.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)


def _local(df: DataFrame, *names: str) -> DataFrame:
    """Times as they are in the tables, without a zone."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


@query(f"WITH {WORDS} SELECT word, count(*) AS cnt FROM w GROUP BY word")
def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = parquet_stream(spark, f"{sf_dir}/[d]ocuments.parquet", DOCUMENT)
    counts = running.word_count(transforms.words(text_lines(documents)))
    return latest_update(run_to_folder(counts, scratch_dir(spark, "words"), "update"), ["word"])


@query(f"WITH {WORDS} SELECT word, count(*) AS cnt FROM w GROUP BY word")
def restart_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts the English documents, stops, and goes on from the checkpoint when the others arrive."""
    folder = scratch_dir(spark, "restart")
    documents = table(spark, sf_dir, "documents")
    english = F.col("lang").eqNullSafe("en")
    for arrived in (documents.filter(english), documents.filter(~english)):
        arrived.write.mode("append").parquet(f"{folder}/in")
        stream = parquet_stream(spark, f"{folder}/in", DOCUMENT)
        counts = running.word_count(transforms.words(text_lines(stream)))
        batches = run_to_folder(counts, folder, "update", name=f"restart-{folder[-12:]}")
    return latest_update(batches, ["word"])


def _in_order(df: DataFrame, order: list[str], folder: str, write: BatchWriter) -> None:
    """Hands a table to a stream slice by slice of its order."""
    run_in_slices(df, order, folder, lambda stream: run_query(stream, write, f"{folder}/checkpoint"))


def _sliced(spark: SparkSession, sf_dir: str, label: str, op: Callable[[DataFrame], DataFrame], mode: str = "append") -> DataFrame:
    """What a streaming operator writes for the readings, batch by batch."""
    folder = scratch_dir(spark, label)
    events = table(spark, sf_dir, "events").select(*EVENT.names)
    run_in_slices(events, ["ts"], folder, lambda stream: run_to_folder(op(as_readings(stream)), folder, mode))
    schema = op(as_readings(spark.readStream.schema(EVENT).parquet(f"{folder}/in"))).schema
    return read_batches(spark, f"{folder}/out", schema)


def _by_key(spark: SparkSession, sf_dir: str, label: str, keys=("id",), finish=lambda rows: rows, columns=None, **scans) -> DataFrame:
    """Running values per key over the readings as a stream."""
    folder = scratch_dir(spark, label)
    rows = readings(spark, sf_dir).select("seq", "id", "ts", running.level_or_zero().alias("vc")).withColumns(columns or {})
    _in_order(rows, ARRIVAL_ORDER, folder, carry.running_by_key(folder, list(keys), ARRIVAL_ORDER, finish, **scans))
    return spark.read.parquet(f"{folder}/rows")


def _so_far(expression: str, name: str) -> str:
    return f"""WITH {READINGS}
    SELECT seq, id, CAST({expression} OVER (PARTITION BY id ORDER BY ts, seq) AS BIGINT) AS {name} FROM r"""


@query(_so_far("sum(vc)", "sum_vc"))
def stream_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One output row per record, micro-batches continuing one another."""
    return _by_key(spark, sf_dir, "running", sum_vc=hotsplit.total("vc")).select("seq", "id", "sum_vc")


@query(
    f"""WITH {READINGS}, h AS (SELECT *, {bucket("ts")} AS window_start FROM r)
    SELECT id, window_start, window_start + INTERVAL 1 HOUR AS window_end, {SUMS} FROM h GROUP BY id, window_start"""
)
def stream_window_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that fire again with each late row allowed: the watermark waits for delay plus lateness,
    and every change is emitted. Read back is the newest firing of each window."""

    def sums(stream: DataFrame) -> DataFrame:
        return windows.time_window(timed(stream, "90 minutes"), ["id"], "ts", "1 hour", cnt=F.count("*"), sum_vc=F.sum("vc"))

    batches = _sliced(spark, sf_dir, "updates", sums, "update")
    return _local(latest_update(batches, ["id", *windows.BOUNDS]), *windows.BOUNDS)


CLOSED = "window_end <= (SELECT max(ts) FROM r) - INTERVAL 1 HOUR"


@query(
    f"""WITH {READINGS}, h AS (SELECT *, {bucket("ts")} AS window_start FROM r),
    g AS (SELECT id, window_start, window_start + INTERVAL 1 HOUR AS window_end, {SUMS} FROM h GROUP BY id, window_start)
    SELECT * FROM g WHERE {CLOSED}"""
)
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows the watermark has closed."""

    def sums(stream: DataFrame) -> DataFrame:
        return windows.time_window(timed(stream, "1 hour"), ["id"], "ts", "1 hour", cnt=F.count("*"), sum_vc=F.sum("vc"))

    return _local(_sliced(spark, sf_dir, "tumbling", sums).drop("batch"), *windows.BOUNDS)


@query(
    f"""WITH {READINGS},
    f AS (SELECT *, coalesce(CAST(ts - lag(ts) OVER w > INTERVAL 8 HOUR AS INTEGER), 1) AS opens
          FROM r WINDOW w AS (PARTITION BY id ORDER BY ts, seq)),
    s AS (SELECT *, sum(opens) OVER (PARTITION BY id ORDER BY ts, seq) AS session FROM f),
    g AS (SELECT id, min(ts) AS window_start, max(ts) + INTERVAL 8 HOUR AS window_end, {SUMS}
          FROM s GROUP BY id, session)
    SELECT * FROM g WHERE {CLOSED}"""
)
def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    def sessions(stream: DataFrame) -> DataFrame:
        sums = {"cnt": F.count("*"), "sum_vc": F.sum("vc")}
        return windows.session_window(timed(stream, "1 hour"), ["id"], "ts", 8 * HOUR, ARRIVAL_ORDER, **sums)

    return _local(_sliced(spark, sf_dir, "session", sessions).drop("batch"), *windows.BOUNDS)


@query(
    f"""WITH {READINGS}, {SLIDING_SQL},
    k AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, vc) AS rank FROM c WHERE {CLOSED})
    SELECT window_start, window_end, vc, cnt, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 2"""
)
def stream_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts close window by window; each micro-batch of closed windows is ranked when written."""
    folder = scratch_dir(spark, "topn")
    events = table(spark, sf_dir, "events").select(*EVENT.names)

    def counts(stream: DataFrame) -> DataFrame:
        timed_rows = timed(as_readings(stream), "1 hour")
        return windows.time_window(timed_rows, ["vc"], "ts", "1 hour", "30 minutes", cnt=F.count("*"))

    def write(batch: DataFrame, batch_id: int) -> None:
        topn.rank_counts(batch, "vc", 2).write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    run_in_slices(events, ["ts"], folder, lambda stream: run_query(counts(stream), write, f"{folder}/checkpoint"))
    schema = counts(spark.readStream.schema(EVENT).parquet(f"{folder}/in")).withColumn("rank", F.lit(0)).schema
    return _local(read_batches(spark, f"{folder}/out", schema).drop("batch"), *windows.BOUNDS)


@query(interval_sql("click", "purchase", "-2 hours", "2 hours"))
def stream_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    def pairs(stream: DataFrame) -> DataFrame:
        sides = [
            side(stream, kind, name)
            .withColumn(f"{name}_ts", F.col(f"{name}_ts").cast("timestamp"))
            .withWatermark(f"{name}_ts", "1 hour")
            for kind, name in (("click", "left"), ("purchase", "right"))
        ]
        span = (-2 * HOUR, 2 * HOUR)
        return joins.interval_join_stream(*sides, ["id"], "left_ts", "right_ts", *span, ["left_seq"], salts=4)

    out = _sliced(spark, sf_dir, "interval", pairs)
    return _local(out, "left_ts", "right_ts").select(*PAIR)


@query(
    f"""WITH {READINGS}
    SELECT seq, id, vc AS curr, last FROM (
        SELECT *, lag(vc, 1, 0) OVER (PARTITION BY id ORDER BY ts, seq) AS last FROM r)
    WHERE abs(vc - last) > 10"""
)
def stream_jump_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    def jumps(rows: DataFrame) -> DataFrame:
        seen = rows.select("seq", "id", F.col("vc").alias("curr"), F.coalesce("last", F.lit(0)).alias("last"))
        return seen.filter(F.abs(F.col("curr") - F.col("last")) > 10)

    last = hotsplit.latest("vc", ARRIVAL_ORDER).before()
    return _by_key(spark, sf_dir, "jumps", finish=jumps, last=last).select("seq", "id", "curr", "last")


@query(TOP3_SQL)
def stream_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "top")
    rows = readings(spark, sf_dir).select("seq", "id", "ts", "vc")
    _in_order(rows, ARRIVAL_ORDER, folder, carry.top_by_key(folder, ["id"], ARRIVAL_ORDER))
    out = spark.read.parquet(f"{folder}/rows")
    return out.select("seq", "id", F.array_join(F.col("top").cast("array<string>"), ",").alias("top"))


@query(LEVEL_COUNTS_SQL)
def stream_level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_key(spark, sf_dir, "levels", ("id", "vc"), cnt=hotsplit.count()).select("seq", "id", "vc", "cnt")


@query(
    f"""WITH {READINGS}
    SELECT seq, id, avg(vc) OVER (PARTITION BY id ORDER BY ts, seq) AS mean FROM r"""
)
def stream_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    def mean(rows: DataFrame) -> DataFrame:
        return rows.select("seq", "id", (F.col("total") / F.col("n")).alias("mean"))

    return _by_key(spark, sf_dir, "mean", finish=mean, total=hotsplit.total("vc"), n=hotsplit.count()).drop("batch")


@query(
    f"""WITH {READINGS}
    SELECT seq, seq % 4 AS bucket, row_number() OVER (PARTITION BY seq % 4 ORDER BY ts, seq) AS cnt FROM r"""
)
def stream_bucket_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = {"bucket": F.pmod("seq", F.lit(4))}
    out = _by_key(spark, sf_dir, "buckets", ("bucket",), columns=buckets, cnt=hotsplit.count())
    return out.select("seq", "bucket", "cnt")


def _in_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).select("seq", "id", "ts")
    return rows.withColumn("ts", F.date_trunc("millisecond", F.col("ts").cast("timestamp")).cast("timestamp_ntz"))


@query(
    f"""WITH {READINGS}
    SELECT DISTINCT id, date_trunc('millisecond', ts) + INTERVAL 1 HOUR AS fires_at FROM r
    WHERE date_trunc('millisecond', ts) + INTERVAL 1 HOUR
        <= (SELECT date_trunc('millisecond', max(ts)) FROM r) - INTERVAL 1 HOUR"""
)
def stream_event_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timers the watermark has reached; timers count in milliseconds."""
    folder = scratch_dir(spark, "timers")
    _in_order(_in_millis(spark, sf_dir), ARRIVAL_ORDER, folder, carry.event_timers(folder, ["id"], "ts", "1 HOUR", "1 HOUR"))
    return spark.read.parquet(f"{folder}/fired").select("id", "fires_at")


@query(
    f"""WITH {READINGS},
    m AS (SELECT id, seq, date_trunc('millisecond', ts) AS ts FROM r),
    n AS (SELECT id, ts, lead(ts) OVER (PARTITION BY id ORDER BY ts, seq) AS next FROM m)
    SELECT id, ts + INTERVAL 12 HOUR AS fires_at FROM n
    WHERE next > ts + INTERVAL 12 HOUR
       OR (next IS NULL AND ts + INTERVAL 12 HOUR <= (SELECT max(ts) FROM m) - INTERVAL 1 HOUR)"""
)
def stream_inactivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "silence")
    write = carry.silence_alarms(folder, ["id"], "ts", ARRIVAL_ORDER, "12 HOUR", "1 HOUR")
    _in_order(_in_millis(spark, sf_dir), ARRIVAL_ORDER, folder, write)
    return spark.read.parquet(f"{folder}/fired").select("id", "fires_at")


@query(
    f"""WITH {READINGS}
    SELECT l.id, l.seq AS left_seq, p.seq AS right_seq, {bucket("l.ts", 5)} AS window_start,
           {bucket("l.ts", 5)} + INTERVAL 5 HOUR AS window_end
    FROM r l JOIN r p ON l.id = p.id AND {bucket("l.ts", 5)} = {bucket("p.ts", 5)}
    WHERE l.event_type = 'click' AND p.event_type = 'purchase'"""
)
def stream_window_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of the same window, found as they arrive; keys that turn out to be heavy are spread over tasks."""
    folder = scratch_dir(spark, "window-join")
    kinds = {"left": "click", "right": "purchase"}

    def merged(stream: DataFrame) -> DataFrame:
        named = F.when(F.col("event_type") == kinds["left"], "left").when(F.col("event_type") == kinds["right"], "right")
        rows = as_readings(stream).select("id", "seq", F.col("ts").cast("timestamp").alias("ts"), named.alias("side"))
        return rows.where("side IS NOT NULL")

    def pairs(placed: DataFrame) -> DataFrame:
        sides = [
            placed.where(F.col("side") == name)
            .select("id", *heavy.SLICES, *[F.col(column).alias(f"{name}_{column}") for column in ("seq", "ts")])
            .withWatermark(f"{name}_ts", "1 hour")
            for name in kinds
        ]
        ids = (["left_seq"], ["right_seq"])
        joined = joins.window_join(*heavy.on_grid(*sides, *ids), ["id", *heavy.GRID], "left_ts", "right_ts", "5 hours", *ids)
        return joined.select("id", "left_seq", "right_seq", *windows.BOUNDS)

    place = heavy.place(folder, ["id"], F.window("ts", "5 hours").start)

    def run(stream: DataFrame) -> None:
        run_query(merged(stream), place, f"{folder}/placing")
        run_to_folder(pairs(heavy.placed_stream(spark, folder)), folder)

    run_in_slices(table(spark, sf_dir, "events").select(*EVENT.names), ["ts"], folder, run)
    schema = pairs(heavy.placed_stream(spark, folder)).schema
    return _local(read_batches(spark, f"{folder}/out", schema).drop("batch"), *windows.BOUNDS)


@query(
    f"""WITH {READINGS}
    SELECT l.id, l.seq AS left_seq, p.seq AS right_seq FROM r l JOIN r p ON l.id = p.id
    WHERE l.event_type = 'purchase' AND p.event_type = 'signup'"""
)
def stream_keyed_connect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of two streams with the same key, each once, however far apart they come."""

    def pairs(stream: DataFrame) -> DataFrame:
        sides = [side(stream, kind, name) for kind, name in (("purchase", "left"), ("signup", "right"))]
        joined = joins.keyed_connect(*sides, ["id"], ["left_seq"], ["right_seq"], salts=4)
        return joined.select("id", "left_seq", "right_seq")

    return _sliced(spark, sf_dir, "connect", pairs).drop("batch")


@query(LATE_CLASSIFY_SQL)
def stream_late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and late rows, read back from their two outputs."""
    folder = scratch_dir(spark, "late")
    rows = with_arrival(readings(spark, sf_dir).select("seq", "id", "ts", "vc"))
    write = carry.late_split(folder, "ts", "1 hour", "1 hour", "30 minutes", ["arrival", "seq"])
    _in_order(rows, ["arrival", "seq"], folder, write)
    parts = [spark.read.parquet(f"{folder}/{name}") for name in ("accepted", "late")]
    return joins.union_all(*parts).select("seq", "id", "ts", "window_end", "status")


@query(LATE_PANES_SQL)
def stream_late_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that fire when the watermark passes them, and again with each row allowed later.

    The stream ends here, so the windows still open fire at last.
    """
    folder, arrived = scratch_dir(spark, "panes"), ["arrival", "seq"]
    _in_order(_arrived(spark, sf_dir), arrived, folder, carry.late_panes(folder, ["id"], "ts", "1 hour", "1 hour", "30 minutes", arrived, "vc"))
    fired = spark.read.parquet(f"{folder}/panes")
    last = spark.read.parquet(f"{folder}/newest").agg(F.max("batch")).first()[0]
    ended = carry.unfired_panes(spark, folder, last, ["id"], "vc")
    return fired.drop("batch").unionByName(ended)


def _arrived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_arrival(readings(spark, sf_dir).select("seq", "id", "ts", "vc"))


def _revised_sessions(spark: SparkSession, sf_dir: str, allowed: str) -> DataFrame:
    folder, order = scratch_dir(spark, "sessions"), ["arrival", "seq"]
    gap = (1 + F.col("vc") % 12) * HOUR
    sums = {"cnt": hotsplit.count(), "sum_vc": hotsplit.total("vc")}
    write = revisions.session_changes(folder, ["id"], "ts", gap, "12 hours", "1 hour", allowed, order, **sums)
    _in_order(_arrived(spark, sf_dir), order, folder, write)
    fired = changelog.folded(spark.read.parquet(f"{folder}/changes").drop("batch"))
    return fired.unionByName(revisions.unfired_sessions(spark, folder, ["id"], **sums))


def _sessions_of(rows: str) -> str:
    return f"""
    f AS (SELECT *, coalesce(CAST(ts > max(until) OVER (PARTITION BY id ORDER BY ts, seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS INTEGER), 1) AS opens FROM {rows}),
    s AS (SELECT *, sum(opens) OVER (PARTITION BY id ORDER BY ts, seq) AS session FROM f)
    SELECT id, min(ts) AS window_start, max(until) AS window_end, {SUMS} FROM s GROUP BY id, session"""


@query(f"WITH {READINGS}, g AS (SELECT *, ts + to_hours(1 + vc % 12) AS until FROM r), {_sessions_of('g')}")
def stream_session_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of readings that arrive in disorder, all within the time allowed: the same as those of the table."""
    return _revised_sessions(spark, sf_dir, "5 hours")


@query(
    f"""WITH {ARRIVALS},
    m AS (SELECT *, ts + to_hours(1 + vc % 12) AS until, max(ts) OVER (ORDER BY arrival, seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 HOUR AS watermark FROM a),
    g AS (SELECT * FROM m WHERE (until + INTERVAL 30 MINUTE <= watermark) IS NOT TRUE), {_sessions_of("g")}"""
)
def stream_session_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that late readings still change for half an hour, and that miss those which come after that."""
    return _revised_sessions(spark, sf_dir, "30 minutes")


HALF_HOUR = "make_timestamp(epoch_us(ts) // 1800000000 * 1800000000)"


@query(
    f"""WITH {ARRIVALS},
    m AS (SELECT *, max(ts) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
              - INTERVAL 1 HOUR AS watermark FROM a),
    p AS (SELECT *, {HALF_HOUR} + to_minutes(unnest([30, 60])) AS window_end FROM m),
    c AS (SELECT window_end, vc, count(*) AS cnt FROM p
          WHERE (window_end + INTERVAL 2 HOUR <= watermark) IS NOT TRUE GROUP BY window_end, vc),
    k AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, vc) AS rank FROM c
          WHERE window_end <= (SELECT max(ts) FROM a) - INTERVAL 1 HOUR)
    SELECT window_end - INTERVAL 1 HOUR AS window_start, window_end, vc, cnt, CAST(rank AS INTEGER) AS rank
    FROM k WHERE rank <= 2"""
)
def stream_top_n_revised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks that late readings change for two hours: withdrawn, emitted anew, and folded here."""
    folder, order = scratch_dir(spark, "ranks"), ["arrival", "seq"]
    write = revisions.top_changes(folder, "vc", "ts", "1 hour", "30 minutes", 2, "1 hour", "2 hours", order)
    _in_order(_arrived(spark, sf_dir), order, folder, write)
    return changelog.folded(spark.read.parquet(f"{folder}/changes").drop("batch"))


def _split_sides(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch_dir(spark, "sides")
    write = carry.late_split_of_sides(folder, "ts", "1 hour", ["arrival", "seq"])
    _in_order(clicks_and_purchases(readings(spark, sf_dir)), ["arrival", "seq"], folder, write)
    return folder


@query(LATE_OF_SIDES_SQL)
def stream_join_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late records of both inputs of a join."""
    late = spark.read.parquet(f"{_split_sides(spark, sf_dir)}/late")
    return late.select("side", "seq", "id", "ts", "vc")


@query(ON_TIME_PAIRS_SQL)
def stream_join_on_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join of the records that came in time."""
    accepted = spark.read.parquet(f"{_split_sides(spark, sf_dir)}/accepted").withColumnRenamed("side", "event_type")
    sides = side(accepted, "left", "left"), side(accepted, "right", "right")
    joined = joins.interval_join(
        *sides, ["id"], "left_ts", "right_ts", -2 * HOUR, 2 * HOUR, ["left_seq"], ["right_seq"]
    )
    return joined.select(*PAIR)


@query(THRESHOLD_SQL)
def stream_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "threshold")
    write = carry.threshold_alerts(folder, F.col("event_type") == "signup", "vc", ARRIVAL_ORDER)
    _in_order(readings(spark, sf_dir), ARRIVAL_ORDER, folder, write)
    return spark.read.parquet(f"{folder}/alerts").select("seq", "id", "ts", "vc", "threshold")


@query("SELECT strftime(ts, '%Y-%m-%d %H') AS bucket, count(*) AS cnt FROM events GROUP BY 1")
def file_sink_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written to one folder per hour, and how many are read back from each."""
    folder = scratch_dir(spark, "buckets")
    stream = events_stream(spark, sf_dir)
    writer = bucketed_text_stream(stream, f"{folder}/out", "ts", F.concat_ws(",", "id", "ts", "vc"))
    start(writer, f"{folder}/checkpoint").awaitTermination()
    lines = spark.read.schema("value string, bucket string").text(f"{folder}/out")
    return lines.groupBy("bucket").agg(F.count("*").alias("cnt"))
