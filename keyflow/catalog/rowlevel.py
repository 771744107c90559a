"""Sources, row-level operators, splitting and placement."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.catalog import query
from keyflow.catalog.sql import READINGS, WORDS
from keyflow.functions.text import format_millis, message
from keyflow.operators import distribute, joins, running, split, transforms, windows
from keyflow.schema import lines, readings, table
from keyflow.session import scratch_dir
from keyflow.sources.lines import generate, parse, parse_or_reject, text_file


@query(f"WITH {WORDS} SELECT word, count(*) AS cnt FROM w GROUP BY word")
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.word_count(transforms.words(lines(spark, sf_dir)))


@query(f"WITH {WORDS} SELECT doc_id, pos, word FROM w")
def tokenize_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.numbered_words(lines(spark, sf_dir))


def _reading_lines(df: DataFrame, level: F.Column) -> DataFrame:
    seconds = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    return df.select("seq", F.concat_ws(",", "id", seconds, level, "event_type").alias("value"))


@query(
    f"""WITH {READINGS}
    SELECT seq, CAST(id AS VARCHAR) AS id, epoch_us(ts) // 1000000 AS ts, vc FROM r"""
)
def parse_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(_reading_lines(readings(spark, sf_dir), F.col("vc")))


@query("SELECT event_id AS seq FROM events WHERE event_type = 'error'")
def parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors carry a fraction in the level field, which makes their lines unreadable."""
    raw = readings(spark, sf_dir)
    level = F.when(F.col("event_type") == "error", F.concat("vc", F.lit(".5"))).otherwise(F.col("vc").cast("string"))
    return parse_or_reject(_reading_lines(raw, level))[1].select("seq")


@query(f"WITH {READINGS} SELECT id FROM r")
def project_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.project(readings(spark, sf_dir), "id")


@query(f"WITH {READINGS} SELECT seq, id, vc + 1 AS vc FROM r")
def map_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.increment(readings(spark, sf_dir), "vc").select("seq", "id", "vc")


@query(f"WITH {READINGS} SELECT seq, vc + 1 AS vc FROM r")
def map_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps with a resource opened once per task (here, the step to add)."""
    return transforms.map_with_setup(
        readings(spark, sf_dir).select("seq", "vc"),
        "seq bigint, vc int",
        lambda batch, step: batch.assign(vc=batch["vc"] + step),
        setup=lambda task: 1,
    )


@query(f"WITH {READINGS} SELECT seq, id, ts, vc FROM r WHERE event_type = 'click'")
def filter_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.filter_equal(readings(spark, sf_dir), "event_type", "click").select("seq", "id", "ts", "vc")


@query('SELECT range AS "index", \'number:\' || range AS "value" FROM range((SELECT count(*) FROM events))')
def gen_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many generated rows as there are events."""
    return generate(spark, table(spark, sf_dir, "events").count())


@query(
    """SELECT CAST(floor(value) AS BIGINT) AS "value" FROM events
    UNION ALL SELECT o_custkey FROM orders
    UNION ALL SELECT l_linenumber FROM lineitem"""
)
def union_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = readings(spark, sf_dir).select(F.col("vc").cast("bigint").alias("value"))
    customers = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("value"))
    text = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").cast("string").alias("value"))
    return joins.union_all(levels, customers, text.select(F.col("value").cast("bigint").alias("value")))


@query(
    f"""WITH {READINGS}
    SELECT 'reading' AS source, seq AS row_id, 'level ' || vc AS info FROM r
    UNION ALL SELECT 'order', o_orderkey, o_orderpriority FROM orders"""
)
def connect_comap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.connect(
        readings(spark, sf_dir),
        table(spark, sf_dir, "orders"),
        [F.lit("reading").alias("source"), F.col("seq").alias("row_id"), F.concat(F.lit("level "), "vc").alias("info")],
        [F.lit("order").alias("source"), F.col("o_orderkey").alias("row_id"), F.col("o_orderpriority").alias("info")],
    )


@query(
    f"""WITH {READINGS}
    SELECT seq, id, vc, CASE event_type WHEN 'click' THEN 's1' WHEN 'purchase' THEN 's2' ELSE 'main' END AS route
    FROM r"""
)
def split_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    routed = split.route(readings(spark, sf_dir), {"s1": kind == "click", "s2": kind == "purchase"})
    return routed.select("seq", "id", "vc", "route")


@query(
    f"""WITH {READINGS}
    SELECT 'main' AS output, seq, id, vc FROM r
    UNION ALL SELECT 'alert', seq, id, vc FROM r WHERE vc > 10"""
)
def alert_side_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    main, alerts = split.alert_side_output(readings(spark, sf_dir).select("seq", "id", "vc"), "vc", 10)
    return main.select(F.lit("main").alias("output"), "*").unionByName(alerts.select(F.lit("alert").alias("output"), "*"))


TASKS = 8


@query(f"WITH {READINGS} SELECT id, CAST(1 AS BIGINT) AS tasks, count(*) AS cnt FROM r GROUP BY id")
def keyby_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On how many tasks each key was found."""
    placed = distribute.key_by(readings(spark, sf_dir), TASKS, "id").withColumn("task", F.spark_partition_id())
    per_task = placed.groupBy("id", "task").agg(F.count("*").alias("cnt"))
    return per_task.groupBy("id").agg(F.count("*").alias("tasks"), F.sum("cnt").alias("cnt"))


@query(f"SELECT count(*) AS cnt, CAST({TASKS} AS BIGINT) AS tasks, true AS balanced FROM events")
def rebalance_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the rows were dealt out evenly: no task has a tenth more than its share."""
    dealt = distribute.rebalance(readings(spark, sf_dir).select("seq"), TASKS)
    sizes = dealt.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"))
    return sizes.agg(
        F.sum("n").alias("cnt"),
        F.count("*").alias("tasks"),
        (F.max("n") <= F.sum("n") * 1.1 / TASKS).alias("balanced"),
    )


@query(
    f"""WITH {READINGS}
    SELECT count(*) AS cnt, count(DISTINCT seq) AS seqs, CAST({TASKS} AS BIGINT) AS tasks, true AS even, true AS mixed FROM r"""
)
def shuffle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows dealt out by chance to twice as many tasks, which are then merged.

    Nothing is lost or doubled, no task has a half more than its share, and each has rows of the
    first and of the last quarter, which lie apart in the file.
    """
    rows = readings(spark, sf_dir).select("seq")
    bounds = rows.agg(F.min("seq").alias("low"), F.max("seq").alias("high"))
    moved = distribute.rescale(distribute.shuffle(rows, 2 * TASKS, ["seq"]), TASKS)
    placed = moved.withColumn("task", F.spark_partition_id()).crossJoin(F.broadcast(bounds))  # one row of bounds
    part = (F.col("seq") - F.col("low")) / (F.col("high") - F.col("low"))
    tasks = placed.groupBy("task").agg(
        F.count("*").alias("n"),
        F.count_distinct("seq").alias("seqs"),
        (F.count_if(part < 0.25) > 0).alias("early"),
        (F.count_if(part > 0.75) > 0).alias("late"),
    )
    return tasks.agg(
        F.sum("n").alias("cnt"),
        F.sum("seqs").alias("seqs"),
        F.count("*").alias("tasks"),
        (F.max("n") <= F.sum("n") * 1.5 / TASKS).alias("even"),
        F.bool_and(F.col("early") & F.col("late")).alias("mixed"),
    )


@query(
    f"""WITH {READINGS}
    SELECT id, ts, strftime(ts, '%Y-%m-%d %H:%M:%S.000') AS at, 'sensor ' || id || ' at level ' || vc AS note
    FROM (SELECT id, date_trunc('second', ts) AS ts, vc FROM r)"""
)
def lines_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings written as lines of text, read back, parsed, given event time, and put into words."""
    path = f"{scratch_dir(spark, 'lines')}/lines"
    rows = readings(spark, sf_dir).select("id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"), "vc")
    rows.select(F.concat_ws(",", "id", "s", "vc").alias("value")).write.text(path)
    parsed = parse(text_file(spark, path)).withColumn("ts", windows.event_time("ts"))
    return parsed.select(
        F.col("id").cast("long").alias("id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        format_millis("ts").alias("at"),
        message("sensor %s at level %s", "id", "vc").alias("note"),
    )


@query(
    f"""WITH {READINGS}
    SELECT CAST(task AS INTEGER) AS task, CAST(task AS INTEGER) AS placed_on, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS sum_vc
    FROM r, range({TASKS}) t(task) GROUP BY task"""
)
def broadcast_replicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = distribute.replicate(readings(spark, sf_dir).select("vc"), TASKS)
    placed = copies.withColumn("placed_on", F.spark_partition_id())
    return placed.groupBy("task", "placed_on").agg(F.count("*").alias("cnt"), F.sum("vc").alias("sum_vc"))


@query(f"WITH {READINGS} SELECT CAST(vc % 3 AS INTEGER) AS task, count(*) AS cnt FROM r GROUP BY 1")
def custom_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per task when the caller computes the task from the level."""
    target = transforms.remainder_key("vc", 3)
    placed = distribute.partition_by(readings(spark, sf_dir).select("vc"), 3, target)
    return placed.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("cnt"))


@query(f"WITH {READINGS} SELECT seq, row_number() OVER (ORDER BY ts, seq) AS position FROM r")
def global_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribute.global_sequence(readings(spark, sf_dir).select("ts", "seq"), ["ts", "seq"]).drop("ts")
