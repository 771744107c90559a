"""Windows, event-time lateness, top-N per window."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.catalog import query
from keyflow.catalog.sql import ARRIVALS, READINGS, bucket
from keyflow.functions.accumulator import Mean
from keyflow.operators import lateness, sliding, topn, transforms, windows
from keyflow.plans import hotsplit
from keyflow.schema import ARRIVAL_ORDER, readings, with_arrival

KEY = ["id"]


def _counts() -> dict:
    return {"cnt": F.count("*"), "sum_vc": F.sum("vc")}


SUMS = "count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS sum_vc"


def _hourly(select: str, group: str = "GROUP BY id, window_start", hours: int = 1) -> str:
    return f"""WITH {READINGS}, h AS (SELECT *, {bucket("ts", hours)} AS window_start FROM r)
    SELECT id, window_start, window_start + INTERVAL {hours} HOUR AS window_end, {select} FROM h {group}"""


@query(_hourly(SUMS))
def tumbling_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.time_window(readings(spark, sf_dir), KEY, "ts", "1 hour", **_counts())


@query(_hourly(SUMS, hours=24))
def tumbling_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.time_window(readings(spark, sf_dir), KEY, "ts", "1 day", **_counts())


SLIDING_SQL = f"""
    s AS (
        SELECT vc, unnest([epoch_us(ts) // 1800000000, epoch_us(ts) // 1800000000 - 1]) * 1800000000 AS start FROM r
    ),
    c AS (
        SELECT vc, make_timestamp(start) AS window_start, make_timestamp(start) + INTERVAL 1 HOUR AS window_end,
               count(*) AS cnt
        FROM s GROUP BY vc, start
    )"""


@query(f"WITH {READINGS}, {SLIDING_SQL} SELECT * FROM c")
def sliding_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliding.sliding_window(readings(spark, sf_dir), ["vc"], "ts", "1 hour", "30 minutes", cnt=hotsplit.count())


@query(
    f"""WITH {READINGS},
    s AS (SELECT event_type, ts, vc, (epoch_us(ts) // 900000000 - unnest(range(96))) * 900000000 AS start FROM r)
    SELECT event_type, make_timestamp(start) AS window_start, make_timestamp(start) + INTERVAL 1 DAY AS window_end,
           {SUMS}, min(vc) AS least, max(vc) AS most, min(ts) AS first_ts
    FROM s GROUP BY event_type, start"""
)
def sliding_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's sums and extremes every quarter of an hour: each reading is in 96 windows."""
    scans = {"least": hotsplit.lowest("vc"), "most": hotsplit.highest("vc"), "first_ts": hotsplit.lowest("ts")}
    rows = readings(spark, sf_dir)
    return sliding.sliding_window(rows, ["event_type"], "ts", "1 day", "15 minutes", **_running_counts(), **scans)


@query(
    f"""WITH {READINGS}, {SLIDING_SQL},
    k AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, vc) AS rank FROM c)
    SELECT window_start, window_end, vc, cnt, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 2"""
)
def window_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.window_top_n(readings(spark, sf_dir), "vc", "ts", "1 hour", "30 minutes", 2)


@query(
    f"""WITH {READINGS},
    f AS (SELECT *, coalesce(CAST(ts - lag(ts) OVER w > INTERVAL 8 HOUR AS INTEGER), 1) AS opens
          FROM r WINDOW w AS (PARTITION BY id ORDER BY ts, seq)),
    s AS (SELECT *, sum(opens) OVER (PARTITION BY id ORDER BY ts, seq) AS session FROM f)
    SELECT id, min(ts) AS window_start, max(ts) + INTERVAL 8 HOUR AS window_end, {SUMS}
    FROM s GROUP BY id, session"""
)
def session_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.session_window(readings(spark, sf_dir), KEY, "ts", 8 * 3600, ARRIVAL_ORDER, **_counts())


@query(
    f"""WITH {READINGS},
    g AS (SELECT *, ts + to_hours(1 + vc % 12) AS until FROM r),
    f AS (SELECT *, coalesce(CAST(ts > max(until) OVER (PARTITION BY id ORDER BY ts, seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS INTEGER), 1) AS opens FROM g),
    s AS (SELECT *, sum(opens) OVER (PARTITION BY id ORDER BY ts, seq) AS session FROM f)
    SELECT id, min(ts) AS window_start, max(until) AS window_end, {SUMS} FROM s GROUP BY id, session"""
)
def session_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gap after a record depends on its level."""
    gap = (1 + F.col("vc") % 12) * 3600
    return windows.session_window(readings(spark, sf_dir), KEY, "ts", gap, ARRIVAL_ORDER, **_counts())


def _running_counts() -> dict:
    return {"cnt": hotsplit.count(), "sum_vc": hotsplit.total("vc")}


def _counts_and_bounds() -> dict:
    return {**_running_counts(), "first_ts": hotsplit.lowest("ts"), "last_ts": hotsplit.highest("ts")}


NUMBERED = "n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts, seq) AS k FROM r)"


@query(
    f"""WITH {READINGS}, {NUMBERED}
    SELECT id, max(k) AS firing, {SUMS}, min(ts) AS first_ts, max(ts) AS last_ts
    FROM n GROUP BY id, (k - 1) // 3 HAVING count(*) = 3"""
)
def count_window_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.count_window(readings(spark, sf_dir), KEY, ARRIVAL_ORDER, 3, **_counts_and_bounds())


def _count_sliding_sql(size: int, step: int) -> str:
    return f"""WITH {READINGS}, {NUMBERED},
    f AS (SELECT id, k AS firing, count(*) OVER w AS cnt, CAST(sum(vc) OVER w AS BIGINT) AS sum_vc,
                 min(ts) OVER w AS first_ts, max(ts) OVER w AS last_ts
          FROM n WINDOW w AS (PARTITION BY id ORDER BY k ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW))
    SELECT * FROM f WHERE firing % {step} = 0"""


@query(_count_sliding_sql(3, 1))
def count_window_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.count_window(readings(spark, sf_dir), KEY, ARRIVAL_ORDER, 3, 1, **_counts_and_bounds())


@query(_count_sliding_sql(5, 2))
def count_window_sliding_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.count_window(readings(spark, sf_dir), KEY, ARRIVAL_ORDER, 5, 2, **_counts_and_bounds())


@query(
    f"""WITH {READINGS}, n AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, seq) AS firing FROM r)
    SELECT event_type, firing, count(*) OVER w AS cnt, CAST(sum(vc) OVER w AS BIGINT) AS sum_vc,
           min(ts) OVER w AS first_ts, max(ts) OVER w AS last_ts, min(vc) OVER w AS least, max(vc) OVER w AS most
    FROM n WINDOW w AS (PARTITION BY event_type ORDER BY firing ROWS BETWEEN 999 PRECEDING AND CURRENT ROW)"""
)
def count_window_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After each reading, the last thousand of its type."""
    scans = _counts_and_bounds() | {"least": hotsplit.lowest("vc"), "most": hotsplit.highest("vc")}
    return windows.count_window(readings(spark, sf_dir), ["event_type"], ARRIVAL_ORDER, 1000, 1, **scans)


@query(_hourly("min(ts) AS first_ts, CAST(sum(vc) AS BIGINT) AS sum_vc"))
def window_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_reduce(readings(spark, sf_dir), KEY, "ts", "1 hour", ARRIVAL_ORDER, "vc")


@query(_hourly("CAST(CAST(sum(vc) AS BIGINT) AS VARCHAR) AS result"))
def window_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_aggregate(readings(spark, sf_dir), KEY, "ts", "1 hour", F.sum("vc"))


@query(_hourly("avg(vc) AS mean"))
def window_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mean computed by an accumulator supplied in Python."""
    return windows.window_fold(readings(spark, sf_dir), KEY, "ts", "1 hour", Mean(), ["vc"], "mean", T.DoubleType())


@query(
    f"""WITH {READINGS}, h AS (SELECT *, {bucket("ts")} AS window_start FROM r)
    SELECT id, window_start, window_start + INTERVAL 1 HOUR AS window_end,
           row_number() OVER (PARTITION BY id, window_start ORDER BY ts, seq) AS position,
           count(*) OVER (PARTITION BY id, window_start) AS cnt, vc AS element
    FROM h"""
)
def window_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_process(readings(spark, sf_dir), KEY, "ts", "1 hour", ARRIVAL_ORDER, F.col("vc"))


@query(_hourly("count(*) AS cnt, string_agg(vc, ',' ORDER BY ts, seq) AS elements"))
def window_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key's readings of one hour are few."""
    rows = windows.window_process(readings(spark, sf_dir), KEY, "ts", "1 hour", ARRIVAL_ORDER, F.col("vc").cast("string"))
    return windows.window_lists(rows, KEY).withColumn("elements", F.array_join("elements", ","))


@query(_hourly("CAST(1 AS BIGINT) AS cnt, CAST(sum(vc) AS BIGINT) AS sum_vc"))
def window_aggregate_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window's one aggregated element with the window's bounds; its count is 1."""
    sums = windows.time_window(readings(spark, sf_dir), KEY, "ts", "1 hour", sum_vc=F.sum("vc"))
    return sums.withColumn("cnt", F.lit(1).cast("long"))


@query(
    f"""WITH {READINGS}, h AS (SELECT *, vc % 2 AS parity, {bucket("ts")} AS window_start FROM r)
    SELECT parity, window_start, window_start + INTERVAL 1 HOUR AS window_end, {SUMS}
    FROM h GROUP BY parity, window_start"""
)
def idle_parity_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = readings(spark, sf_dir).withColumn("parity", transforms.remainder_key("vc", 2))
    return windows.time_window(keyed, ["parity"], "ts", "1 hour", **_counts())


ARRIVED = ["arrival", "seq"]

# Odd levels arrive in the first half of each day only.
IDLE_SQL = f"""{ARRIVALS},
    i AS (SELECT *, vc % 2 AS parity FROM a WHERE vc % 2 = 0 OR hour(ts) < 12),
    b AS (SELECT *, max(CASE WHEN parity = 0 THEN ts END) OVER w AS t0, max(CASE WHEN parity = 1 THEN ts END) OVER w AS t1,
                 arrival - coalesce(max(CASE WHEN parity = 0 THEN arrival END) OVER w, min(arrival) OVER w) <= INTERVAL 3 HOUR AS a0,
                 arrival - coalesce(max(CASE WHEN parity = 1 THEN arrival END) OVER w, min(arrival) OVER w) <= INTERVAL 3 HOUR AS a1
          FROM i WINDOW w AS (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    n AS (SELECT *, CASE WHEN a0 AND a1 THEN CASE WHEN t0 IS NOT NULL AND t1 IS NOT NULL THEN least(t0, t1) END
                         WHEN a0 THEN t0 WHEN a1 THEN t1 END - INTERVAL 30 MINUTE AS now FROM b)"""


@query(
    f"""WITH {IDLE_SQL},
    k AS (SELECT *, max(now) OVER (ORDER BY arrival, seq) AS watermark FROM n)
    SELECT seq, CAST(parity AS INTEGER) AS parity, watermark, coalesce(ts < watermark, false) AS is_late FROM k"""
)
def idle_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even and odd levels as two inputs, one of which stops for half a day and must not hold the other back."""
    rows = _arrivals(spark, sf_dir).withColumn("parity", F.col("vc") % 2).where((F.col("parity") == 0) | (F.hour("ts") < 12))
    marked = lateness.with_watermark_of_inputs(rows, "parity", [0, 1], "ts", "arrival", ARRIVED, "30 minutes", "3 hours")
    return marked.select("seq", "parity", "watermark", F.coalesce(F.col("ts") < F.col("watermark"), F.lit(False)).alias("is_late"))

CLASSIFIED = f"""{ARRIVALS},
    m AS (SELECT *, {bucket("ts")} + INTERVAL 1 HOUR AS window_end,
                 max(ts) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                     - INTERVAL 1 HOUR AS watermark
          FROM a),
    c AS (SELECT *, CASE WHEN watermark IS NULL OR window_end > watermark THEN 'on_time'
                         WHEN window_end + INTERVAL 30 MINUTE > watermark THEN 'allowed'
                         ELSE 'late' END AS status FROM m)"""


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_arrival(readings(spark, sf_dir).select("seq", "id", "ts", "vc"))


LATE_CLASSIFY_SQL = f"WITH {CLASSIFIED} SELECT seq, id, ts, window_end, status FROM c"


@query(LATE_CLASSIFY_SQL)
def late_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = lateness.classify(_arrivals(spark, sf_dir), "ts", "1 hour", "1 hour", "30 minutes", ARRIVED)
    return classified.select("seq", "id", "ts", "window_end", "status")


LATE_PANES_SQL = f"""WITH {CLASSIFIED},
    p AS (SELECT id, window_end, status,
                 count(*) OVER w AS cnt, CAST(sum(vc) OVER w AS BIGINT) AS sum_vc,
                 CAST(status = 'allowed' OR lead(status) OVER (PARTITION BY id, window_end ORDER BY arrival, seq)
                      IS DISTINCT FROM 'on_time' AS INTEGER) AS emits,
                 arrival, seq
          FROM c WHERE status <> 'late'
          WINDOW w AS (PARTITION BY id, window_end ORDER BY arrival, seq))
    SELECT id, window_end - INTERVAL 1 HOUR AS window_start, window_end,
           row_number() OVER (PARTITION BY id, window_end ORDER BY arrival, seq) AS pane, cnt, sum_vc
    FROM p WHERE emits = 1"""


@query(LATE_PANES_SQL)
def late_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lateness.panes(_arrivals(spark, sf_dir), KEY, "ts", "1 hour", "1 hour", "30 minutes", ARRIVED, "vc")
