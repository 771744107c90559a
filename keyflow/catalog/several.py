"""Operators over several inputs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.catalog import query
from keyflow.catalog.sql import ARRIVALS, READINGS, bucket
from keyflow.operators import joins
from keyflow.schema import ARRIVAL_ORDER, readings, table, with_arrival

KEY = ["id"]
HOUR = 3600


def side(df: DataFrame, event_type: str, prefix: str) -> DataFrame:
    """The events of one type, as one input of a join."""
    rows = df.filter(F.col("event_type") == event_type)
    return rows.select("id", *[F.col(name).alias(f"{prefix}_{name}") for name in ("seq", "ts", "vc")])


@query(
    """SELECT o_orderkey AS k, o_custkey, o_orderstatus, l_linenumber, l_returnflag
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey"""
)
def keyed_connect_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey", "o_orderstatus")
    right = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber", "l_returnflag")
    return joins.keyed_connect(left, right, ["k"], ["k", "o_custkey"], ["k", "l_linenumber"])


@query(
    f"""WITH {READINGS}
    SELECT l.id, l.seq AS left_seq, p.seq AS right_seq, {bucket("l.ts", 5)} AS window_start,
           {bucket("l.ts", 5)} + INTERVAL 5 HOUR AS window_end
    FROM r l JOIN r p ON l.id = p.id AND {bucket("l.ts", 5)} = {bucket("p.ts", 5)}
    WHERE l.event_type = 'click' AND p.event_type = 'purchase'"""
)
def window_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = readings(spark, sf_dir)
    joined = joins.window_join(
        side(df, "click", "left"), side(df, "purchase", "right"), KEY, "left_ts", "right_ts", "5 hours", ["left_seq"], ["right_seq"]
    )
    return joined.select("id", "left_seq", "right_seq", "window_start", "window_end")


def interval_sql(left: str, right: str, lower: str, upper: str) -> str:
    return f"""WITH {READINGS}
    SELECT l.id, l.seq AS left_seq, p.seq AS right_seq, l.ts AS left_ts, p.ts AS right_ts
    FROM r l JOIN r p ON l.id = p.id AND p.ts BETWEEN l.ts + INTERVAL '{lower}' AND l.ts + INTERVAL '{upper}'
    WHERE l.event_type = '{left}' AND p.event_type = '{right}'"""


PAIR = ["id", "left_seq", "right_seq", "left_ts", "right_ts"]


@query(interval_sql("click", "purchase", "-2 hours", "2 hours"))
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = readings(spark, sf_dir)
    return joins.interval_join(
        side(df, "click", "left"), side(df, "purchase", "right"), KEY, "left_ts", "right_ts", -2 * HOUR, 2 * HOUR, ["left_seq"], ["right_seq"]
    ).select(*PAIR)


@query(interval_sql("view", "error", "-1 hours", "6 hours"))
def interval_join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lopsided interval, with buckets finer than the interval."""
    df = readings(spark, sf_dir)
    return joins.interval_join(
        side(df, "view", "left"), side(df, "error", "right"), KEY, "left_ts", "right_ts", -HOUR, 6 * HOUR, ["left_seq"], ["right_seq"], bucket_seconds=HOUR
    ).select(*PAIR)


LATE_SIDES = f"""{ARRIVALS},
    b AS (SELECT *, CASE event_type WHEN 'click' THEN 'left' ELSE 'right' END AS side
          FROM a WHERE event_type IN ('click', 'purchase')),
    m AS (SELECT *, max(ts) FILTER (WHERE side = 'left') OVER w AS max_left,
                    max(ts) FILTER (WHERE side = 'right') OVER w AS max_right
          FROM b WINDOW w AS (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    c AS (SELECT *, CASE WHEN max_left IS NULL OR max_right IS NULL THEN false
                         ELSE ts < least(max_left, max_right) - INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND END AS is_late
          FROM m)"""


def clicks_and_purchases(df: DataFrame) -> DataFrame:
    """Two inputs in one table, as they arrive."""
    kind = F.col("event_type")
    both = df.filter(kind.isin("click", "purchase"))
    return with_arrival(both.withColumn("side", F.when(kind == "click", "left").otherwise("right"))).drop("event_type")


def _with_late(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    merged = clicks_and_purchases(readings(spark, sf_dir))
    return joins.interval_join_with_late(merged, KEY, "ts", ["arrival", "seq"], "1 hour", -2 * HOUR, 2 * HOUR, "seq")


ON_TIME_PAIRS_SQL = (
    f"""WITH {LATE_SIDES}
    SELECT l.id, l.seq AS left_seq, p.seq AS right_seq, l.ts AS left_ts, p.ts AS right_ts
    FROM c l JOIN c p ON l.id = p.id AND p.ts BETWEEN l.ts - INTERVAL 2 HOUR AND l.ts + INTERVAL 2 HOUR
    WHERE l.side = 'left' AND p.side = 'right' AND NOT l.is_late AND NOT p.is_late"""
)


@query(ON_TIME_PAIRS_SQL)
def interval_join_on_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_late(spark, sf_dir)[0].select(*PAIR)


LATE_OF_SIDES_SQL = f"WITH {LATE_SIDES} SELECT side, seq, id, ts, vc FROM c WHERE is_late"


@query(LATE_OF_SIDES_SQL)
def interval_join_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_late(spark, sf_dir)[1].select("side", "seq", "id", "ts", "vc")


THRESHOLD_SQL = f"""WITH {READINGS},
    config AS (SELECT ts AS since, vc AS threshold FROM r WHERE event_type = 'signup'),
    t AS (SELECT seq, id, ts, vc, coalesce(threshold, 10) AS threshold
          FROM (SELECT * FROM r WHERE event_type <> 'signup') x ASOF LEFT JOIN config ON x.ts > config.since)
    SELECT seq, id, ts, vc, threshold FROM t WHERE vc > threshold"""


@query(THRESHOLD_SQL)
def broadcast_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups set the threshold for everything that arrives after them."""
    config = F.col("event_type") == "signup"
    return joins.broadcast_threshold(readings(spark, sf_dir), config, "vc", ARRIVAL_ORDER).drop("event_type")
