"""Functions of a caller's own, with state and timers, over one and two inputs."""

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.catalog import query
from keyflow.catalog.sql import ARRIVALS, READINGS
from keyflow.operators.process import KeyedProcess, process
from keyflow.schema import ARRIVAL_ORDER, readings, table, with_arrival

KEY = ["id"]


class CachedJoin(KeyedProcess):
    """Keeps the records of both inputs and pairs a new one with all that the other input has sent so far."""

    def on_record(self, context, side, row):
        mine, others = (context.state.setdefault(s, []) for s in (side, 1 - side))
        mine.append(row)
        for other in others:
            left, right = (row, other) if side == 0 else (other, row)
            context.emit(left["o_custkey"], left["o_orderstatus"], right["l_linenumber"], right["l_returnflag"])


@query(
    """SELECT o_orderkey AS k, o_custkey, o_orderstatus, l_linenumber, l_returnflag
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey"""
)
def process_cached_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and their items as they are dated, joined by a function that remembers both."""
    orders = table(spark, sf_dir, "orders")
    orders = orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").cast("timestamp_ntz").alias("at"),
                           F.lit(0).alias("line"), "o_custkey", "o_orderstatus")
    items = table(spark, sf_dir, "lineitem")
    items = items.select(F.col("l_orderkey").alias("k"), F.col("l_shipdate").cast("timestamp_ntz").alias("at"),
                         F.col("l_linenumber").cast("int").alias("line"), "l_linenumber", "l_returnflag")
    kinds = {n: df.schema[n].dataType.simpleString() for df in (orders, items) for n in df.columns}
    names = ("o_custkey", "o_orderstatus", "l_linenumber", "l_returnflag")
    schema = ", ".join(f"{n} {kinds[n]}" for n in names)
    return process([orders, items], ["k"], "at", ["at", "k", "line"], "1 day", CachedJoin(), schema)


class Silence(KeyedProcess):
    """Rings when a key has sent nothing for a time. Each record moves the timer."""

    def __init__(self, limit: timedelta):
        self.limit = limit

    def on_record(self, context, side, row):
        last = context.state.get("last")
        if last is not None:
            if row["ts"] > last + self.limit and not context.state["rung"]:
                context.emit(last, last + self.limit)
            context.delete_timer(last + self.limit)
        context.state.update(last=row["ts"], rung=False)
        context.set_timer(row["ts"] + self.limit)

    def on_timer(self, context, at):
        context.emit(context.state["last"], at)
        context.state["rung"] = True


@query(
    f"""WITH {READINGS},
    n AS (SELECT id, ts, lead(ts) OVER (PARTITION BY id ORDER BY ts, seq) AS next FROM r)
    SELECT id, ts AS last_ts, ts + INTERVAL 12 HOUR AS fires_at FROM n
    WHERE next > ts + INTERVAL 12 HOUR
       OR (next IS NULL AND ts + INTERVAL 12 HOUR <= (SELECT max(ts) FROM r) - INTERVAL 1 HOUR)"""
)
def process_silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inactivity alarm as a function with a timer that each record sets anew."""
    rows = readings(spark, sf_dir).select("id", "ts", "seq")
    schema = "last_ts timestamp_ntz, fires_at timestamp_ntz"
    return process([rows], KEY, "ts", ARRIVAL_ORDER, "1 hour", Silence(timedelta(hours=12)), schema)


class Reminder(KeyedProcess):
    """Each click sets a timer, a purchase deletes those that have not rung."""

    def on_record(self, context, side, row):
        if side == 0:
            context.set_timer(row["ts"] + timedelta(hours=6))
        else:
            context.delete_timers()

    def on_timer(self, context, at):
        context.emit(at)


@query(
    f"""WITH {ARRIVALS},
    s AS (SELECT * FROM a WHERE event_type IN ('click', 'purchase')),
    m AS (SELECT *, max(CASE WHEN event_type = 'click' THEN ts END) OVER w AS c,
                 max(CASE WHEN event_type = 'purchase' THEN ts END) OVER w AS p
          FROM s WINDOW w AS (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    w AS (SELECT *, CASE WHEN c IS NOT NULL AND p IS NOT NULL THEN least(c, p) - INTERVAL 1 HOUR END AS watermark FROM m),
    d AS (SELECT *, count(*) FILTER (WHERE event_type = 'purchase') OVER k AS deletions,
                 first_value(CASE WHEN event_type = 'purchase' THEN coalesce(watermark, TIMESTAMP '1900-01-01') END IGNORE NULLS) OVER k
                     AS deleted_at
          FROM w WINDOW k AS (PARTITION BY id ORDER BY arrival, seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
    e AS (SELECT least(max(ts) FILTER (WHERE event_type = 'click'), max(ts) FILTER (WHERE event_type = 'purchase'))
                 - INTERVAL 1 HOUR AS final FROM s)
    SELECT DISTINCT id, ts + INTERVAL 6 HOUR AS fires_at FROM d, e
    WHERE event_type = 'click' AND ts + INTERVAL 6 HOUR <= CASE WHEN deletions > 0 THEN deleted_at ELSE final END"""
)
def process_reminder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timers of one input that records of another delete, on disordered arrivals."""
    rows = with_arrival(readings(spark, sf_dir))
    inputs = [rows.where(F.col("event_type") == kind).select("id", "ts", "arrival", "seq") for kind in ("click", "purchase")]
    reminded = process(inputs, KEY, "ts", ["arrival", "seq"], "1 hour", Reminder(), "fires_at timestamp_ntz")
    return reminded.distinct()
